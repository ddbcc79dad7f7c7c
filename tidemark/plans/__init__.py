"""Entity specs, sync jobs, reports and the test-table query registry."""
