"""Staging readers, the versioned table store and the run log."""

from tidemark.sources.staging import read_staging  # noqa: F401
from tidemark.sources.store import TableStore  # noqa: F401
