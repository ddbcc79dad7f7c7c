"""Feeding the sync jobs from a stream (an execution mode, not an operator)."""

from tidemark.streaming.micro_batch import start_sync_stream  # noqa: F401
