"""Incremental runs: what is new since the last run, keyed by content."""
