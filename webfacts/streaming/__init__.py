"""Incremental runs of the row-local steps."""
