"""Incremental loads: time windows, sync state, micro-batches."""
