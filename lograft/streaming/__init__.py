"""Incremental versions of the batch log queries over a growing log directory."""
