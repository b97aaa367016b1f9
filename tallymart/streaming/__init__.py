"""Incremental forms of the event load."""
