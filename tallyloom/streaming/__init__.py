"""Incremental runs over newly delivered files."""
