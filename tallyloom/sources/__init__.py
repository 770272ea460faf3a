"""Delivered files, lookup tables and sinks."""
