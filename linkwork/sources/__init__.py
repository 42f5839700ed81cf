"""Scans and sinks of the linkage tables."""
