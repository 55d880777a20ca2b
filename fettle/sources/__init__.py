"""Scans, row numbering, snapshots and report sinks."""
