"""Scans of landed files and tables, and the sinks."""
