"""Scans, snapshot building and sinks."""
