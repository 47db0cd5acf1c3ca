"""Scans, the store registry and sinks."""
