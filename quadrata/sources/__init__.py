"""Scans, sinks, source discovery and run metrics."""
