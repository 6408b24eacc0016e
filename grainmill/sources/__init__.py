"""Scans, sinks and table stages."""
