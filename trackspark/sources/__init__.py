"""Scans, sinks and checks."""
