"""Sinks: landing, run-stamped folders, CSV exports, the results table."""
