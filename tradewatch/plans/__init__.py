"""Whole-pipeline plans and the registered query catalogue."""
