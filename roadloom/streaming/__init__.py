"""Scenario files and frames as streams."""
