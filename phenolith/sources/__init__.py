"""Scans, key ranges and version listings."""
