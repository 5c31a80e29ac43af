"""Outputs: category layout, split, reports."""
