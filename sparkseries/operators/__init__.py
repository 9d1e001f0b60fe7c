"""Operators on long panels of series."""
