"""Composite operators, grouped by area (see README for the inventory)."""
