"""Warehouse steps as DataFrame-to-DataFrame transforms."""
