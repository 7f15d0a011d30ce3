"""Warehouse builds and analytic questions."""
