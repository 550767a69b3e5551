"""Operators grouped by the part of a query they express."""
