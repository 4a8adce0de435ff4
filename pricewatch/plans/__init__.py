"""Whole plans: the staged pipeline, the registered queries and their SQL checks."""
