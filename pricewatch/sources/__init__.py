"""Stored tables, document sinks, table checks and adapters for the test tables."""
