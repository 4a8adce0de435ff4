"""Retail price tracking on Spark: clean prices, reference prices, history, audit."""
