"""Regression on the enriched noise table."""
