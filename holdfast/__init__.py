"""Leakage-safe tabular learning on Spark: fit is an aggregation, transform is a projection."""
