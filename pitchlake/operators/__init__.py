"""Joins and aggregations of the pitch fact."""
