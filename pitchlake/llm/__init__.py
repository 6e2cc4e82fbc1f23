"""Operators of a training-data pipeline: one module per operator, their queries
and SQL beside them. Nothing outside this folder imports it."""
