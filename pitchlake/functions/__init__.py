"""Column expressions of the pitch fact. Each function takes and returns Columns
(or a dict of named Columns for `withColumns`); all are Spark built-ins."""
