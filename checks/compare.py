"""Strict comparison of a Spark result with its oracle: names, rows and every
value, bit for bit, in any row order."""

from __future__ import annotations

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _text(value) -> str:
    if pd.isna(value):
        return "NULL"
    value = value.item() if hasattr(value, "item") else value
    text = repr(value)
    # An integer column with NULLs reaches pandas as floats.
    return text[:-2] if isinstance(value, float) and text.endswith(".0") else text


def _canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Text of every value, so that 0.0 and -0.0 do not pass as equal."""
    out = {}
    for name in sorted(frame.columns):
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            column = column.astype("datetime64[us]")
        out[name] = [_text(value) for value in column]
    canonical = pd.DataFrame(out)
    return canonical.sort_values(list(canonical.columns), ignore_index=True)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    ours, theirs = df.toPandas(), connection.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return [f"columns {sorted(set(ours.columns) ^ set(theirs.columns))}"]
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} against {len(theirs)}"]
    left, right = _canonical(ours), _canonical(theirs)
    return [
        f"column {name}: {(left[name] != right[name]).sum()} rows differ"
        for name in left.columns
        if not left[name].equals(right[name])
    ]
