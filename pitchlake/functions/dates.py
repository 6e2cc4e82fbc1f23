"""Game dates, which arrive as a date, a timestamp or text of mixed formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Text formats tried in turn after ISO.
DATE_FORMATS = ("yyyyMMdd", "yyyy/M/d", "yyyy.M.d", "M/d/yyyy", "MM-dd-yyyy")


def game_date(column: Column, data_type: T.DataType) -> Column:
    """Zone-less timestamp. Text in no known format is an error, not a NULL."""
    if not isinstance(data_type, T.StringType):
        return column.cast("timestamp_ntz")
    text = F.trim(column)
    attempts = [F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in DATE_FORMATS]
    return F.coalesce(text.try_cast("timestamp_ntz"), *attempts, text.cast("timestamp_ntz"))
