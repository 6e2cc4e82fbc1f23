"""Readers of the four source tables and the writers of both layouts."""

from pitchlake.sources.buckets import BucketSize, bucket_landed
from pitchlake.sources.readers import JdbcSource, Sources, TableNames, read_jdbc, read_parquet
from pitchlake.sources.sinks import land_sources, read_fact, write_fact

__all__ = [
    "BucketSize",
    "JdbcSource",
    "Sources",
    "TableNames",
    "bucket_landed",
    "land_sources",
    "read_fact",
    "read_jdbc",
    "read_parquet",
    "write_fact",
]
