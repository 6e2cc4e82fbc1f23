"""Log and trace in buckets of their join keys, so that runs do not shuffle them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pitchlake import schema
from pitchlake.operators.joins import DEFAULT_LIMITS, JoinLimits, hot_keys
from pitchlake.session import dropping_shuffles, read_note, stored_bytes, write_note
from pitchlake.sources.readers import BUCKETS, TableNames, catalog_name

#: Join keys of the tables that can be kept in buckets.
LOG_BUCKETS = ["game_seq", "pit_seq"]
TRACE_BUCKETS = ["game_seq", "pitch_no"]


@dataclass(frozen=True)
class BucketSize:
    """bytes: of one bucket as it is stored, on average. rows: of one bucket, on
    average; packed files say little of what a task holds, which sorts the wide
    pitches of the bucket's keys. most: buckets of a table, Spark's own limit;
    beyond it buckets grow (at 20 billion rows)."""

    bytes: int = 256 << 20
    rows: int = 200_000
    most: int = 100_000


def write_buckets(table: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Keep a table in buckets of its keys, one file each, sorted by them.

    A version lands in a folder of its own, and a note names it when it is
    whole: a run that dies leaves nothing that is read. The table is shuffled
    once, by the hash that numbers the buckets, so a task writes one file.
    """
    version = f"v-{uuid.uuid4().hex}"
    name = catalog_name(f"{path}/{version}")
    in_order = table.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    with dropping_shuffles(table.sparkSession):
        in_order.option("path", f"{path}/{version}").saveAsTable(name)
    table.sparkSession.sql(f"DROP TABLE {name}")  # the files stay
    note = {"version": version, "keys": list(keys), "buckets": buckets, "schema": table.schema.json()}
    write_note(table.sparkSession, f"{path}/_whole", json.dumps(note))


def bucket_landed(
    spark: SparkSession,
    folder: str,
    names: TableNames = TableNames(),
    size: BucketSize = BucketSize(),
    limits: JoinLimits = DEFAULT_LIMITS,
) -> dict[str, int]:
    """Keep the landed log and trace of a folder in buckets as well, where
    `read_parquet` finds them. Returns the number of buckets of each table.

    A bucket is one task of every join. So a table with a key, or with rows
    without a key, beyond what one task may take gets no buckets (0): it is read
    as it landed, and its joins split that key. Landed tables do not change, so
    buckets are made once; a table that has them is left alone.
    """
    root, made = folder.rstrip("/"), {}
    for name, columns, keys in (
        (names.pitch_log, schema.PITCH_LOG_COLUMNS, LOG_BUCKETS),
        (names.trace, schema.TRACE_COLUMNS, TRACE_BUCKETS),
    ):
        kept = read_note(spark, f"{root}/{name}{BUCKETS}/_whole")
        if kept is not None:
            made[name] = json.loads(kept)["buckets"]
            continue
        table = schema.conform(spark.read.parquet(f"{root}/{name}"), columns)
        if hot_keys(table, keys, limits):
            made[name] = 0
            continue
        by_bytes, by_rows = -(-stored_bytes(spark, f"{root}/{name}") // size.bytes), -(-table.count() // size.rows)
        made[name] = min(size.most, max(1, by_bytes, by_rows))
        write_buckets(table, f"{root}/{name}{BUCKETS}", keys, made[name])
    return made
