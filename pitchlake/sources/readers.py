"""The four source tables, from Parquet or a database."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, types as T

from pitchlake import schema
from pitchlake.session import read_note

#: Ending of the folder beside a landed table that keeps it in buckets.
BUCKETS = "_buckets"


@dataclass(frozen=True)
class Sources:
    """The four tables; `in_buckets` names those that lie in buckets of their
    join key."""

    pitches: DataFrame
    pitch_log: DataFrame
    trace: DataFrame
    players: DataFrame
    in_buckets: frozenset[str] = frozenset()

    @classmethod
    def of(
        cls, pitches: DataFrame, pitch_log: DataFrame, trace: DataFrame, players: DataFrame
    ) -> Sources:
        """Bind raw tables to the declared columns by name."""
        return cls(
            schema.conform(pitches, schema.PITCH_COLUMNS, passthrough=("date",)),
            schema.conform(pitch_log, schema.PITCH_LOG_COLUMNS),
            schema.conform(trace, schema.TRACE_COLUMNS),
            schema.conform(players, schema.PLAYER_COLUMNS),
        )


@dataclass(frozen=True)
class TableNames:
    pitches: str = "pitches"
    pitch_log: str = "pitch_log"
    trace: str = "pitch_trace"
    players: str = "player_info"


def catalog_name(location: str) -> str:
    return f"landed_{hashlib.sha256(location.encode()).hexdigest()[:24]}"


def read_buckets(spark: SparkSession, path: str) -> DataFrame | None:
    """A table kept in buckets; None where there is no whole one. Spark takes
    buckets from its catalog only, so the files are entered in the session's
    current database as an external table, under a name made from the path."""
    text = read_note(spark, f"{path}/_whole")
    if text is None:
        return None
    note = json.loads(text)
    location = f"{path}/{note['version']}"
    name, keys = catalog_name(location), ", ".join(f"`{key}`" for key in note["keys"])
    columns = T.StructType.fromJson(json.loads(note["schema"])).toDDL()
    quoted = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {note['buckets']} BUCKETS LOCATION '{quoted}'"
    )
    return spark.table(name)


def read_parquet(
    spark: SparkSession, folder: str, names: TableNames = TableNames(), buckets: bool = True
) -> Sources:
    """Tables landed as Parquet folders. Where pitches are landed partitioned by
    level, the league filter also prunes partitions. Log and trace are read from
    their buckets where `bucket_landed` has made any, unless told not to."""
    root = folder.rstrip("/")
    found = {}
    for field in ("pitch_log", "trace") if buckets else ():
        table = read_buckets(spark, f"{root}/{getattr(names, field)}{BUCKETS}")
        if table is not None:
            found[field] = table

    def landed(field: str) -> DataFrame:
        return found[field] if field in found else spark.read.parquet(f"{root}/{getattr(names, field)}")

    sources = Sources.of(landed("pitches"), landed("pitch_log"), landed("trace"), landed("players"))
    return replace(sources, in_buckets=frozenset(found))


@dataclass(frozen=True)
class JdbcSource:
    """Connection of a database read. Credentials come in through `properties`,
    from the job's own configuration."""

    url: str
    properties: dict[str, str]
    partitions: int = 64
    fetch_size: int = 10_000


def read_jdbc(
    spark: SparkSession,
    source: JdbcSource,
    game_range: tuple[int, int],
    names: TableNames = TableNames(),
) -> Sources:
    """Tables read over JDBC. The three pitch tables are cut into ranges of
    game_seq, read in parallel; `game_range` gives the lowest and highest value
    and only shapes the ranges: rows outside it are read all the same."""
    properties = {"fetchsize": str(source.fetch_size), **source.properties}

    def in_ranges(name: str) -> DataFrame:
        low, high = game_range
        return spark.read.jdbc(
            source.url,
            name,
            column="game_seq",
            lowerBound=low,
            upperBound=high,
            numPartitions=source.partitions,
            properties=properties,
        )

    return Sources.of(
        in_ranges(names.pitches),
        in_ranges(names.pitch_log),
        in_ranges(names.trace),
        spark.read.jdbc(source.url, names.players, properties=properties),
    )
