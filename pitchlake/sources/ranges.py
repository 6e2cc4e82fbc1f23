"""Tables of a database read in ranges of even size, by jobs that may break off."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pitchlake.session import read_note, write_note
from pitchlake.sources.readers import JdbcSource, Sources, TableNames

#: Rows of each cell of games of one width, for the spans of games asked for.
Count = Callable[[list[tuple[int, int]], int], dict[int, int]]


@dataclass(frozen=True)
class RangeSize:
    """rows: wanted in one range. per_job: ranges that one Spark job reads, and so
    what a landing that breaks off reads again. cells: into which a span of games
    is cut at a time. spans: named in one question to the database."""

    rows: int = 1_000_000
    per_job: int = 256
    cells: int = 256
    spans: int = 100


def counter(spark: SparkSession, source: JdbcSource, table: str) -> Count:
    """Counts that the database makes; only cells come back."""

    def count(spans: list[tuple[int, int]], width: int) -> dict[int, int]:
        where = " OR ".join(f"(game_seq >= {a} AND game_seq < {b})" for a, b in spans)
        cell = f"game_seq - MOD(game_seq, {width})"
        asked = f"(SELECT {cell} AS cell, COUNT(*) AS n FROM {table} WHERE {where} GROUP BY {cell}) counted"
        rows = spark.read.jdbc(source.url, asked, properties=source.properties).collect()
        return {int(r["cell"]): int(r["n"]) for r in rows}

    return count


def _counted(count: Count, spans: list[tuple[int, int]], width: int, size: RangeSize) -> Iterator[tuple[int, int]]:
    """First game and rows of cells in order, each light or a single game: cells
    of too many rows are counted again at a finer width."""
    for at in range(0, len(spans), size.spans):
        part = spans[at : at + size.spans]
        cells = sorted(count(part, width).items())
        heavy = [(max(c, a), min(c + width, b)) for c, n in cells for a, b in part if n > size.rows and width > 1 and c < b and c + width > a]
        finer = _counted(count, heavy, max(1, width // size.cells), size) if heavy else iter(())
        inner = sorted(finer)
        light = [(c, n) for c, n in cells if n <= size.rows or width == 1]
        yield from sorted(light + inner)


def range_bounds(count: Count, games: tuple[int, int], size: RangeSize = RangeSize()) -> list[int]:
    """Games at which ranges begin, but for the first: neighbouring cells are put
    together up to the wanted rows. A game of more rows is a range of its own.
    `games` are the lowest and highest game, from 0 on."""
    low, high = games
    if low < 0 or high < low:
        raise ValueError(f"no range of games: {low} to {high}")
    width = 1
    while (high - low) // width >= size.cells:
        width *= size.cells
    bounds, rows = [], 0
    for first, n in _counted(count, [(low, high + 1)], width, size):
        if rows and rows + n > size.rows:
            bounds.append(first)
            rows = 0
        rows += n
    return bounds


def predicates(bounds: list[int]) -> list[str]:
    """One condition for each range; every row meets exactly one, also a row
    without a game or outside the games that were counted."""
    if not bounds:
        return ["game_seq IS NOT NULL OR game_seq IS NULL"]
    inner = [f"game_seq >= {a} AND game_seq < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"game_seq < {bounds[0]} OR game_seq IS NULL", *inner, f"game_seq >= {bounds[-1]}"]


def keep_ranges(
    spark: SparkSession,
    source: JdbcSource,
    table: str,
    folder: str,
    games: tuple[int, int],
    size: RangeSize = RangeSize(),
) -> DataFrame:
    """A table read in ranges and kept as Parquet. Called again after it broke
    off, it goes on: the ranges are noted before the first is read, and every job
    notes the folder that it has filled; folders without a note are not read.

    Ranges are read at different times. Rows of a game that is over do not
    change; one that is still played may be seen half.
    """
    noted = read_note(spark, f"{folder}/_ranges")
    if noted is None:
        noted = json.dumps(range_bounds(counter(spark, source, table), games, size))
        write_note(spark, f"{folder}/_ranges", noted)
    wanted = predicates(json.loads(noted))
    properties = {"fetchsize": str(source.fetch_size), **source.properties}
    return _kept_by_jobs(
        spark,
        folder,
        [
            lambda part=wanted[at : at + size.per_job]: spark.read.jdbc(source.url, table, predicates=part, properties=properties)
            for at in range(0, len(wanted), size.per_job)
        ],
    )


def _kept_by_jobs(spark: SparkSession, folder: str, jobs: list[Callable[[], DataFrame]]) -> DataFrame:
    filled = []
    for number, read in enumerate(jobs):
        name = read_note(spark, f"{folder}/_done/{number}")
        if name is None:
            name = f"{number}-{uuid.uuid4().hex}"
            read().write.parquet(f"{folder}/{name}")
            write_note(spark, f"{folder}/_done/{number}", name)
        filled.append(f"{folder}/{name}")
    return spark.read.parquet(*filled)


def read_jdbc_in_ranges(
    spark: SparkSession,
    source: JdbcSource,
    games: tuple[int, int],
    folder: str,
    names: TableNames = TableNames(),
    size: RangeSize = RangeSize(),
) -> Sources:
    """All tables of a database, kept in a folder on the way (see keep_ranges).
    A folder serves one landing, with one RangeSize."""
    root = folder.rstrip("/")
    pitches, log, trace = (
        keep_ranges(spark, source, name, f"{root}/{name}", games, size) for name in (names.pitches, names.pitch_log, names.trace)
    )
    players = _kept_by_jobs(
        spark, f"{root}/{names.players}", [lambda: spark.read.jdbc(source.url, names.players, properties=source.properties)]
    )
    return Sources.of(pitches, log, trace, players)
