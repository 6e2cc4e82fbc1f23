"""Parquet layouts: the landed source tables and the published fact."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pitchlake.schema import OUTPUT_COLUMNS
from pitchlake.session import dropping_shuffles, finer_partitions, writing
from pitchlake.sources.layout import FileLayout, Part, file_bounds, in_files, season_parts
from pitchlake.sources.readers import Sources, TableNames

VERSION = "version"
STATES = "_states"


def published(rows: DataFrame) -> DataFrame:
    return rows.select(*[f"`{name}`" for name in OUTPUT_COLUMNS])


@dataclass(frozen=True)
class Release:
    """What is published in a folder: a number, the version that holds each
    league's rows, by its level in lower case, and the schema of all. After runs
    that wrote some seasons only, `earlier` names the versions that hold the
    others, by level folder and season folder. `states` names what runs of
    changes know of each league's sources, by level."""

    number: int = 0
    versions: dict[str, str] = field(default_factory=dict)
    schema: str = ""
    earlier: dict[str, dict[str, str]] = field(default_factory=dict)
    states: dict[str, str] = field(default_factory=dict)

    def versions_of(self, folder: str, level: str) -> set[str]:
        return {*self.earlier.get(folder, {}).values(), *[self.versions[x] for x in (level,) if x in self.versions]}


class Releases:
    """The releases of a published fact, one small file each below `_releases`.
    The highest number counts. A file appears by one rename, so a reader sees
    the release before or the one after, never a part of one."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.root = path.rstrip("/")
        self._as_path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._as_path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._charset = spark._jvm.java.nio.charset.StandardCharsets.UTF_8
        self._read = spark._jvm.org.apache.commons.io.IOUtils.toString

    def _names(self, folder: str) -> list[str]:
        target = self._as_path(f"{self.root}/{folder}")
        return [f.getPath().getName() for f in self._files.listStatus(target)] if self._files.exists(target) else []

    def numbers(self) -> list[int]:
        return sorted(int(name) for name in self._names("_releases") if name.isdigit())

    def read(self, number: int) -> Release:
        stream = self._files.open(self._as_path(f"{self.root}/_releases/{number}"))
        try:
            return Release(number, **json.loads(self._read(stream, self._charset)))
        finally:
            stream.close()

    def current(self) -> Release:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else Release()

    def publish(self, release: Release) -> None:
        """Make a release the current one; fails if its number is taken."""
        draft = self._as_path(f"{self.root}/_releases/_draft-{uuid.uuid4().hex}")
        target = self._as_path(f"{self.root}/_releases/{release.number}")
        out = self._files.create(draft)
        try:
            named = {name: value for name, value in vars(release).items() if name != "number"}
            out.write(bytearray(json.dumps(named).encode()))
        finally:
            out.close()
        if self._files.exists(target) or not self._files.rename(draft, target):
            self._files.delete(draft, False)
            raise OSError(f"release {release.number} of {self.root} is there already: two jobs publish at once")

    def _levels(self) -> dict[str, str]:
        """Folders of the levels, and the level of each in lower case."""
        return {n: unquote(n.removeprefix("level=")).lower() for n in self._names("") if n.startswith("level=")}

    def folders(self, release: Release) -> list[str]:
        """The folders that hold a release; none of a league without rows."""
        found = []
        for folder, level in self._levels().items():
            version = f"{VERSION}={release.versions.get(level)}"
            found += [f"{self.root}/{folder}/{version}"] if version in self._names(folder) else []
            for season, earlier in release.earlier.get(folder, {}).items():
                found.append(f"{self.root}/{folder}/{VERSION}={earlier}/{season}")
        return found

    def after(self, before: Release, version: str, levels: Sequence[str], seasons: set[tuple[str, str]] | None) -> Release:
        """The release that follows when a version has replaced the levels (in
        lower case), or only the seasons of them that are given."""
        earlier = dict(before.earlier)
        for folder, level in self._levels().items():
            if level not in levels:
                continue
            there = dict(before.earlier.get(folder, {}))
            last = before.versions.get(level)
            there |= {name: last for name in self._names(f"{folder}/{VERSION}={last}") if name.startswith("game_year=")}
            gone = {f"game_year={int(season)}" for x, season in seasons or () if x == level}
            earlier[folder] = {} if seasons is None else {name: v for name, v in there.items() if name not in gone}
        versions = before.versions | dict.fromkeys(levels, version)
        return Release(before.number + 1, versions, before.schema, earlier, before.states)

    def clean(self, kept: int) -> None:
        """Delete older releases and all that no release left names, in the
        folders of the levels that are published, and states that none names."""
        numbers = self.numbers()
        left = [self.read(n) for n in numbers[-kept:]]
        for number in numbers[:-kept]:
            self._files.delete(self._as_path(f"{self.root}/_releases/{number}"), False)
        for folder, level in self._levels().items():
            named = {f"{VERSION}={v}" for r in left for v in r.versions_of(folder, level)}
            for name in self._names(folder) if named else ():
                if name not in named:
                    self._files.delete(self._as_path(f"{self.root}/{folder}/{name}"), True)
        states = {state for r in left for state in r.states.values()}
        for name in self._names(STATES):
            if name not in states:
                self._files.delete(self._as_path(f"{self.root}/{STATES}/{name}"), True)


#: Makes derived rows from the bounds of the files, their number, a folder that it
#: may fill on the way, and the parts that are written one after another: for each
#: part, or for all at once, one partition for each file, in order within it.
RowsInFiles = Callable[[DataFrame, int, str, Sequence[Part]], Iterable[DataFrame]]


def write_fact(
    rows: DataFrame | RowsInFiles,
    path: str,
    levels: Sequence[str],
    keys: DataFrame | None = None,
    layout: FileLayout = FileLayout(),
    kept_releases: int = 2,
    seasons: set[tuple[str, str]] | None = None,
    states: dict[str, str] | None = None,
) -> None:
    """Write derived rows (see `plans.fact.pitch_rows`) of the given levels, in
    game and pitch order, in place of what is there of these levels.

    The files of a season hold ranges of games that do not overlap, about as
    large as each other, in order; a season never lands in one task. The ranges
    come from a sample of `keys`: level, game_year, gameid and pitchno of the
    rows, from wherever they are cheap to read (the pitch table). Without them
    the rows are computed once more for it. Rows may come as a function that lays
    them into the files itself (`plans.fact.rows_in_files`), with `keys`; others
    are shuffled to their files as they are. A run writes a version
    of its own below each level; nothing reads it until the next release names
    it. So seasons that vanished go, other levels stay, and a run that dies at
    any step leaves the release before whole. The release before stays on disk
    for those who are reading it; all else below the published levels goes, what
    dead runs left too. One job publishes into a folder at a time.

    With `seasons` (level in lower case, season) the rows are of these only, and
    the other seasons of the levels stay in the versions that hold them. `states`
    are those of `plans.changes`; a level that is published without one has none.
    """
    known_by = keys if keys is not None else rows
    spark = known_by.sparkSession
    releases = Releases(spark, path)
    before = releases.current()
    version = f"v{before.number + 1}-{uuid.uuid4().hex}"
    bounds, files = file_bounds(known_by, layout)
    if isinstance(rows, DataFrame):
        placed = [in_files(rows, bounds, files)]
    else:  # no release names the folder, so it goes with the states that none names
        parts = season_parts(bounds, layout.files_per_write)
        placed = rows(bounds, files, f"{releases.root}/{STATES}/w-{uuid.uuid4().hex}", parts)
    for part in placed:
        stamped = published(part).withColumn(VERSION, F.lit(version))
        with writing(spark):
            stamped.write.mode("append").partitionBy("level", VERSION, "game_year").parquet(releases.root)
    lower = [level.lower() for level in levels]
    known = {level: state for level, state in before.states.items() if level not in lower} | (states or {})
    after = releases.after(before, version, lower, seasons)
    releases.publish(replace(after, schema=stamped.schema.json(), states=known))
    releases.clean(kept_releases)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The current release. Its versions are folders; no others are listed or
    opened."""
    releases = Releases(spark, path)
    release = releases.current()
    if not release.versions:
        raise FileNotFoundError(f"nothing is published in {path}")
    shape = T.StructType.fromJson(json.loads(release.schema))
    folders = releases.folders(release)
    if not folders:
        return published(spark.createDataFrame([], shape))
    return published(spark.read.schema(shape).option("basePath", releases.root).parquet(*folders))


def _read_as_they_lie(rows: DataFrame) -> bool:
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return "FileScan parquet" in plan and not re.search("Exchange|Generate|Join|Union|Coalesce", plan)


def land_sources(
    sources: Sources,
    folder: str,
    names: TableNames = TableNames(),
    derive: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> None:
    """Land source tables as Parquet, for jobs that read them more than once.

    Pitches go by level, so that a league prunes folders, and in game order, so
    that a season floor or window prunes row groups.

    `derive` makes the columns of a table (by field of `sources`) of the narrow
    rows that stand there instead. Those are shuffled and sorted, and the columns
    are made where the rows are written: a wide table is not shuffled then. The
    narrow rows need level and gameid, or game_seq, under these names. Rows that
    are read from Parquet as they lie are cut evenly by their reader: they are put
    in order within its tasks and not shuffled.
    """
    root, derive = folder.rstrip("/"), derive or {}
    spark = sources.pitches.sparkSession
    for field, name in vars(names).items():
        rows = getattr(sources, field)
        placed = rows
        if not _read_as_they_lie(rows):
            placed = rows.hint("rebalance", "level") if field == "pitches" else rows.hint("rebalance")
        if field == "pitches":
            placed = placed.sortWithinPartitions("level", "gameid")
        elif "game_seq" in rows.columns:  # in game order, for jobs that want some games
            placed = placed.sortWithinPartitions("game_seq")
        table = derive[field](placed) if field in derive else placed
        by = ["level"] if field == "pitches" else None
        with dropping_shuffles(spark), finer_partitions(spark, len(table.columns) / len(rows.columns)):
            table.write.parquet(f"{root}/{name}", partitionBy=by, compression="zstd")
