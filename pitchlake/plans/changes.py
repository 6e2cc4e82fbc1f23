"""Publish again only the seasons that changes of the sources reach.

A run keeps what it saw of the sources beside its release: a fingerprint per game
of pitches, log and trace, one per season of the players, and the sums of the
release heights by pitcher and season. The next run reads the sources once for
their fingerprints and compares. A season is written again if a game of it came,
went or changed, if its players changed, or if one of its pitchers changes arm
slot or hand by games elsewhere. A season is a folder, and so the least that is
written; its release heights are summed anew and added to the sums that are kept.

Fingerprints do not see a change of this library: after one, publish in full.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from pitchlake.functions import pitches
from pitchlake.leagues import LEAGUES, League
from pitchlake.operators.arm_slot import ARM_KEY, arms_of, heights_of, season_sums
from pitchlake.operators.joins import DEFAULT_LIMITS, JoinLimits
from pitchlake.plans.arms import weighed_pitches
from pitchlake.plans.extract import of_games, wanted_pitches, wanted_sides
from pitchlake.plans.fact import pitch_keys, rows_in_files
from pitchlake.session import settle, writing
from pitchlake.sources import Sources
from pitchlake.sources.layout import FileLayout
from pitchlake.sources.sinks import STATES, Releases, write_fact

SEASON = ["league", "game_year"]
Seasons = set[tuple[str, str]]


def _row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row. A hash passes over NULLs, so which columns are NULL
    is hashed with the values."""
    values = [F.col(f"`{c}`") for c in columns]
    nulls = [
        sum((F.when(v.isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, v in enumerate(values[at : at + 60])), F.lit(0).cast("long"))
        for at in range(0, len(values), 60)
    ]
    return [F.xxhash64(F.lit(seed), *nulls, *values) for seed in (1, 2)]


def prints(table: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Fingerprint of the rows of each key, in whatever order they lie: their
    number and two sums of 64-bit hashes, which repeated rows do not cancel."""
    columns = [c for c in table.columns if c not in keys]
    a, b = _row_hashes(columns)
    hashed = table.select(*[F.col(f"`{k}`") for k in keys], a.cast("decimal(20,0)").alias("a"), b.cast("decimal(20,0)").alias("b"))
    summed = hashed.groupBy(*keys).agg(F.struct(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).alias(name))
    return summed


def game_prints(sources: Sources, leagues: tuple[League, ...], sides: tuple[DataFrame, DataFrame]) -> DataFrame:
    """league, game_year, game_seq and the fingerprints of the game's rows in
    pitches, log and trace."""
    season = {"league": F.lower("level"), "game_year": pitches.season(F.col("gameid"))}
    found = prints(wanted_pitches(sources, leagues).withColumns(season), [*SEASON, "game_seq"], "pitches")
    for name, side in zip(("log", "trace"), sides, strict=True):
        found = found.join(prints(side, ["game_seq"], name), "game_seq", "left")
    return found.select(*SEASON, "game_seq", "pitches", "log", "trace")


def differing(now: DataFrame, before: DataFrame) -> DataFrame:
    """Rows that only one of two tables of distinct rows holds, NULLs included."""
    both = now.withColumn("_in", F.lit(1)).unionByName(before.withColumn("_in", F.lit(-1)))
    return both.groupBy(*now.columns).agg(F.sum("_in").alias("_in")).where("_in <> 0").drop("_in")


def _pairs(rows: DataFrame) -> Seasons:
    """Seasons named in rows; a league has a few dozen at most."""
    return {(r["league"], r["game_year"]) for r in rows.select(*SEASON).distinct().collect()}


def _among(seasons: Seasons) -> Column:
    return reduce(or_, [(F.col("league") == x) & (F.col("game_year") == year) for x, year in sorted(seasons)], F.lit(False))


def of_seasons(sources: Sources, seasons: Seasons) -> Sources:
    """Pitches of some seasons; the bound on the game id reaches the scan."""
    game = F.col("gameid")
    wanted = [
        (F.lower("level") == level) & game.startswith(year) & (pitches.season(game) == year)
        for level, year in sorted(seasons)
    ]
    return replace(sources, pitches=sources.pitches.where(reduce(or_, wanted, F.lit(False))))


class _State:
    """What runs keep of the sources: games, players and arms of some leagues."""

    def __init__(self, releases: Releases, like: DataFrame) -> None:
        self.spark, self.root = like.sparkSession, f"{releases.root}/{STATES}"
        self.known = releases.current().states
        self.name = f"s-{uuid.uuid4().hex}"

    def keep(self, rows: DataFrame, table: str) -> DataFrame:
        path = f"{self.root}/{self.name}/{table}"
        with writing(self.spark):
            rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def before(self, table: str, level: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.root}/{self.known[level]}/{table}")

    def of_leagues(self, table: str, levels: list[str], like: DataFrame) -> DataFrame:
        """Rows of the leagues; each may have been kept by another run."""
        parts = [self.before(table, level, like).where(F.col("league") == level) for level in levels]
        return reduce(DataFrame.unionByName, parts)


def publish_changes(
    sources: Sources,
    path: str,
    leagues: tuple[League, ...] = LEAGUES,
    limits: JoinLimits = DEFAULT_LIMITS,
    layout: FileLayout = FileLayout(),
) -> Seasons:
    """Bring the published leagues up to date. Returns the seasons written again,
    (level in lower case, season); a run without changes makes no release. A
    league that was last published without a state is published in full, and so
    are the leagues that run with it."""
    releases = Releases(sources.pitches.sparkSession, path)
    state = _State(releases, sources.pitches)
    levels = [league.level.lower() for league in leagues]
    sides = wanted_sides(sources, leagues, limits)
    games = state.keep(game_prints(sources, leagues, sides), "games")
    listed = state.keep(prints(sources.players, ["game_year"], "players"), "players")
    everywhere = _pairs(games)
    if all(level in state.known for level in levels):
        kept = state.of_leagues("games", levels, games)
        changed = _pairs(differing(games, kept))
        for name in {state.known[level] for level in levels}:  # one comparison for each earlier run
            of_run = [level for level in levels if state.known[level] == name]
            years = {r["game_year"] for r in differing(listed, state.before("players", of_run[0], listed)).collect()}
            changed |= {(level, year) for level, year in everywhere if level in of_run and year in years}
        if not changed:
            releases.clean(2)
            return set()
    else:
        kept, changed = None, everywhere

    def cut(seasons: Seasons) -> tuple[Sources, tuple[DataFrame, DataFrame]]:
        if seasons == everywhere:
            return sources, sides
        part = of_seasons(sources, seasons)
        of_part = {"pitch_log": sources.pitch_log, "trace": sources.trace}
        return part, tuple(of_games(wanted_pitches(part, leagues), of_part, limits, sources.in_buckets))

    part, part_sides = cut(changed)
    fresh = season_sums(weighed_pitches(part, leagues, limits, part_sides))
    written = set(changed)
    if kept is None:
        sums = state.keep(fresh, "arms")
    else:
        before = state.of_leagues("arms", levels, fresh)
        sums = state.keep(fresh.unionByName(before.where(~_among(changed))), "arms")
        relabelled = differing(arms_of(heights_of(sums)), arms_of(heights_of(before))).select(*ARM_KEY).distinct()
        written |= _pairs(sums.join(relabelled, ARM_KEY, "left_semi"))
        if written != changed:
            part, part_sides = cut(written)
    rows = rows_in_files(part, leagues, limits, part_sides, settle(arms_of(heights_of(sums))))
    touched = [league.level for league in leagues if kept is None or league.level.lower() in {x for x, _ in written}]
    states = dict.fromkeys(levels, state.name)
    seasons = None if kept is None else written
    write_fact(rows, path, touched, pitch_keys(part, leagues), layout, seasons=seasons, states=states)
    return written
