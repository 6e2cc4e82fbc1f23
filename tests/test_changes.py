"""Publishing what changed gives what a full run gives."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pitchlake import leagues as lg
from pitchlake.operators.arm_slot import ARM_KEY, heights_of, release_heights, season_sums
from pitchlake.plans import fact
from pitchlake.plans.arms import weighed_pitches
from pitchlake.plans.changes import differing, prints, publish_changes
from pitchlake.session import scratch_path
from pitchlake.sources import read_fact, sinks
from pitchlake.sources.sinks import Releases, published

SOME = (lg.KBSA, lg.NPB)
LEVELS = {league.level.lower() for league in SOME}


def assert_current(spark, path, sources, leagues=SOME):
    got, want = read_fact(spark, path), fact.pitch_fact(sources, leagues)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def with_trace(sources, game, column="x5"):
    """One value of one game's flight paths changed."""
    other = F.when(F.col("game_seq") == game, F.col(column) + 1).otherwise(F.col(column))
    return replace(sources, trace=sources.trace.withColumn(column, other))


def a_game(sources, level, of):
    """A traced game of a league, and its season."""
    own = sources.pitches.where((F.col("level") == level) & (F.col("gameid") >= "2024"))
    found = own.join(sources.trace.withColumnRenamed("pitch_no", "pitchno"), ["game_seq", "pitchno"])
    row = found.orderBy("game_seq").select("game_seq", F.substring("gameid", 1, 4).alias("year")).agg(of(F.struct("game_seq", "year"))).first()[0]
    return row["game_seq"], row["year"]


def test_changes_reach_their_seasons_only(spark, sources):
    path = scratch_path(spark, "published")
    everything = publish_changes(sources, path, SOME)
    assert {level for level, _ in everything} == LEVELS and len(everything) > 2

    assert publish_changes(sources, path, SOME) == set()
    assert Releases(spark, path).numbers() == [1]

    game, year = a_game(sources, lg.NPB.level, F.max)
    changed = with_trace(sources, game)
    assert publish_changes(changed, path, SOME) == {("npb", year)}
    versions = Releases(spark, path).current()
    [new] = [v for level, v in versions.versions.items() if level == "npb"]
    folders = [f for f in Releases(spark, path).folders(versions) if new in f]
    assert len(folders) == 1 and {r[0] for r in spark.read.parquet(folders[0]).select("game_year").distinct().collect()} == {int(year)}

    # Another game, in the other league: the first change stays where it is.
    other, season = a_game(sources, lg.KBSA.level, F.min)
    twice = with_trace(changed, other, "z5")
    assert publish_changes(twice, path, SOME) == {("kbsa", season)}
    assert_current(spark, path, twice)

    # A league published in the ordinary way has no state, and is published in full.
    fact.publish(twice, path, (lg.KBSA,))
    written = publish_changes(twice, path, (lg.KBSA,))
    assert written == {x for x in everything if x[0] == "kbsa"}
    states = {p.name for p in Path(path, "_states").iterdir()}
    assert states == {s for n in Releases(spark, path).numbers() for s in Releases(spark, path).read(n).states.values()}


def test_season_that_goes_and_pitchers_elsewhere(spark, sources):
    """Games that go take their season along; a pitcher whose mean they turn
    changes in every season."""
    leagues = (lg.NPB,)
    own = sources.pitches.where(F.col("level") == lg.NPB.level)
    years = sorted(r[0] for r in own.select(F.substring("gameid", 1, 4)).distinct().collect())
    last = years[-1]
    # One pitcher in two seasons, low only in the last.
    two = own.where(F.col("gameid") >= "2021").withColumn("relheight", F.when(F.col("gameid") >= last, F.lit(0.2)).otherwise(F.lit(2.0)).cast(sources.pitches.schema["relheight"].dataType))
    low = replace(sources, pitches=two.withColumn("pitcherid", F.lit("77")))
    path = scratch_path(spark, "published")
    publish_changes(low, path, leagues)
    gone = replace(low, pitches=low.pitches.where(F.col("gameid") < last))
    written = publish_changes(gone, path, leagues)
    slots = lambda s: {r[0] for r in fact.pitch_fact(s, leagues).select("p_type").distinct().collect()}
    assert ("npb", last) in written
    assert (len(written) > 1) == (slots(low) != slots(gone))
    assert int(last) not in {r[0] for r in read_fact(spark, path).select("game_year").distinct().collect()}
    assert_current(spark, path, gone, leagues)


def test_players_of_a_season(spark, sources):
    path = scratch_path(spark, "published")
    leagues = (lg.KBSA,)
    publish_changes(sources, path, leagues)
    name = F.when(F.col("game_year") == "2024", F.concat("name", F.lit("x"))).otherwise(F.col("name"))
    renamed = replace(sources, players=sources.players.withColumn("name", name))
    assert publish_changes(renamed, path, leagues) <= {("kbsa", "2024")}
    assert_current(spark, path, renamed, leagues)


def test_sums_add_up(sources):
    weighed = weighed_pitches(sources, SOME)
    one_run = release_heights(weighed)
    base, later = weighed.where("game_year < '2025'"), weighed.where("game_year >= '2025'")
    added = heights_of(season_sums(base).unionByName(season_sums(later)))
    assert base.count() and later.count()
    assert added.count() == one_run.count() and added.select(one_run.columns).exceptAll(one_run).count() == 0
    assert set(ARM_KEY) < set(one_run.columns)


@pytest.mark.parametrize(
    "before, after",
    [
        ([(1, 2, None)], [(1, None, 2)]),  # a value that moves to a column that was NULL
        ([(1, 2, 3), (1, 2, 3)], [(1, 2, 3)]),
        ([(1, 2, 3), (1, 2, 3)], [(1, 4, 5), (1, 4, 5)]),
        ([(1, None, None)], []),
        ([(None, 1, 1)], [(None, 1, 2)]),
    ],
)
def test_fingerprints_differ(spark, before, after):
    one, two = (prints(spark.createDataFrame(rows, "k int, a int, b int"), ["k"], "p") for rows in (before, after))
    assert differing(one, two).select("k").distinct().count() == 1
    assert differing(one, one).count() == 0


def test_wide_rows_of_a_run_of_changes_go_straight_to_their_files(spark, sources, monkeypatch):
    written = []
    monkeypatch.setattr(sinks, "published", lambda rows: written.append(rows) or published(rows))
    path = scratch_path(spark, "published")
    publish_changes(sources, path, SOME)
    monkeypatch.undo()
    plan = published(written[0])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange shufflepartitionidpassthrough") == 2  # pitches, and what their keys found
    assert "Exchange hashpartitioning" not in plan
    assert Releases(spark, path)._names("_states") == list(set(Releases(spark, path).current().states.values()))
