"""Arm slots from the pitch table alone equal those of the joined pitches."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from pitchlake import leagues as lg
from pitchlake.operators import arm_slot
from pitchlake.operators.joins import JoinLimits
from pitchlake.operators.multiplicity import repeated_keys, weigh
from pitchlake.operators.players import add_players
from pitchlake.plans import fact
from pitchlake.plans.arms import weighed_pitches
from pitchlake.plans.extract import extract
from pitchlake.sources import Sources

LIMITS = [JoinLimits(), JoinLimits(broadcast_bytes=0, rows_per_split=30)]


def rows(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def repeating(sources):
    """Log, trace and players that hold some keys two, three and more times, and
    NULL keys; pitches that come twice."""
    log, trace, players = sources.pitch_log, sources.trace, sources.players
    log = log.unionAll(log.where("pit_seq % 3 = 0")).unionAll(log.where("pit_seq % 6 = 0"))
    log = log.unionAll(log.limit(5).withColumn("game_seq", F.lit(None).cast(log.schema["game_seq"].dataType)).select(log.columns))
    trace = trace.unionAll(trace.where("pitch_no % 4 = 1"))
    players = players.unionAll(players.limit(200)).unionAll(players.limit(50))
    return Sources(sources.pitches.unionAll(sources.pitches.limit(100)), log, trace, players)


@pytest.mark.parametrize("limits", LIMITS)
@pytest.mark.parametrize("leagues", [lg.LEAGUES, (lg.KBO, lg.NPB)])
def test_weights_stand_for_the_joins(repeating, limits, leagues):
    joined = fact.with_numeric_ids(add_players(extract(repeating, leagues), repeating.players))
    weighed = weighed_pitches(repeating, leagues, limits)
    assert weighed.agg(F.max("weight")).first()[0] >= 12
    assert rows(arm_slot.release_heights(weighed)) == rows(arm_slot.release_heights(joined))
    assert rows(arm_slot.pitcher_arms(weighed)) == rows(arm_slot.pitcher_arms(joined))


def test_weight_is_the_number_of_joined_rows(spark):
    left = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate([(1, "a"), (1, "b"), (2, "a"), (None, "a"), (3, None)])], "i int, k int, t string")
    one = spark.createDataFrame([(1, "x"), (1, "y"), (1, "z"), (2, "x"), (None, "x"), (None, "y")], "key int, v string")
    two = spark.createDataFrame([("a",), ("a",), ("c",), (None,), (None,)], "t string")
    sides = [(repeated_keys(one, ["key"]), ["k"], None), (repeated_keys(two, ["t"]), ["t"], None)]
    for limits in LIMITS:
        got = {r["i"]: r["weight"] for r in weigh(left, sides, limits).collect()}
        assert got == {0: 6, 1: 3, 2: 2, 3: 2, 4: 1}
    none = repeated_keys(two.where("t = 'c'"), ["t"])
    assert none.n_bytes == 0 and {r["weight"] for r in weigh(left, [(none, ["t"], None)]).collect()} == {1}


def test_arms_take_no_wide_join(spark, sources):
    """One scan of the pitches, and no shuffle of them but for the pitchers' sums."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, "-1")
    try:
        plan = arm_slot.pitcher_arms(weighed_pitches(sources))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(name)
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
