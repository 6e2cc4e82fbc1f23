"""Hot keys are split without changing a row."""

import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pitchlake import leagues as lg
from pitchlake.functions import pitches
from pitchlake.operators.joins import (
    HotKeys,
    JoinLimits,
    find_hot_keys,
    lookup,
    measured_bytes,
    split_left_join,
)
from pitchlake.operators.players import ROLES, player_dimension, players_in_use
from pitchlake.plans.extract import wanted_pitches
from pitchlake.plans.fact import pitch_fact

TINY = JoinLimits(broadcast_bytes=0, rows_per_split=20)


def rows(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def left(spark):
    hot = [(1, "a", i) for i in range(300)]
    copies = [(2, "b", 7)] * 100
    few = [(3, "c", 1), (3, "c", 2)]
    unmatched = [(k, "d", k) for k in range(10, 30)]
    nulls = [(None, "a", i) for i in range(60)] + [(1, None, 5)] * 40
    schema = "k int, t string, v int"
    return spark.createDataFrame(hot + copies + few + unmatched + nulls, schema)


@pytest.fixture(scope="module")
def right(spark):
    one = [(1, "a", "x"), (1, "a", "y"), (2, "b", "z")]
    hot = [(3, "c", f"w{i % 50}") for i in range(200)]
    copies = [(4, "e", "same")] * 90
    return spark.createDataFrame(one + hot + copies + [(None, "a", "n")], "k int, t string, w string")


def test_hot_keys_are_found_and_only_those(left, right):
    on = ["k", "t"]
    hot = find_hot_keys({"l": (left, on), "r": (right, on)}, TINY)
    assert rows(hot["l"].table) == Counter({(1, "a", 15): 1, (2, "b", 5): 1})
    assert hot["l"].null_parts == 5
    assert rows(hot["r"].table) == Counter({(3, "c", 10): 1, (4, "e", 5): 1})
    assert not find_hot_keys({"l": (left, on)})["l"]


def test_split_join_equals_plain_join(left, right):
    on = ["k", "t"]
    hot = find_hot_keys({"l": (left, on), "r": (right, on)}, TINY)
    split = split_left_join(left, right, on, hot["l"], hot["r"])
    plain = left.join(right, on, "left").select(split.columns)
    assert split.columns == ["k", "t", "v", "w"]
    assert rows(split) == rows(plain)


@pytest.mark.parametrize("small", [True, False])
def test_key_hot_on_both_sides(spark, left, right, small):
    table = spark.createDataFrame([(1, "a", 4), (3, "c", 3)], "k int, t string, parts int")
    both = HotKeys(table, small=small)
    split = split_left_join(left, right, ["k", "t"], both, both)
    assert rows(split) == rows(left.join(right, ["k", "t"], "left"))


@pytest.mark.parametrize("n", [5_000, 50_000])
def test_every_hot_key_is_found_however_many(spark, n):
    """Twice the limit in each of n keys, and one row in each of as many more."""
    keys = spark.range(2 * n).select((F.col("id") % n).alias("k"))
    found = find_hot_keys({"l": (keys.unionAll(spark.range(n, 2 * n).toDF("k")), ["k"])}, JoinLimits(rows_per_split=1))["l"]
    assert found.table.count() == n and found.table.where("parts != 2 or k >= %d" % n).count() == 0
    plan = keys.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan


def test_rows_of_one_key_without_an_id_are_spread(spark, sources):
    """1,000 pitches of one log key, no pitchuid, equal numbers: several tasks."""
    from pitchlake.operators.pitch_joins import LOG_KEY, join_pitch_log

    one = sources.pitches.limit(1).drop("pitchuid", "relspeed")
    many = one.crossJoin(spark.range(1000).select(F.col("id").cast("double").alias("relspeed")))
    many = many.withColumn("pitchuid", F.lit(None).cast("string"))
    hot = find_hot_keys({"l": (many, LOG_KEY)}, JoinLimits(rows_per_split=50))["l"]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_pitch_log(many, sources.pitch_log, hot)
        assert joined.select(F.spark_partition_id()).distinct().count() > 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_reaches_several_tasks(spark, left, right):
    on = ["k", "t"]
    hot = find_hot_keys({"l": (left, on)}, TINY)
    shuffled = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in shuffled}
    for name, value in shuffled.items():
        spark.conf.set(name, value)
    try:

        def tasks_of_key(joined):
            placed = joined.where("k = 1 and t = 'a'").select(F.spark_partition_id(), "v")
            return len({task for task, _ in placed.collect()})

        assert tasks_of_key(split_left_join(left, right, on)) == 1
        assert tasks_of_key(split_left_join(left, right, on, hot["l"])) > 3
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_lookup_beyond_the_broadcast_limit(left, right):
    size = measured_bytes(right)
    assert size > 0
    wide = lookup(left, right, ["k", "t"], size, TINY)
    assert rows(wide) == rows(lookup(left, right, ["k", "t"], size))


def test_fact_is_the_same_under_tiny_limits(sources):
    columns = ["pitchuid", "zone", "NAME_batter", "NAME_catcher", "p_throws", "p_type", "x50"]
    limits = JoinLimits(broadcast_bytes=0, rows_per_split=30)
    tiny = pitch_fact(sources, limits=limits).select(columns)
    assert rows(tiny) == rows(pitch_fact(sources).select(columns))


def test_repeated_log_and_trace_rows_fan_out(sources):
    """Keys that occur twice in log or trace, and joins on their own numbers."""
    from pitchlake.operators.pitch_joins import join_pitch_tables

    keys = sources.pitches.select("game_seq", "pit_seq", "pitchno")
    log = sources.pitch_log.select("game_seq", "pit_seq", "field_if")
    trace = sources.trace.select("game_seq", "pitch_no", "x5")
    log = log.unionAll(log.where("pit_seq = 2").withColumn("field_if", F.lit("again")))
    trace = trace.unionAll(trace.where("pitch_no % 3 = 0"))
    logged = Counter(tuple(r)[:2] for r in log.collect())
    traced = Counter(tuple(r)[:2] for r in trace.collect())
    want = Counter()
    for game, at, number in keys.collect():
        want[game, at, number] += max(1, logged[game, at]) * max(1, traced[game, number])
    for limits in (JoinLimits(), JoinLimits(rows_per_split=1)):
        joined = join_pitch_tables(keys, log, trace, limits)
        assert rows(joined.select("game_seq", "pit_seq", "pitchno")) == want


def test_pitch_keys_are_counted_once(monkeypatch, sources):
    """Lookups too large for a broadcast: one pass over each table, whatever the
    number of joins."""
    from pitchlake.operators import joins

    passes = []

    def counted(df):
        passes.append(df.columns)
        return settle(df)

    settle = joins.settle
    monkeypatch.setattr(joins, "settle", counted)
    pitch_fact(sources, limits=TINY)
    assert len(passes) == 4  # pitches, log, trace, players
    assert sorted(map(len, passes)) == [4, 4, 4, 14]


def test_hot_keys_are_found_from_a_sample_and_counted_exactly(spark):
    """Keys beyond the limit, near it and far below, and rows without a key."""
    sizes = {**{k: 4_001 + k for k in range(40)}, **{k: 1_500 for k in range(40, 60)}, **{k: 30 for k in range(60, 900)}, 900: 2_000}
    listed = spark.createDataFrame(list(sizes.items()), "k int, n int")
    keys = listed.select("k", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))
    keys = keys.unionAll(spark.range(9_000).select(F.lit(None).cast("int"), F.lit(0).cast("int")))
    limits = JoinLimits(rows_per_split=2_000)
    hot = find_hot_keys({"l": (keys, ["k"])}, limits)["l"]
    assert rows(hot.table) == Counter({(k, -(-n // 2_000)): 1 for k, n in sizes.items() if n > 2_000})
    assert hot.null_parts == 5
    assert not find_hot_keys({"l": (keys, ["k"])}, JoinLimits(rows_per_split=20_000))["l"]


def test_hot_keys_of_several_joins_from_one_sample(spark):
    from pitchlake.operators.joins import hot_keys_by

    both = spark.range(30_000).select((F.col("id") % 5).alias("a"), (F.col("id") % 29_000).alias("b"), F.lit("x").alias("c"))
    found = hot_keys_by(both, {"a": ["a"], "b": ["b"], "ab": ["a", "b"], "ca": ["c", "a"]}, JoinLimits(rows_per_split=1_000))
    assert rows(found["a"].table) == Counter({(k, 6): 1 for k in range(5)})
    assert rows(found["ca"].table) == Counter({("x", k, 6): 1 for k in range(5)})
    assert not found["b"] and not found["ab"]


def test_sample_of_cold_keys_counts_nothing_exactly(monkeypatch, spark):
    from pitchlake.operators import joins

    monkeypatch.setattr(joins, "settle", lambda df: pytest.fail("no key is likely to be hot"))
    assert not find_hot_keys({"l": (spark.range(50_000).toDF("k"), ["k"])})["l"]


def test_large_player_table_with_few_in_use_is_broadcast(spark, sources):
    """An archive of players, of whom the league names few, is cut before it is measured."""
    unused = spark.range(20_000).selectExpr("'2023' game_year", "concat('no-', id) tm_id", "'N' name", "'6-1' height")
    archive = replace(sources, players=sources.players.unionByName(unused))
    wanted = wanted_pitches(sources, (lg.KBSA,)).withColumn("game_year", pitches.season(F.col("gameid")))
    limits = JoinLimits(broadcast_bytes=measured_bytes(player_dimension(archive.players)) - 1)
    cut = players_in_use(archive.players, wanted, limits=limits)
    ids = {(r["game_year"], r[role.id_column]) for r in wanted.collect() for role in ROLES}
    want = [r for r in sources.players.select(*cut.columns).collect() if (r["game_year"], r["tm_id"]) in ids]
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, want)) and want
    whole = replace(limits, broadcast_bytes=limits.broadcast_bytes + 1)
    assert players_in_use(archive.players, wanted, limits=whole) is archive.players

    columns = ["pitchuid", "NAME_batter", "NAME_pitcher", "NAME_catcher", "Height", "zone"]
    got = pitch_fact(archive, (lg.KBSA,), limits).select(columns)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"BroadcastHashJoin \[game_year#\d+, (?:batter|pitcher|catcher)id#\d+\]", plan)) == 3
    assert rows(got) == rows(pitch_fact(sources, (lg.KBSA,)).select(columns))


def test_pitch_tables_are_not_broadcast_by_their_stored_size(sources):
    """A packed side of millions of rows is a few MB as stored."""
    from pitchlake.operators.joins import split_left_join
    from pitchlake.operators.pitch_joins import join_pitch_tables

    joined = join_pitch_tables(sources.pitches.select("game_seq", "pit_seq", "pitchno"), sources.pitch_log, sources.trace)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan
    assert split_left_join(sources.pitches, sources.pitch_log, ["game_seq", "pit_seq"]).columns


def test_large_player_table_takes_one_wide_shuffle(spark, sources):
    """All keys meet their sides first; rows without keys and repeated rows stay."""
    from dataclasses import replace

    from pitchlake.plans import fact

    few = sources.pitches.limit(40)
    nulled = [few.withColumn(name, F.lit(None).cast(few.schema[name].dataType)) for name in ("pit_seq", "pitchno", "game_seq", "batterid")]
    odd = sources.pitches.unionByName(few)
    for part in nulled:
        odd = odd.unionByName(part)
    odd = replace(sources, pitches=odd)
    many = JoinLimits(broadcast_bytes=0)
    want, got = fact.pitch_fact(odd), fact.pitch_fact(odd, limits=many)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
    # The carried struct is made in the scan of the wide rows and goes through one exchange.
    assert sum("Exchange hashpartitioning(_key#" in line for line in plan) == 2
