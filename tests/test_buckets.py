"""Log and trace in buckets: same rows, no shuffle of them."""

import re

import pytest

from pitchlake import leagues as lg
from pitchlake.operators.joins import JoinLimits
from pitchlake.operators.multiplicity import repeated_keys
from pitchlake.operators.pitch_joins import LOG_KEY
from pitchlake.plans import extract as ex, fact
from pitchlake.session import scratch_path
from pitchlake.sources import BucketSize, bucket_landed, land_sources, read_parquet

SMALL = BucketSize(bytes=8 << 10)


@pytest.fixture(scope="module")
def landed(spark, sources):
    folder = scratch_path(spark, "landed")
    land_sources(sources, folder)
    made = bucket_landed(spark, folder, size=SMALL)
    assert all(n > 1 for n in made.values()) and set(made) == {"pitch_log", "pitch_trace"}
    assert bucket_landed(spark, folder, size=SMALL) == made
    return folder


@pytest.fixture
def without_broadcasts(spark):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in zip(settings, ("-1", "false"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def lines_of(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def depth(line):
    return re.match(r"[ :+-]*", line).end()


def exchanges_above(lines, column):
    """Exchanges between the scan of a column's table and the join it goes to."""
    at = next(i for i, line in enumerate(lines) if "Scan" in line and re.search(rf"\b{column}#", line))
    found = []
    while "LeftOuter" not in lines[at]:
        found += [lines[at]] if "Exchange" in lines[at] else []
        at = next(i for i in range(at, -1, -1) if depth(lines[i]) < depth(lines[at]))
    return found


@pytest.mark.parametrize("partitions", ["2", "64"])
def test_log_and_trace_are_not_shuffled(spark, landed, without_broadcasts, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        plain = lines_of(ex.extract(read_parquet(spark, landed, buckets=False)))
        lines = lines_of(ex.extract(read_parquet(spark, landed)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for column in ("pit_kind_cd", "x5"):
        assert exchanges_above(plain, column) and not exchanges_above(lines, column)
    assert sum("Exchange hashpartitioning" in line for line in plain) == 4
    assert sum("Exchange hashpartitioning" in line for line in lines) == 2


def test_cut_to_games_keeps_the_buckets(spark, landed, without_broadcasts):
    lines = lines_of(ex.extract(read_parquet(spark, landed), (lg.KBO,)))
    assert sum("LeftSemi" in line for line in lines) == 2
    assert sum("Exchange hashpartitioning(game_seq" in line for line in lines) == 2
    many = JoinLimits(broadcast_bytes=0)  # more games than may be sent to all tasks
    lines = lines_of(ex.extract(read_parquet(spark, landed), (lg.KBO,), many))
    assert sum("LeftSemi" in line for line in lines) == 0
    assert sum("Exchange hashpartitioning(game_seq" in line for line in lines) == 2


def test_repeated_keys_are_found_without_a_shuffle(spark, landed, without_broadcasts):
    log = read_parquet(spark, landed).pitch_log
    assert not any("Exchange" in line for line in lines_of(log.groupBy(*LOG_KEY).count()))
    assert repeated_keys(log, LOG_KEY).table.count() > 0


def test_fact_is_the_same(spark, sources, landed):
    got, want = fact.pitch_fact(read_parquet(spark, landed), (lg.KBO,)), fact.pitch_fact(sources, (lg.KBO,))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_table_with_a_hot_key_gets_no_buckets(spark, sources):
    folder = scratch_path(spark, "landed")
    land_sources(sources, folder)
    hot = sources.pitch_log.limit(1).crossJoin(spark.range(60)).drop("id")
    hot.write.mode("append").parquet(f"{folder}/pitch_log")
    keyless = sources.trace.limit(60).withColumns({name: ex.F.lit(None).cast("int") for name in ("pitch_no",)})
    keyless.write.mode("append").parquet(f"{folder}/pitch_trace")
    assert bucket_landed(spark, folder, limits=JoinLimits(rows_per_split=50)) == {"pitch_log": 0, "pitch_trace": 0}
    assert read_parquet(spark, folder).in_buckets == frozenset()
    assert bucket_landed(spark, folder)["pitch_log"] == 1
    assert read_parquet(spark, folder).in_buckets == {"pitch_log", "trace"}


def test_buckets_hold_few_rows_however_well_they_are_packed(spark, sources):
    """A packed table of many rows was one bucket, and so one task of its join."""
    folder = scratch_path(spark, "landed")
    land_sources(sources, folder)
    rows = sources.pitch_log.count()
    made = bucket_landed(spark, folder, size=BucketSize(rows=500))
    assert made["pitch_log"] == -(-rows // 500) > 1
    assert read_parquet(spark, folder).pitch_log.exceptAll(sources.pitch_log).count() == 0


def test_a_run_that_dies_leaves_nothing_that_is_read(spark, sources, monkeypatch):
    from pitchlake.sources import buckets

    folder = scratch_path(spark, "landed")
    land_sources(sources, folder)

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(buckets, "write_note", die)
        with pytest.raises(OSError, match="lost"):
            bucket_landed(spark, folder)
    assert read_parquet(spark, folder).in_buckets == frozenset()
    assert bucket_landed(spark, folder, size=SMALL)["pitch_log"] > 1
    assert read_parquet(spark, folder).pitch_log.exceptAll(sources.pitch_log).count() == 0
