"""Landing: wide columns are made behind the shuffle of what they are made of."""

import datetime as dt
from pathlib import Path
from urllib.parse import unquote

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from checks import fixtures
from pitchlake.session import dropping_shuffles, scratch_path, settle
from pitchlake.sources import Sources, land_sources, read_parquet


@pytest.fixture(scope="module")
def tables(spark):
    """Driver tables of a few orders, one of them listed twice."""
    folder = scratch_path(spark, "tables")
    orders = [(n, n % 23, dt.date(2020 + n % 5, 1 + n % 12, 1 + n % 28)) for n in range(1, 200)] + [(11, 4, dt.date(2021, 3, 4))]
    lines = [(n, k, (n * 7 + k) % 40, n % 9) for n in range(1, 210) for k in range(1, 8)] + [(5, 1, 1, 1)]
    for name, rows, shape in (
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate date"),
        ("lineitem", lines, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long"),
        ("part", [(n, f"part {n}") for n in range(40)], "p_partkey long, p_name string"),
    ):
        spark.createDataFrame(rows, shape).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_landed_rows_are_those_of_the_derived_tables(spark, tables):
    narrow, derive = fixtures.narrow_sources(spark, tables)
    folder = scratch_path(spark, "landed")
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    try:
        land_sources(narrow, folder, derive=derive)
        landed, whole = read_parquet(spark, folder), fixtures.derived_sources(spark, tables)
        for field in ("pitches", "pitch_log", "trace", "players"):
            found, wanted = getattr(landed, field), getattr(whole, field)
            assert found.dtypes == wanted.dtypes and found.count() == wanted.count() > 0
            assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    finally:
        spark.conf.unset("spark.sql.codegen.wholeStage")


def test_only_narrow_rows_are_shuffled_and_files_stay_in_order(spark, sources):
    seen = {}

    def wider(rows):
        seen["columns"], seen["plan"] = rows.columns, rows._jdf.queryExecution().optimizedPlan().toString()
        return rows.selectExpr("*", *[f"concat(gameid, '-{n}') as w{n}" for n in range(50)])

    narrow = sources.pitches.select("level", "gameid", "game_seq").repartition(3)  # not as files lie
    folder = scratch_path(spark, "landed")
    given = Sources(narrow, sources.pitch_log, sources.trace, sources.players)
    land_sources(given, folder, derive={"pitches": wider})
    assert seen["columns"] == ["level", "gameid", "game_seq"] and "Rebalance" in seen["plan"]
    landed = spark.read.parquet(f"{folder}/pitches")
    assert landed.count() == narrow.count() and len(landed.columns) == 53
    assert landed.where("w49 <> concat(gameid, '-49')").isEmpty()
    for file in map(unquote, landed.inputFiles()):
        games = [r[0] for r in spark.read.parquet(file).coalesce(1).select("gameid").collect()]
        assert games == sorted(games)


def test_tables_in_files_are_landed_without_a_shuffle(spark, sources, monkeypatch):
    plans = []
    real = DataFrameWriter.parquet

    def noted(self, path, *args, **named):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return real(self, path, *args, **named)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    folder = scratch_path(spark, "landed")
    land_sources(sources, folder)
    monkeypatch.undo()
    assert len(plans) == 4 and not any("Exchange" in plan for plan in plans)
    landed = read_parquet(spark, folder)
    for field in ("pitches", "pitch_log", "trace", "players"):
        found, wanted = getattr(landed, field), getattr(sources, field)
        assert found.count() == wanted.count() and found.exceptAll(wanted).isEmpty()


def test_shuffles_of_what_settles_go(spark):
    left = lambda: {str(f) for f in Path(spark.conf.get("spark.local.dir", "/tmp")).glob("blockmgr-*/*/shuffle_*.data")}
    before = left()
    settled = settle(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    assert left() <= before and settled.count() == 10


def test_settings_come_back_after_a_landing(spark, sources):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    with dropping_shuffles(spark):
        pass
    land_sources(sources, scratch_path(spark, "landed"))
    assert spark.conf.get(name) == before
