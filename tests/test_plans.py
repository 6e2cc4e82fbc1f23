"""Plans, layouts and contracts."""

import subprocess
import sys
from pathlib import Path

import re

import pytest

from pitchlake import leagues as lg, schema
from pitchlake.job import main
from pitchlake.land import land
from pitchlake.plans import fact
from pitchlake.sources import JdbcSource, Sources, land_sources, read_fact, read_jdbc
from pitchlake.session import scratch_path, shuffle_partitions


@pytest.fixture(scope="module")
def kbo_plan(sources):
    plan = fact.pitch_fact(sources, (lg.KBO,))
    return plan._jdf.queryExecution().explainString(
        plan.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_plan_has_no_python_window_or_cartesian(kbo_plan):
    assert not re.search(r"Python|Window|Cartesian|NestedLoop", kbo_plan)


def test_filters_and_partitions_reach_the_scan(kbo_plan):
    assert "GreaterThanOrEqual(gameid,2021)" in kbo_plan
    assert re.search(r"PartitionFilters: .*koreabaseballorganization", kbo_plan)


def test_log_and_trace_are_cut_to_the_games_below_their_shuffle(spark, sources):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = fact.pitch_fact(sources, (lg.KBO,)).select("gameuid", "runner", "x5")
        lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set(name, before)
    cuts = [i for i, line in enumerate(lines) if "LeftSemi" in line]
    assert len(cuts) == 2
    for cut in cuts:
        above = next(line for line in reversed(lines[:cut]) if re.search("Exchange|Scan|LeftOuter", line))
        assert "Exchange hashpartitioning(game_seq" in above


def test_players_and_arms_are_broadcast(kbo_plan):
    assert kbo_plan.count("BroadcastHashJoin LeftOuter BuildRight") >= 4


def test_unread_columns_are_not_scanned(sources):
    plan = fact.pitch_fact(sources).select("zone")._jdf.queryExecution().optimizedPlan()
    assert "inducedvertbreak" not in plan.toString().split("Relation")[0]


def test_output_columns(sources):
    assert len(schema.OUTPUT_COLUMNS) == 198
    assert len({name.lower() for name in schema.OUTPUT_COLUMNS}) == 198
    assert fact.pitch_fact(sources).columns == schema.OUTPUT_COLUMNS


def test_sources_bind_by_name(sources):
    shuffled = sources.trace.select(*reversed(sources.trace.columns))
    bound = Sources.of(sources.pitches, sources.pitch_log, shuffled, sources.players)
    assert bound.trace.columns == list(schema.TRACE_COLUMNS)
    with pytest.raises(ValueError, match="x50"):
        Sources.of(sources.pitches, sources.pitch_log, shuffled.drop("x50"), sources.players)


def test_flags_hang_together(sources):
    broken = fact.pitch_fact(sources).where(
        "(z_in = 1) = (coalesce(z_out, 0) = 1)"
        " or (con = 1 and swing is null) or (hit = 1 and ab is null) or (ab = 1 and pa is null)"
        " or strkeout <> 0 or p_kind = 'OT'"
    )
    assert broken.count() == 0


def test_one_league_can_be_replaced_alone(spark, sources):
    path = scratch_path(spark, "fact")
    fact.publish(sources, path, (lg.AAA, lg.NPB))
    before = {r["level"]: r["count"] for r in read_fact(spark, path).groupBy("level").count().collect()}
    stale = spark.read.parquet(path).where("level = 'AAA'").limit(3).drop("level", "game_year")
    stale.write.parquet(f"{path}/level=AAA/game_year=1999")
    fact.publish(sources, path, (lg.AAA,))
    after = {r["level"]: r["count"] for r in read_fact(spark, path).groupBy("level").count().collect()}
    assert before == after and set(after) == {"AAA", "NPB"}
    assert read_fact(spark, path).where("game_year = 1999").count() == 0


def test_published_files_are_in_order(spark, sources):
    path = scratch_path(spark, "fact")
    fact.publish(sources, path, (lg.KBO,))
    order = ["gameid", "pitchno"]
    if not set(order) <= set(schema.OUTPUT_COLUMNS):
        order = [c for c in order if c in schema.OUTPUT_COLUMNS] or ["game_date"]
    for file in spark.read.parquet(path).inputFiles():
        values = [tuple(r) for r in spark.read.parquet(file).coalesce(1).select(*order[:1]).collect()]
        assert values == sorted(values)


def test_shuffle_partitions_follow_the_input():
    assert [shuffle_partitions(n) for n in (0, 10**9, 100 * 10**12)] == [200, 200, 372530]


@pytest.mark.parametrize("name, option", [("job.py", "--sources"), ("land.py", "--properties")])
def test_jobs_start_from_another_folder(tmp_path, name, option):
    script = Path(__file__).resolve().parents[1] / "pitchlake" / name
    run = subprocess.run([sys.executable, str(script), "--help"], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert run.returncode == 0 and option in run.stdout


def test_job_publishes_from_landed_tables(spark, sources):
    landed, out = scratch_path(spark, "landed"), scratch_path(spark, "out")
    land_sources(sources, landed)
    main(["--sources", landed, "--out", out, "--league", "KBSA"])
    published = read_fact(spark, out)
    assert published.columns == schema.OUTPUT_COLUMNS
    assert published.count() == fact.pitch_fact(sources, (lg.KBSA,)).count() > 0


def test_only_two_wide_shuffles_without_broadcasts(spark, sources):
    """One exchange per side of the two pitch joins; the filter below the first."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = fact.pitch_fact(sources)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    assert plan.count("Exchange hashpartitioning(game_seq") == 4
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("SortMergeJoin") == 2


def test_job_refuses_an_unknown_league():
    with pytest.raises(SystemExit):
        main(["--sources", "in", "--out", "out", "--league", "XYZ"])


class RecordingReader:
    """Stands in for a session's reader; no database is started for a test."""

    def __init__(self, tables):
        self.tables, self.calls = tables, {}

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **options):
        self.calls[table] = options
        return self.tables[table]


def recording_reader(sources):
    return RecordingReader(
        {
            "pitches": sources.pitches,
            "pitch_log": sources.pitch_log,
            "pitch_trace": sources.trace,
            "player_info": sources.players,
        }
    )


def test_fact_from_tables_landed_over_jdbc(spark, sources):
    landed, out = scratch_path(spark, "landed"), scratch_path(spark, "out")
    land(recording_reader(sources), JdbcSource("jdbc:mysql://host/db", {}), (1, 1000), landed)
    main(["--sources", landed, "--out", out, "--league", "AAA"])
    assert read_fact(spark, out).count() == fact.pitch_fact(sources, (lg.AAA,)).count() > 0


def test_jdbc_reads_pitch_tables_in_ranges(sources):
    reader = recording_reader(sources)
    source = JdbcSource("jdbc:mysql://host/db", {"user": "reader"}, partitions=16)
    read = read_jdbc(reader, source, (1, 1000))
    assert read.pitches.columns == [*schema.PITCH_COLUMNS, "date"]
    for table in ("pitches", "pitch_log", "pitch_trace"):
        options = reader.calls[table]
        assert (options["column"], options["numPartitions"]) == ("game_seq", 16)
    assert "column" not in reader.calls["player_info"]
    assert reader.calls["player_info"]["properties"]["user"] == "reader"
