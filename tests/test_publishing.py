"""A published fact is whole at every step of a run that replaces it."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pitchlake import leagues as lg, schema
from pitchlake.operators.joins import JoinLimits
from pitchlake.plans import fact
from pitchlake.session import dropping_shuffles, scratch_path
from pitchlake.sources import read_fact, sinks
from pitchlake.sources.layout import FileLayout
from pitchlake.sources.sinks import Release, Releases, published, write_fact

LEVELS = [lg.KBO.level, lg.AAA.level]


@pytest.fixture(scope="module")
def rows(spark, sources):
    """A cut of the derived rows of two leagues, settled for many runs."""
    some = fact.pitch_rows(sources, (lg.KBO, lg.AAA)).where("pitchno <= 3")
    path = scratch_path(spark, "derived")
    some.write.parquet(path)
    return spark.read.schema(some.schema).parquet(path)


def counts(spark, path):
    found = read_fact(spark, path).groupBy("level", "game_year").count().collect()
    return {(r["level"], r["game_year"]): r["count"] for r in found}


def only(rows, *levels):
    return rows.where(F.col("level").isin([x.level for x in levels]))


@pytest.mark.parametrize("step", ["write", "publish", "clean"])
def test_run_that_dies_leaves_a_whole_release(spark, rows, monkeypatch, step):
    path = scratch_path(spark, "published")
    write_fact(rows, path, LEVELS)
    old = counts(spark, path)
    assert {level for level, _ in old} == set(LEVELS)
    half = rows.where("pitchno = 1")

    def fail(*_, **__):
        raise OSError("stopped")

    with monkeypatch.context() as patch:
        if step == "write":  # half of the files are there, the job is not done
            only(half, lg.KBO).withColumn("version", F.lit("v2-dead")).write.mode("append").partitionBy("level", "version", "game_year").parquet(path)
            patch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", fail)
        else:
            patch.setattr(Releases, step, fail)
        with pytest.raises(OSError):
            write_fact(only(half, lg.KBO), path, LEVELS[:1])
    now = counts(spark, path)
    if step == "clean":  # the new release is out, the old versions are still there
        assert {k: n for k, n in now.items() if k[0] == lg.AAA.level} == {k: n for k, n in old.items() if k[0] == lg.AAA.level}
        assert sum(now.values()) < sum(old.values())
    else:
        assert now == old
    write_fact(only(half, lg.KBO), path, LEVELS[:1])
    want = {k: n for k, n in old.items() if k[0] == lg.AAA.level}
    want |= {(r["level"], r["game_year"]): r["count"] for r in only(half, lg.KBO).groupBy("level", "game_year").count().collect()}
    assert counts(spark, path) == want


def test_versions_that_no_release_names_go(spark, rows):
    path = scratch_path(spark, "published")
    few = rows.where("pitchno = 1")
    for _ in range(4):
        write_fact(only(few, lg.KBO), path, LEVELS[:1])
    releases = Releases(spark, path)
    assert releases.numbers() == [3, 4]
    folders = {r[0].split("version=")[1].split("/")[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()}
    assert folders == {v for n in (3, 4) for v in releases.read(n).versions.values()} and len(folders) == 2


def test_reader_of_the_release_before_is_not_disturbed(spark, rows):
    path = scratch_path(spark, "published")
    write_fact(only(rows, lg.KBO), path, LEVELS[:1])
    reading = read_fact(spark, path)
    n = reading.count()
    write_fact(only(rows.where("pitchno = 1"), lg.KBO), path, LEVELS[:1])
    assert reading.count() == n > read_fact(spark, path).count()


def test_league_without_rows_vanishes_and_numbers_are_taken_once(spark, rows):
    path = scratch_path(spark, "published")
    write_fact(rows, path, LEVELS)
    write_fact(rows.limit(0), path, LEVELS[1:])
    assert {level for level, _ in counts(spark, path)} == {lg.KBO.level}
    with pytest.raises(OSError):
        Releases(spark, path).publish(Release(2, {}))
    with pytest.raises(FileNotFoundError):
        read_fact(spark, scratch_path(spark, "nothing"))


def test_other_versions_are_not_opened(spark, rows):
    path = scratch_path(spark, "published")
    write_fact(only(rows, lg.KBO), path, LEVELS[:1])
    write_fact(only(rows, lg.KBO), path, LEVELS[:1])
    version = Releases(spark, path).current().versions[lg.KBO.level.lower()]
    files = read_fact(spark, path).select(F.input_file_name().alias("f")).distinct()
    assert {version in r["f"] for r in files.collect()} == {True}
    assert all(version in f for f in read_fact(spark, path).inputFiles())
    write_fact(rows.limit(0), path, LEVELS[:1])
    assert read_fact(spark, path).count() == 0 and read_fact(spark, path).columns == schema.OUTPUT_COLUMNS


def shuffles(plan):
    """Columns of what each shuffle of a plan moves."""
    text = plan._jdf.queryExecution().executedPlan()
    found, todo = [], [text]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.inputPlan()
        if node.nodeName() == "Exchange":
            found.append(node.output().size())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.mark.parametrize("limit", [64 << 20, 0])  # players and arms broadcast, or found by the keys
def test_wide_rows_are_shuffled_once_and_before_they_are_derived(spark, sources, monkeypatch, limit):
    path, limits = scratch_path(spark, "published"), JoinLimits(broadcast_bytes=limit)
    twice = replace(
        sources,
        # Copies, and pitches without a number or a catcher, which must not be lost or doubled.
        pitches=sources.pitches.unionAll(sources.pitches.where("game_seq % 50 = 0")).withColumns(
            {
                "pitchno": F.when(F.col("pitchno") % 7 != 0, F.col("pitchno")),
                "catcherid": F.when(F.col("pit_seq") % 5 != 0, F.col("catcherid")),
            }
        ),
    )
    written = []
    monkeypatch.setattr(sinks, "published", lambda rows: written.append(rows) or published(rows))
    fact.publish(twice, path, (lg.KBO, lg.AAA), limits, FileLayout(rows_per_file=200))
    monkeypatch.undo()
    moved = shuffles(published(written[0]))
    assert len([n for n in moved if n > 20]) == 1 and max(moved) < 80
    got, want = read_fact(spark, path), fact.pitch_fact(twice, (lg.KBO, lg.AAA), limits)
    assert got.count() == want.count() > 500
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    releases = Releases(spark, path)
    assert releases._names("_states") == []  # what the keys found is gone


def test_hot_keys_of_log_and_trace_are_split_before_rows_go_to_files(spark, sources):
    path, limits = scratch_path(spark, "published"), JoinLimits(rows_per_split=3)
    hot = replace(sources, pitches=sources.pitches.withColumn("pit_seq", F.lit(1)))
    fact.publish(hot, path, (lg.KBO,), limits)
    got, want = read_fact(spark, path), fact.pitch_fact(hot, (lg.KBO,))
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_shuffles_of_a_write_are_gone_when_it_ends(spark, rows):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def stored():
        return {f for folder in folders for f in Path(folder).rglob("shuffle_*.data")}

    there = stored()
    with dropping_shuffles(spark):
        rows.repartition(5, "gameid").write.parquet(scratch_path(spark, "shuffled"))
    assert stored() <= there
    assert spark.conf.get(name) == before
