"""Publishing a part of the seasons after another."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pitchlake import leagues as lg
from pitchlake.operators.joins import JoinLimits
from pitchlake.plans import fact
from pitchlake.session import scratch_path
from pitchlake.sources import read_fact, sinks
from pitchlake.sources.layout import FileLayout, season_parts
from pitchlake.sources.sinks import published


@pytest.mark.parametrize("limit", [64 << 20, 0])  # players and arms broadcast, or found by the keys
def test_seasons_are_shuffled_and_written_in_turn(spark, sources, monkeypatch, limit):
    limits, path = JoinLimits(broadcast_bytes=limit), scratch_path(spark, "published")
    odd = replace(
        sources,
        # Copies, and pitches of no game, which go to the first file.
        pitches=sources.pitches.unionAll(sources.pitches.where("game_seq % 50 = 0")).withColumn(
            "gameid", F.when(F.col("game_seq") % 31 != 0, F.col("gameid"))
        ),
    )
    leagues = (lg.KBSA, lg.AAA)
    counts = []
    monkeypatch.setattr(sinks, "published", lambda rows: counts.append(rows.count()) or published(rows))
    fact.publish(odd, path, leagues, limits, FileLayout(rows_per_file=40, files_per_write=6))
    monkeypatch.undo()
    assert len(counts) > 2
    got, want = read_fact(spark, path), fact.pitch_fact(odd, leagues, limits)
    assert got.count() == want.count() == sum(counts) and max(counts) < want.count() * 2 // 3
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_parts_hold_whole_seasons(spark):
    shape = "level string, game_year string, files int, first int, bounds array<int>"
    rows = [("A", "2020", 2, 0, None), ("A", "2021", 3, 2, None), ("B", None, 1, 5, None), ("B", "2020", 9, 6, None)]
    parts = season_parts(spark.createDataFrame(rows, shape), 5)
    assert [(p.first, p.files, len(p.seasons)) for p in parts] == [(0, 5, 2), (5, 1, 1), (6, 9, 1)]
    assert [p.files for p in season_parts(spark.createDataFrame([], shape), 5)] == [1]
