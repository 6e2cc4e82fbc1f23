"""What operators 5 and 7 hold and keep as their input grows."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from pitchlake.llm import near_duplicates as near, queries, storage, substrings
from pitchlake.llm.near_duplicates import ChosenPaths, near_duplicates
from pitchlake.llm.substrings import Passages, drop_repeats


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    queries.prepare(spark)


def test_readers_of_blocks_open_one_at_a_time(spark, monkeypatch):
    """A row group of many blocks is held whole by every task that reads it."""
    kept = []
    monkeypatch.setattr(substrings, "new_folder", lambda *a: kept.append(storage.new_folder(*a)) or kept[-1])
    rows = [(i, " ".join(f"w{(i * 31 + k) % 977}" for k in range(60))) for i in range(40)]
    given = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    drop_repeats(given, p=Passages(block_bytes=1000)).count()
    files = list(Path(kept[0], "blocks").glob("*.parquet"))
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert sum(g.num_rows for g in groups) > 10
    assert all(g.row_group(k).num_rows == 1 for g in groups for k in range(g.num_row_groups))


def test_packed_arrays_are_joined_from_any_slice():
    whole = [np.arange(n, dtype="<u8").tobytes() for n in (3, 1, 4, 2)]
    column = pa.chunked_array([pa.array(whole[:1], pa.binary()), pa.array(whole, pa.binary()).slice(1, 2), pa.array([], pa.binary())])
    assert substrings._joined(column, "<u8").tolist() == [0, 1, 2, 0, 0, 1, 2, 3]


def near_rows(n):
    """Short texts around a few stems, so that one cluster takes many blocks."""
    random.seed(3)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        stem = words[i % 3 * 20 : i % 3 * 20 + 20]
        text = stem[: 12 + i % 8] + [random.choice(words) for _ in range(random.randrange(4))]
        rows.append((i, " ".join(text)))
    return rows


def components_by_force(rows, percent=80):
    sets = {}
    for i, text in rows:
        w = text.split()
        sets[i] = {tuple(w[k : k + 2]) for k in range(len(w) - 1)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("tile_docs, tile_shingles", [(7, 1 << 19), (500, 150)])
def test_a_cluster_of_many_blocks_keeps_its_sets_once(spark, monkeypatch, tile_docs, tile_shingles):
    rows, kept, written_rows = near_rows(240), [], {}

    def folder(*a):
        kept.append(storage.new_folder(*a))
        return kept[-1]

    def written(df, name):
        out = storage.written(df, name)
        written_rows[name] = out.count()
        return out

    monkeypatch.setattr(near, "new_folder", folder)
    monkeypatch.setattr(near, "written", written)
    # Nodes of one text branch, and those of the last depth are clusters.
    p = ChosenPaths(small=1, depth=1, tile_docs=tile_docs, tile_shingles=tile_shingles)
    given = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(given, p=p).collect()}
    assert got == components_by_force(rows)
    blocks = [f for f in Path(kept[0]).iterdir() if f.name.startswith("c")]
    held = [pa.ipc.open_stream(f.read_bytes()).read_all().num_rows for f in blocks]
    assert len(blocks) > 10 and sum(held) <= written_rows["full-sets"]


@pytest.mark.parametrize("words", [40, 20_000])
def test_intersections_by_pairs_and_by_matrices(words):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, words, rng.integers(0, 60)).astype(np.uint64)) for _ in range(90)]

    def block(own):
        n = np.array([len(s) for s in own])
        return near._Block(np.arange(len(own)), n, np.repeat(np.arange(len(own)), n), np.concatenate(own))

    want = [[len(np.intersect1d(x, y)) for y in sets[40:]] for x in sets[:40]]
    assert near._in_common(block(sets[:40]), block(sets[40:])).tolist() == want


def test_shuffles_go_with_the_table_they_were_for(spark):
    before = spark.conf.get(storage.SHUFFLES_GO)
    storage.written(spark.range(10).repartition(3), "some")
    assert spark.conf.get(storage.SHUFFLES_GO) == before
