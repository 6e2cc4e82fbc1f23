"""Near-duplicate vectors by cosine: tiles of 8-bit products with rigorous error
bounds, full precision only for pairs that may reach the threshold."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .components import connected_components
from .storage import written

BLOCK = "dim int, block int, ids binary, copies binary, vectors binary"


@dataclass(frozen=True)
class Tiles:
    """vectors: of one side of a tile; rows: of a tile that are worked at once."""

    vectors: int = 4096
    rows: int = 1024


@dataclass
class Quantised:
    """Unit vectors as whole multiples of a step of their own. For each vector,
    error is at least the length of what was rounded off and length at least
    that of what is left."""

    steps: np.ndarray
    scale: np.ndarray
    error: np.ndarray
    length: np.ndarray


def quantise(vectors: np.ndarray) -> Quantised:
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    steps = np.rint(unit / scale[:, None]).astype(np.int8)
    kept = steps * scale[:, None]
    slack = 1e-12  # above the rounding of these sums themselves
    return Quantised(
        steps,
        scale,
        np.linalg.norm(unit - kept, axis=1) + slack,
        np.linalg.norm(kept, axis=1) + slack,
    )


def possible_pairs(a: Quantised, b: Quantised, threshold: float) -> np.ndarray:
    """Flags of pairs whose cosine may reach the threshold.

    x = x' + e and y = y' + f give x.y <= x'.y' + |x'||f| + |e||y'| + |e||f|.
    Products of the steps are whole numbers that single precision holds exactly
    (up to 1040 dimensions, beyond which double precision is used).
    """
    kind = np.float32 if a.steps.shape[1] <= 1040 else np.float64
    product = a.steps.astype(kind) @ b.steps.astype(kind).T
    product *= b.scale.astype(kind)
    # The bound of each pair, from the errors and lengths of its own two vectors.
    product += np.stack([a.length / a.scale, a.error / a.scale], 1).astype(kind) @ np.stack([b.error, b.length + b.error]).astype(kind)
    most = a.length * b.error.max() + a.error * (b.length + b.error).max()
    # Less what single precision may round off the terms, each at most this large.
    least = (threshold - 1e-6 * (abs(threshold) + 2 * most)) / a.scale - 1e-6
    return product >= least.astype(kind)[:, None]


def unpacked(vectors: bytes, kind: str, dim: int) -> np.ndarray:
    """Packed vectors in double precision. Those that were given in it are divided
    by a power of two, which rounds nothing, so that no square overflows."""
    x = np.frombuffer(vectors, kind).reshape(-1, dim).astype(np.float64)
    if kind == "<f8":
        x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])
    return x


def cosines(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    out = np.empty(len(i))
    for k in range(0, len(i), 1 << 16):
        s = slice(k, k + (1 << 16))
        out[s] = np.einsum("nd,nd->n", x[i[s]], y[j[s]]) / (nx[i[s]] * ny[j[s]])
    return out


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable node of each of n nodes, over the links a to b."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


def _link_tile(threshold: float, tiles: Tiles, kind: str):
    """Links between two blocks, or within one: for each vector how many it has,
    and enough of them to connect what they connect."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a_ids, b_ids = (np.frombuffer(r[f"{s}_ids"], np.int64) for s in "ab")
                a_n, b_n = (np.frombuffer(r[f"{s}_copies"], np.int64) for s in "ab")
                x, y = (unpacked(r[f"{s}_vectors"], kind, r["dim"]) for s in "ab")
                own, other = quantise(x), quantise(y)
                same = r["a_block"] == r["b_block"]
                links_b = np.zeros(len(b_ids), np.int64)
                for k in range(0, len(a_ids), tiles.rows):
                    s = slice(k, k + tiles.rows)
                    part = Quantised(own.steps[s], own.scale[s], own.error[s], own.length[s])
                    i, j = np.nonzero(possible_pairs(part, other, threshold))
                    i += k
                    if same:
                        i, j = i[i < j], j[i < j]
                    linked = cosines(x, y, i, j) >= threshold
                    i, j = i[linked], j[linked]
                    if not len(i):
                        continue
                    links_a = np.bincount(i, b_n[j], len(a_ids)).astype(np.int64)
                    links_b += np.bincount(j, a_n[i], len(b_ids)).astype(np.int64)
                    has = np.flatnonzero(links_a)
                    yield _batch(schema, a_ids[has], a_ids[has], links_a[has])
                    # Nodes of the one side first, those of the other after them.
                    ids = np.concatenate([a_ids, b_ids])
                    label = forest(len(ids), i, j + len(a_ids))
                    tied = np.flatnonzero(label != np.arange(len(ids)))
                    yield _batch(schema, ids[tied], ids[label[tied]], np.zeros(len(tied), np.int64))
                has = np.flatnonzero(links_b)
                if len(has):
                    yield _batch(schema, b_ids[has], b_ids[has], links_b[has])

    return rows


def _batch(schema: pa.Schema, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)


def link_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    tiles: Tiles = Tiles(),
) -> DataFrame:
    """Compare all vectors by cosine: vec_id, n_links (other vectors with cosine
    of at least the threshold), component_id (smallest vec_id reachable by
    links, itself included) and kept (whether that is itself).

    Null, empty and zero vectors and those with null or non-finite components
    link with nothing, and vectors link only with those of their dimension.
    Components in single precision are kept so, all other numbers are doubles.
    Equal vectors are compared once and counted as often as they occur. Rows of
    a null vec_id are answered (no links, component null, kept) but link with
    nothing; rows that repeat a vec_id count as vectors of their own.

    Vectors are packed in blocks; a tile is a pair of blocks, so that every pair
    meets in one tile, of a fixed size. A tile gives numbers of links and a
    spanning forest, never a list of pairs.
    """
    single = isinstance(vectors.schema[embedding].dataType.elementType, T.FloatType)
    kind = "<f4" if single else "<f8"
    v = F.col(embedding).cast("array<float>" if single else "array<double>")
    infinite = F.lit(float("inf"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    valid = F.coalesce(finite & F.exists(v, lambda x: x != 0) & F.col(vec_id).isNotNull(), F.lit(False))
    rows = vectors.select(F.col(vec_id).alias("id"), F.when(valid, v).alias("v"))
    classes = written(
        rows.where("v is not null").groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("copies")),
        "vectors",
    )
    counts = {r["dim"]: r["n"] for r in classes.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()}
    # One row per dimension that occurs.
    shapes = vectors.sparkSession.createDataFrame(
        [(d, ceil(n / tiles.vectors)) for d, n in counts.items()], "dim int, blocks int"
    )

    def pack(group: pa.Table) -> pa.Table:
        flat = group["v"].combine_chunks().flatten().to_numpy().astype(kind)
        return pa.table(
            {
                "dim": pa.array([group["dim"][0].as_py()], pa.int32()),
                "block": pa.array([group["block"][0].as_py()], pa.int32()),
                "ids": [group["rep"].to_numpy().tobytes()],
                "copies": [group["copies"].to_numpy().tobytes()],
                "vectors": [flat.tobytes()],
            }
        )

    blocks = written(
        classes.withColumn("dim", F.size("v"))
        .join(F.broadcast(shapes), "dim")
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .select("dim", "block", "rep", "copies", "v")
        .groupBy("dim", "block")
        .applyInArrow(pack, BLOCK),
        "blocks",
    )
    names = ["block", "ids", "copies", "vectors"]
    ones = blocks.join(F.broadcast(shapes), "dim").select(
        "dim", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("b_block"), *[F.col(c).alias(f"a_{c}") for c in names]
    )
    others = blocks.select("dim", *[F.col(c).alias(f"b_{c}") for c in names])
    n_tiles = sum(k * (k + 1) // 2 for k in (ceil(n / tiles.vectors) for n in counts.values()))
    met = ones.join(others.hint("shuffle_hash"), ["dim", "b_block"]).repartition(max(1, n_tiles))
    links = written(met.mapInArrow(_link_tile(threshold, tiles, kind), "a long, b long, n long"), "links")
    numbers = links.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    roots = connected_components(links.where("a != b"), "a", "b")
    answer = (
        classes.join(numbers, "rep", "left")
        .join(roots.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "v",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    return rows.join(answer, "v", "left").select(
        F.col("id").alias(vec_id),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"),
    )
