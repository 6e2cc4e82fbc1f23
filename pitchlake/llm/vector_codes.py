"""Compress vectors to codes by Lloyd's method on whole numbers: dual-tree
assignment between a tree over vector parts and a tree over codebook entries."""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .storage import new_folder, publish_file, read_range, written


@dataclass(frozen=True)
class Codes:
    """scale: components become floor(scale * x). parts: a vector is cut into.
    entries: of each part's codebook. rounds: of assignment and replacement.
    block_rows: vectors whose trees a task holds at once. leaf: parts in a leaf
    of their tree. broadcast_labels: most sums by label that are sent to all
    tasks. label_salt: tasks that share a label beyond that."""

    scale: int = 4096
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    block_rows: int = 4096
    leaf: int = 16
    broadcast_labels: int = 1 << 20
    label_salt: int = 32


# ---- trees -------------------------------------------------------------------


@dataclass
class Tree:
    """A balanced tree over points, level by level. Points are in tree order;
    node k of level l holds the points bounds[l][k] to bounds[l][k + 1], its
    children are the nodes 2k and 2k + 1 of the next level. low and high are the
    corners of a node's box, total the sum of its points."""

    order: np.ndarray
    points: np.ndarray
    bounds: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]
    total: list[np.ndarray]

    @classmethod
    def build(cls, points: np.ndarray, leaf: int) -> Tree:
        """Nodes are halved at the median of their widest side until each holds
        leaf points at most. Needs one point at least. Only with leaf = 1 there
        are empty nodes, beside nodes of one point."""
        n = len(points)
        order, bounds = np.arange(n), np.array([0, n])
        levels = [bounds]
        while np.diff(bounds).max() > leaf:
            now = points[order]
            starts = np.minimum(bounds[:-1], n - 1)
            wide = np.maximum.reduceat(now, starts) - np.minimum.reduceat(now, starts)
            node = np.repeat(np.arange(len(starts)), np.diff(bounds))
            side = now[np.arange(n), wide.argmax(1)[node]]
            order = order[np.lexsort((side, node))]
            bounds = np.sort(np.concatenate([bounds, (bounds[:-1] + bounds[1:] + 1) // 2]))
            levels.append(bounds)
        tree = cls(order, points[order], levels, [], [], [])
        for bounds in levels:
            starts = np.minimum(bounds[:-1], n - 1)
            tree.low.append(np.minimum.reduceat(tree.points, starts))
            tree.high.append(np.maximum.reduceat(tree.points, starts))
            tree.total.append(np.add.reduceat(tree.points, starts))
        return tree


def _gaps(low_a, high_a, low_b, high_b) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance between points of two boxes."""
    apart = np.maximum(0, np.maximum(low_b - high_a, low_a - high_b))
    across = np.maximum(high_b - low_a, high_a - low_b)
    return (apart * apart).sum(1), (across * across).sum(1)


@dataclass
class Assigned:
    """entry of each point, in the tree's order; count and sum of the points of
    each entry; how many points went by whole nodes."""

    entry: np.ndarray
    count: np.ndarray
    total: np.ndarray
    whole: int


def assign(tree: Tree, book: np.ndarray) -> Assigned:
    """Nearest entry of every point, ties to the lower index.

    Pairs of a node of points and a node of entries are held level by level. An
    entry node goes when its least distance is beyond the largest distance of
    another entry node to all points of the node; ties stay. A node with one
    entry left takes its cached sum to it; leaves with more entries compare all
    their points in whole numbers. All bounds are whole numbers too.
    """
    entries = Tree.build(book, 1)
    k, deepest, lowest = len(book), len(entries.bounds) - 1, len(tree.bounds) - 1
    entry = np.empty(len(tree.points), np.int64)
    count, total, whole = np.zeros(k, np.int64), np.zeros((k, book.shape[1]), np.int64), 0

    def pruned(level: int, deep: int, node: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = _gaps(tree.low[level][node], tree.high[level][node], entries.low[deep][of], entries.high[deep][of])
        best = np.full(len(tree.low[level]), np.iinfo(np.int64).max)
        np.minimum.at(best, node, high)
        stay = low <= best[node]
        return node[stay], of[stay]

    node, of, deep = np.zeros(1, np.int64), np.zeros(1, np.int64), 0
    for level in range(lowest + 1):
        node, of = pruned(level, deep, node, of)
        # One level of the entries is opened for each level of the points, at
        # the lowest one all that are left.
        for _ in range(deepest - deep if level == lowest else min(1, deepest - deep)):
            deep += 1
            node, of = np.repeat(node, 2), (2 * of[:, None] + np.arange(2)).ravel()
            full = entries.bounds[deep][of] < entries.bounds[deep][of + 1]
            node, of = pruned(level, deep, node[full], of[full])
        first = entries.bounds[deep][of]
        sure = (np.bincount(node, minlength=len(tree.low[level]))[node] == 1) & (entries.bounds[deep][of + 1] - first == 1)
        done, e = node[sure], entries.order[first[sure]]
        at, pair = _ranges(tree.bounds[level][done], tree.bounds[level][done + 1])
        entry[at] = e[pair]
        np.add.at(count, e, np.diff(tree.bounds[level])[done])
        np.add.at(total, e, tree.total[level][done])
        whole += len(at)
        node, of = node[~sure], of[~sure]
        if level < lowest:
            node, of = (2 * node[:, None] + np.arange(2)).ravel(), np.repeat(of, 2)
    at, pair = _ranges(tree.bounds[-1][node], tree.bounds[-1][node + 1])
    e = entries.order[entries.bounds[deep][of]][pair]
    gap = tree.points[at] - book[e]
    best = np.lexsort((e, (gap * gap).sum(1), at))
    first = best[np.flatnonzero(np.diff(at[best], prepend=-1))]
    entry[at[first]] = e[first]
    np.add.at(count, e[first], 1)
    np.add.at(total, e[first], tree.points[at[first]])
    return Assigned(entry, count, total, whole)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of some ranges, and the number of each place's range."""
    n = ends - starts
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + starts[of], of


# ---- blocks of vectors -------------------------------------------------------


def component_limit(dimensions: int) -> int:
    """Largest whole component: squared distances of whole vectors fit 63 bits."""
    return 1 << floor((60 - log2(max(1, dimensions))) / 2)


def whole_components(vectors: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    limit = float(component_limit(dimensions))
    return np.clip(np.floor(flat * scale), -limit, limit).astype(np.int64).reshape(-1, dimensions)


def _save(trees: list[Tree]) -> bytes:
    out, arrays = io.BytesIO(), {}
    for j, t in enumerate(trees):
        arrays |= {f"{j}.order": t.order.astype(np.int32), f"{j}.points": t.points.astype(np.int32)}
        for name, kind in (("bounds", np.int32), ("low", np.int32), ("high", np.int32), ("total", np.int64)):
            arrays |= {f"{j}.{name}.{i}": x.astype(kind) for i, x in enumerate(getattr(t, name))}
    np.savez(out, **arrays)
    return out.getvalue()


def _load(raw: bytes, parts: int) -> list[Tree]:
    held = np.load(io.BytesIO(raw), allow_pickle=False)

    def number(name: str) -> np.ndarray:
        return held[name].astype(np.int64)

    def levels(j: int, name: str) -> list[np.ndarray]:
        return [number(f"{j}.{name}.{i}") for i in range(sum(k.startswith(f"{j}.{name}.") for k in held.files))]

    return [
        Tree(number(f"{j}.order"), number(f"{j}.points"), *[levels(j, n) for n in ("bounds", "low", "high", "total")])
        for j in range(parts)
    ]


def _pack(folder: str, dimensions: int, p: Codes):
    """Write the trees and ids of each block as files; emit the files' names. A
    task that runs again writes files of other names, and those that were
    emitted before are read by nobody."""
    width = dimensions // p.parts

    def block(rows: pa.Table) -> pa.RecordBatch:
        name = uuid.uuid4().hex
        whole = whole_components(rows["vector"].combine_chunks(), dimensions, p.scale)
        trees = [Tree.build(np.ascontiguousarray(whole[:, j * width : (j + 1) * width]), p.leaf) for j in range(p.parts)]
        publish_file(folder, f"{name}.trees", [_save(trees)])
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, rows.select(["vec_id", "label"]).schema) as out:
            out.write_table(rows.select(["vec_id", "label"]))
        publish_file(folder, f"{name}.rows", [sink.getvalue()])
        return pa.record_batch([pa.array([name]), pa.array([len(rows)], pa.int64())], names=["block", "n"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            while held.num_rows >= p.block_rows:
                yield block(held[: p.block_rows])
                held = held[p.block_rows :]
        if held is not None and held.num_rows:
            yield block(held)

    return pack


def _spread(blocks: DataFrame) -> DataFrame:
    """One block name per row, dealt evenly; a task holds one block at a time."""
    n = blocks.count()
    return blocks.select("block").repartition(max(1, min(n, 4 * blocks.sparkSession.sparkContext.defaultParallelism)))


def _round(blocks: DataFrame, folder: str, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: each entry is the floored mean of its parts."""
    shape = "part int, entry int, n long, total array<long>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        totals = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for j, tree in enumerate(_load(read_range(folder, f"{name}.trees"), len(books))):
                    found = assign(tree, books[j])
                    counts[j] += found.count
                    totals[j] += found.total
        rows = [(j, e, counts[j][e], totals[j][e].tolist()) for j in range(len(books)) for e in np.flatnonzero(counts[j])]
        if rows:
            yield pa.RecordBatch.from_pylist(
                [{"part": j, "entry": int(e), "n": int(n), "total": t} for j, e, n, t in rows],
                schema=pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))]),
            )

    sums = blocks.mapInArrow(work, shape).select("part", "entry", "n", F.posexplode("total").alias("at", "x"))
    # As many rows as the codebooks have numbers, whatever the number of vectors.
    found = sums.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
    after = [b.copy() for b in books]
    for r in found:
        after[r["part"]][r["entry"], r["at"]] = r["x"] // r["n"]  # rounds down
    return after


def _coded(blocks: DataFrame, folder: str, books: list[np.ndarray], ids: str, labels: str) -> DataFrame:
    """Code and error of every vector: vec_id, label, code, error."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = pa.ipc.open_stream(read_range(folder, f"{name}.rows")).read_all()
                entry, error = np.zeros((len(rows), len(books)), np.uint8), np.zeros(len(rows), np.int64)
                for j, tree in enumerate(_load(read_range(folder, f"{name}.trees"), len(books))):
                    found = assign(tree, books[j])
                    gap = tree.points - books[j][found.entry]
                    entry[tree.order, j] = found.entry
                    error[tree.order] += (gap * gap).sum(1)
                codes = entry.tobytes().hex()
                wide = 2 * len(books)
                code = pa.array([codes[i : i + wide] for i in range(0, len(codes), wide)], pa.string())
                out = rows.append_column("code", code).append_column("error", pa.array(error))
                yield from out.combine_chunks().to_batches()

    return blocks.mapInArrow(work, f"vec_id {ids}, label {labels}, code string, error long")


def codebooks_text(books: list[np.ndarray]) -> str:
    return ",".join(str(x) for b in books for x in b.ravel().tolist())


# ---- the operator ------------------------------------------------------------


@dataclass(frozen=True)
class VectorCodes:
    """books: a codebook (entries x width, whole numbers) for each part. rows:
    vec_id, label, code and error of each vector."""

    books: list[np.ndarray]
    rows: DataFrame


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Vectors that are not null or empty and hold finite numbers only."""
    v = F.col(f"`{vector}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.where(v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(False)))


def learn_codes(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", p: Codes = Codes()
) -> VectorCodes:
    """Codebooks of all vectors, and every vector's code under them.

    Vectors that are null, empty or hold null or non-finite components are left
    out. All must have the length of the one of smallest id, which p.parts must
    divide; others are left out too, and there are no codes where it does not
    divide. Whole components beyond component_limit() count as that limit. The
    first codebooks are the parts of the p.entries smallest ids; null ids come
    last, equal ids in order of their vectors. Fewer vectors give fewer
    entries, none give no codebooks and no rows. p.entries is 256 at most.

    Each task builds the trees of its blocks once and writes them to the shared
    folder; every round reads them there, and only counts and sums of entries
    are shuffled.
    """
    if not 0 < p.entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    spark = vectors.sparkSession
    plain = usable(vectors, vector).select(
        F.col(f"`{vec_id}`").alias("vec_id"),
        (F.col(f"`{label}`") if label in vectors.columns else F.lit(None).cast("int")).alias("label"),
        F.col(f"`{vector}`").alias("vector"),
    )
    ids, labels = (plain.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    shape = f"vec_id {ids}, label {labels}, code string, error long"
    smallest = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    lead = plain.orderBy(*smallest).select(F.size("vector")).first()
    if lead is None or lead[0] % p.parts:
        return VectorCodes([], spark.createDataFrame([], shape))
    dimensions, width = lead[0], lead[0] // p.parts
    plain = plain.where(F.size("vector") == dimensions)
    seeds = plain.orderBy(*smallest).limit(p.entries).select("vector").collect()
    whole = whole_components(pa.array([r[0] for r in seeds], pa.list_(pa.float64())), dimensions, p.scale)
    books = [np.ascontiguousarray(whole[:, j * width : (j + 1) * width]) for j in range(p.parts)]
    folder = new_folder(spark, "vector-blocks")
    blocks = _spread(written(plain.mapInArrow(_pack(folder, dimensions, p), "block string, n long"), "vector-lists"))
    for _ in range(p.rounds):
        books = _round(blocks, folder, books)
    return VectorCodes(books, written(_coded(blocks, folder, books, ids, labels), "vector-codes"))


def with_label_error(rows: DataFrame, p: Codes = Codes()) -> DataFrame:
    """Adds label_error: the errors of all rows of the same label, nulls together
    (null where the sum leaves 64 bits). One row per label is sent to all tasks;
    beyond p.broadcast_labels, rows of a label are dealt over p.label_salt tasks."""
    sums = written(rows.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    same = F.col("label").eqNullSafe(F.col("_label"))
    if sums.count() <= p.broadcast_labels:
        return rows.join(F.broadcast(sums), same).drop("_label")
    salted = sums.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(p.label_salt - 1))))
    spread = rows.withColumn("_r", F.pmod(F.xxhash64("vec_id", "code"), F.lit(p.label_salt)).cast("int"))
    return spread.join(salted, same & (F.col("_r") == F.col("_s"))).drop("_label", "_s", "_r")


def coded_rows(spark: SparkSession, codes: VectorCodes, p: Codes = Codes()) -> DataFrame:
    """vec_id, code, error, label_error and the digest of all codebooks."""
    digest = hashlib.sha256(codebooks_text(codes.books).encode()).hexdigest()
    return with_label_error(codes.rows, p).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
