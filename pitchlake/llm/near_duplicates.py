"""Near-duplicate documents by word shingles: chosen-path trees bring similar sets
together, exact comparison of full sets decides."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .components import connected_components
from .embedding_pairs import forest
from .storage import new_folder, publish_file, read_range, written
from .words import LOWER, Words, combine, mix, slices, words_of


@dataclass(frozen=True)
class ChosenPaths:
    """shingle: words of one. percent: least resemblance of a link. trees: that
    are grown independently. depth: of a tree. small: documents of a node that
    are compared as they are; larger nodes branch again. hashes, agree: length
    of the signature that sorts out pairs before the exact comparison, and how
    many of it must agree. tile_docs, tile_shingles: of one side of a tile of
    the exact comparison, about. broadcast_bytes: largest list of ids that is
    sent to all tasks.

    At a resemblance of just 0.8 a pair stays together in a tree with a chance
    of 0.8 and more at depth 1 and about 0.55 at depth 3, so that ten trees miss
    it with a chance of 1e-7 to 3e-4; the signature misses it with 3e-6 (36 of 64
    at a mean of 51).
    """

    shingle: int = 2
    percent: int = 80
    trees: int = 10
    depth: int = 3
    small: int = 64
    hashes: int = 64
    agree: int = 36
    tile_docs: int = 500
    tile_shingles: int = 1 << 19
    broadcast_bytes: int = 64 << 20


_rng = np.random.default_rng(7)
_LAST = np.uint64(2**64 - 1)
_ODD = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document, ascending, as hashes; and offsets.
    A document of fewer words than a shingle has its whole sequence as one."""
    h = words.hashes(LOWER)
    n_words = np.diff(words.first)
    n = len(h)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    short = (n_words > 0) & (n_words < size)
    joined, whole = h, np.ones(n, bool)
    for k in range(1, size):
        after = np.zeros(n, np.uint64)
        after[: n - k] = h[k:]
        here = np.arange(n) + k < words.first[1:][doc]
        # Shorter sequences keep their shorter name; only first places count then.
        joined = np.where(here, combine(joined, after, k), joined)
        whole = whole & here
    firsts = words.first[:-1][short]
    whole[firsts] = True
    value = joined[whole]
    bounds = np.concatenate([[0], np.cumsum(whole)])[words.first]
    sets = [np.unique(value[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)])
    return (np.concatenate(sets) if sets else value), offsets


def _child(keys: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Node that a node's token leads to; both are hashes already."""
    x = (keys * np.uint64(0x9FB21C651E98DF25) + tokens) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def paths(tokens: np.ndarray, p: ChosenPaths) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Nodes of a set at every depth, and each one's place among those above.

    A node hashes all tokens by its own function and goes on with the token of
    least hash. One node in four, by its name, takes the next token too; that
    makes 1 / 0.8 branches on average, so many that a pair of that resemblance
    shares one on average. The choice depends on node and tokens alone.
    """
    forks = np.uint64((100 / p.percent - 1) * 2**32)
    keys = mix(np.arange(1, p.trees + 1, dtype=np.uint64), 900)
    nodes, parents = [], []
    for _ in range(p.depth):
        order = (tokens ^ keys[:, None]) * (keys | np.uint64(1))[:, None]
        first = order.argmin(axis=1)
        chosen = [_child(keys, tokens[first])]
        owner = [np.arange(len(keys))]
        if len(tokens) > 1:
            fork = np.flatnonzero((keys >> np.uint64(32)) < forks)
            rest = order[fork]
            rest[np.arange(len(fork)), first[fork]] = _LAST
            chosen.append(_child(keys[fork], tokens[rest.argmin(axis=1)]))
            owner.append(fork)
        keys = np.concatenate(chosen)
        nodes.append(keys)
        parents.append(np.concatenate(owner))
    return nodes, parents


def signature(tokens: np.ndarray, p: ChosenPaths) -> bytes:
    least = (tokens[None, :] * _ODD[: p.hashes, None]).argmin(axis=1)
    return (mix(tokens[least], 29) & np.uint64(0xFFFF)).astype("<u2").tobytes()


def _describe(p: ChosenPaths):
    levels = [f"k{d}" for d in range(p.depth)]
    schema = pa.schema(
        [("row", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("sig", pa.binary())]
        + [(k, pa.list_(pa.int64())) for k in levels]
        + [(f"p{d}", pa.list_(pa.int16())) for d in range(p.depth)]
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i, j in slices(batch.column("text")):
                value, first = shingle_sets(words_of(batch.column("text")[i:j]), p.shingle)
                n = np.diff(first)
                columns = [[] for _ in range(3 + 2 * p.depth)]
                f = np.zeros((2, j - i), np.uint64)
                for d in range(j - i):
                    tokens = value[first[d] : first[d + 1]]
                    if not len(tokens):
                        for c in columns:
                            c.append(None)
                        continue
                    f[0, d], f[1, d] = mix(tokens, 41).sum(), mix(tokens, 43).sum()
                    nodes, parents = paths(tokens, p)
                    held = [signature(tokens, p), *[k.view(np.int64) for k in nodes], *[q.astype(np.int16) for q in parents]]
                    for c, x in zip(columns, held):
                        c.append(x)
                arrays = [pa.array(np.arange(row, row + j - i)), batch.column("id")[i:j], pa.array(n), *[pa.array(x.view(np.int64)) for x in f]]
                arrays += [pa.array(c, t.type) for c, t in zip(columns, list(schema)[5:])]
                row += j - i
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return describe, schema


def _emit_sets(p: ChosenPaths):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text")):
                value, first = shingle_sets(words_of(batch.column("text")[i:j]), p.shingle)
                sets = [value[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[i:j], batch.column("cluster")[i:j], pa.array(np.diff(first)), pa.array(sets, pa.binary())],
                    names=["id", "cluster", "n", "tokens"],
                )

    return emit


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _spanning(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """Few enough of the links i to j to connect what they all connect."""
    label = forest(len(ids), i, j)
    tied = np.flatnonzero(label != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[tied]), pa.array(ids[label[tied]])], schema=EDGES)


def _compare_nodes(p: ChosenPaths):
    """Pairs within small nodes whose signatures and sizes allow a link. Rows come
    sorted by node; each stands beside the rows of its node."""

    def compare(node, ids, n, sig) -> pa.RecordBatch:
        starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        size = np.diff(np.append(starts, len(node)))
        found_i, found_j = [], []
        # Row r stands against row r + step, for as long as that is of its node.
        left = np.repeat(starts + size, size) - np.arange(len(node))
        for step in range(1, int(size.max())):
            i = np.flatnonzero(left > step)
            j = i + step
            low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            fits = 100 * low >= p.percent * high
            i, j = i[fits], j[fits]
            alike = (sig[i] == sig[j]).sum(axis=1) >= p.agree
            found_i.append(i[alike])
            found_j.append(j[alike])
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_i, found_j))
        unique, place = np.unique(ids, return_inverse=True)
        return _spanning(unique, place[i], place[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            node = held["node"].to_numpy()
            # The last node may go on in the next batch.
            cut = int(np.searchsorted(node, node[-1])) if len(node) else 0
            if cut:
                yield whole(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield whole(held)

    def whole(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), "<u2").reshape(-1, p.hashes)
        return compare(*[table[c].to_numpy() for c in ("node", "id", "n")], sig)

    return run


@dataclass
class _Block:
    """Some sets of a cluster: ids, sizes, and all tokens with their owners' places."""

    ids: np.ndarray
    n: np.ndarray
    owner: np.ndarray
    tokens: np.ndarray


def _block(table: pa.Table) -> _Block:
    n = table["n"].to_numpy()
    tokens = np.frombuffer(b"".join(table["tokens"].to_pylist()), np.uint64)
    return _Block(table["id"].to_numpy(), n, np.repeat(np.arange(len(n)), n), tokens)


def _in_common(a: _Block, b: _Block) -> np.ndarray:
    """Sizes of the intersections of the sets of two blocks: by products of
    matrices, or where that is less, by the pairs of sets that each token joins."""
    _, column = np.unique(np.concatenate([a.tokens, b.tokens]), return_inverse=True)
    columns = column[: len(a.tokens)], column[len(a.tokens) :]
    held = [np.bincount(c, minlength=len(column)) for c in columns]
    shared = (held[0] > 0) & (held[1] > 0)
    number = np.cumsum(shared) - 1
    sides = []
    for side, c in zip((a, b), columns):
        kept = shared[c]
        owner, c = side.owner[kept], number[c[kept]]
        order = np.argsort(c, kind="stable")
        sides.append((owner[order], c[order]))
    (owner_a, column_a), (owner_b, column_b) = sides
    count_b, n_columns = held[1][shared], int(shared.sum())
    common = np.zeros((len(a.ids), len(b.ids)), np.int32)
    pairs = count_b[column_a]
    if 8 * pairs.sum() <= common.size * n_columns // 16:
        first_b = np.cumsum(count_b) - count_b
        until = np.cumsum(pairs)
        at = 0
        while at < len(pairs):
            end = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + (1 << 21), "right")))
            times = pairs[at:end]
            place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            j = owner_b[np.repeat(first_b[column_a[at:end]], times) + place]
            np.add.at(common.reshape(-1), np.repeat(owner_a[at:end], times) * len(b.ids) + j, 1)
            at = end
        return common
    width = max(256, min(4096, (32 << 20) // (4 * (len(a.ids) + len(b.ids)))))
    for start in range(0, n_columns, width):
        parts = []
        for side, (owner, column) in zip((a, b), sides):
            s = slice(*np.searchsorted(column, [start, start + width]))
            part = np.zeros((len(side.ids), width), np.float32)
            part[owner[s], column[s] - start] = 1
            parts.append(part)
        common += (parts[0] @ parts[1].T).astype(np.int32)
    return common


def _set_links(a: _Block, b: _Block, p: ChosenPaths) -> pa.RecordBatch:
    """Links between two blocks, or within one that is given twice."""
    common = _in_common(a, b)
    i, j = np.nonzero(np.triu(common, 1) if a is b else common)
    both = common[i, j].astype(np.int64)
    linked = 100 * both >= p.percent * (a.n[i] + b.n[j] - both)
    i, j = i[linked], j[linked]
    return _spanning(a.ids, i, j) if a is b else _spanning(np.concatenate([a.ids, b.ids]), i, len(a.ids) + j)


def _compare_sets(p: ChosenPaths):
    """Links within a cluster of one block, by the sizes of the intersections of
    full sets."""

    def compare(group: pa.Table) -> pa.Table:
        block = _block(group)
        return pa.Table.from_batches([_set_links(block, block, p)])

    return compare


def _keep_block(folder: str):
    """Write a block of a large cluster as one file; returns what sizes it holds."""

    def keep(group: pa.Table) -> pa.Table:
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, group.schema) as stream:
            stream.write_table(group)
        publish_file(folder, _block_name(group["cluster"][0].as_py(), group["block"][0].as_py()), [out.getvalue()])
        sizes = pc.min_max(group["n"])
        return group.select(["cluster", "block"]).slice(0, 1).append_column("least", pa.array([sizes["min"].as_py()])).append_column(
            "most", pa.array([sizes["max"].as_py()])
        )

    return keep


def _block_name(cluster: int, block: int) -> str:
    return f"c{cluster}-{block}"


def _compare_blocks(p: ChosenPaths, folder: str):
    """Links between a block and some of those from it on, read from their files."""

    def opened(cluster: int, block: int) -> _Block:
        return _block(pa.ipc.open_stream(read_range(folder, _block_name(cluster, block))).read_all())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                low = opened(row["cluster"], row["low"])
                for high in row["highs"]:
                    yield _set_links(low, low if high == row["low"] else opened(row["cluster"], high), p)

    return compare


def _large_cluster_links(sets: DataFrame, shape: DataFrame, p: ChosenPaths) -> DataFrame:
    """Links within the clusters of more than one block. Sets are cut into blocks
    in order of their sizes and kept once, in files; a tile is two blocks whose
    sizes allow a link, and reads them. So what is stored grows with the sets and
    not with the tiles."""
    spark = sets.sparkSession
    folder = new_folder(spark, "set-blocks")
    large = shape.where("blocks > 1").select("cluster")
    of_large = sets.join(large, "cluster", "left_semi")
    # Blocks that the sets of a size fill, and those that smaller sets fill before.
    weight = F.greatest(F.count("*") / p.tile_docs, F.count("*") * F.col("n") / p.tile_shingles)
    sized = of_large.groupBy("cluster", "n").agg(weight.alias("fills"))
    filled = sized.select(
        "*", F.expr("sum(fills) over (partition by cluster order by n rows between unbounded preceding and current row)").alias("until")
    )
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.lit(1 << 20)
    cut = of_large.join(filled, ["cluster", "n"]).select(
        "cluster", F.floor(F.col("until") - F.col("fills") * share).alias("block"), "id", "n", "tokens"
    )
    blocks = written(
        cut.groupBy("cluster", "block").applyInArrow(_keep_block(folder), "cluster long, block long, least long, most long"), "blocks"
    )
    low = blocks.select("cluster", F.col("block").alias("low"), "most")
    high = blocks.select("cluster", F.col("block").alias("high"), "least")
    fits = (F.col("low") <= F.col("high")) & (F.col("most") * 100 >= F.col("least") * p.percent)
    tiles = low.join(high, "cluster").where(fits).select("cluster", "low", "high", F.floor(F.col("high") / 16).alias("part"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = tiles.repartition(tasks, "cluster", "low", "part").groupBy("cluster", "low", "part").agg(F.collect_list("high").alias("highs"))
    return rows.mapInArrow(_compare_blocks(p, folder), "a long, b long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", p: ChosenPaths = ChosenPaths()
) -> DataFrame:
    """Link documents whose sets of shingles have a resemblance of at least
    p.percent: doc_id, n_shingles, component_id (smallest doc_id reachable by
    links, itself included) and kept (whether that is itself).

    Words are lower-cased (A-Z) and divided by space and control characters 9 to
    13. Documents without words, null texts too, have no shingles and link with
    nothing. Rows of a null id link with nothing, have no component and are
    kept. Rows that repeat an id are parts of one group by that alone.

    Documents of equal sets are one class and go through the trees once. Nodes
    of at most p.small documents are compared by signature, larger ones branch;
    those still large at the last depth hold documents that agree in p.depth
    chosen shingles and are joined without a look. What is joined so is a
    cluster, a superset of a component; its full sets are compared with one
    another in tiles of bounded size, so that no pair of a cluster is left out
    but those whose sizes rule out a link.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    describe, schema = _describe(p)
    names = {pa.int64(): "long", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>", pa.list_(pa.int16()): "array<short>"}
    described = written(
        rows.mapInArrow(describe, ", ".join(f"{f.name} {names[f.type]}" for f in schema)), "sets"
    )
    usable = described.where("n > 0 and id is not null")
    key = ["f1", "f2", "n"]
    classes = written(
        usable.groupBy(*key).agg(F.min(F.struct("id", "row")).alias("r")).select(*key, F.col("r.id").alias("rep"), "r.row"),
        "classes",
    )
    reps = written(usable.drop("f1", "f2").join(classes.select("row"), "row", "left_semi"), "representatives")

    members, stars, above = [], [], None
    for d in range(p.depth):
        up = F.col(f"k{d - 1}")[F.col("x.p")] if d else F.lit(None).cast("long")
        nodes = (
            reps.select("id", *([f"k{d - 1}"] if d else []), F.explode(F.arrays_zip(F.col(f"k{d}").alias("k"), F.col(f"p{d}").alias("p"))).alias("x"))
            .select("id", F.col("x.k").alias("node"), up.alias("parent"))
        )
        if above is not None:  # read up to three times, so the look-up of the parents is made once
            of_large = nodes.join(above.select(F.col("node").alias("parent")), "parent", "left_semi")
            nodes = written(of_large.select("id", "node"), "branches")
        nodes = nodes.select("id", "node")
        sizes = written(nodes.groupBy("node").agg(F.count("*").alias("size"), F.min("id").alias("first")).where("size > 1"), "nodes")
        members.append(nodes.join(sizes.where(F.col("size") <= p.small).select("node"), "node", "left_semi"))
        above = sizes.where(F.col("size") > p.small)
        if d == p.depth - 1:
            stars.append(nodes.join(above, "node").select(F.col("id").alias("a"), F.col("first").alias("b")))
    together = members[0]
    for more in members[1:]:
        together = together.unionByName(more)
    alike = (
        together.join(reps.select("id", "n", "sig"), "id")
        .repartition("node")
        .sortWithinPartitions("node")
        .mapInArrow(_compare_nodes(p), "a long, b long")
    )
    candidates = alike
    for star in stars:
        candidates = candidates.unionAll(star.where("a != b"))
    clusters = written(connected_components(candidates, "a", "b").withColumnRenamed("component", "cluster"), "clusters")

    small = clusters.count() * 64 <= p.broadcast_bytes
    wanted = rows.join(F.broadcast(clusters) if small else clusters, "id")
    sets = written(wanted.mapInArrow(_emit_sets(p), "id long, cluster long, n long, tokens binary"), "full-sets")
    shape = sets.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / p.tile_docs), F.ceil(F.sum("n") / p.tile_shingles)).alias("blocks")
    )
    shape = written(shape, "shape")
    whole = sets.join(shape.where("blocks <= 1").select("cluster"), "cluster", "left_semi")
    links = whole.groupBy("cluster").applyInArrow(_compare_sets(p), "a long, b long")
    if not shape.where("blocks > 1").isEmpty():
        links = links.unionAll(_large_cluster_links(sets, shape, p))
    links = written(links, "set-links")
    roots = connected_components(links, "a", "b").withColumnRenamed("id", "rep")
    answer = (
        classes.drop("row").join(roots, "rep", "left")
        .select(*key, F.coalesce("component", "rep").alias("component"))
    )
    flat = described.select("id", *key)
    joined = flat.join(answer, key, "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")))
    return joined.select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
