"""Remove repeated passages: recompression names runs and pairs of words the same
way everywhere, repeated names show where to look, windows decide.

A round first names maximal runs of equal symbols by the symbol and their number,
then deals symbols to two classes by their name and names every pair of a left
symbol followed by a right one. A name is a hash of what it stands for: it is
the same in every task without any exchange. Each symbol carries the stretch of
words that its name depends on; in equal windows, symbols whose stretch lies
within the window are equal. So a window that holds a name which occurs only
once in the corpus occurs only once itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .storage import new_folder, publish_file, read_range
from .words import Words, combine, find_words, mix, slices, text_bytes, words_of

_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


@dataclass(frozen=True)
class Passages:
    """window: words of a passage that must repeat. rounds: of recompression.
    block_bytes: text that is worked at once, one longer text aside.
    bucket_words: words of the corpus for each bucket of names or windows."""

    window: int = 20
    rounds: int = 2
    block_bytes: int = 4 << 20
    bucket_words: int = 2 << 20


# ---- recompression of one block ---------------------------------------------


@dataclass
class Symbols:
    """Symbols of a level: name, first word and end, and the stretch of words
    [low, high) that the name depends on. A stretch that reaches over the edge
    of its document lies in no window."""

    name: np.ndarray
    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    doc: np.ndarray


def _neighbours(s: Symbols) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether the next symbol is of the same document, and the stretch bounds
    that the symbols before and after have; beyond an edge, outside."""
    n = len(s.name)
    joined = np.zeros(n, bool)
    joined[:-1] = s.doc[1:] == s.doc[:-1]
    before = s.low - 1
    before[1:] = np.where(joined[:-1], s.low[:-1], before[1:])
    after = s.high + 1
    after[:-1] = np.where(joined[:-1], s.high[1:], after[:-1])
    # Beyond an edge of the document no window can reach.
    first = np.ones(n, bool)
    first[1:] = ~joined[:-1]
    before[first] = -(1 << 40)
    after[~joined] = 1 << 40
    return joined, before, after


def name_runs(s: Symbols) -> Symbols:
    joined, before, after = _neighbours(s)
    n = len(s.name)
    starts = np.ones(n, bool)
    starts[1:] = ~(joined[:-1] & (s.name[1:] == s.name[:-1]))
    at = np.flatnonzero(starts)
    last = np.append(at[1:], n) - 1
    count = last - at + 1
    name = np.where(count > 1, combine(s.name[at], count.astype(np.uint64), 11), s.name[at])
    return Symbols(name, s.start[at], s.end[last], before[at], after[last], s.doc[at])


def name_pairs(s: Symbols, seed: int) -> Symbols:
    joined, before, after = _neighbours(s)
    right = (mix(s.name, seed) & np.uint64(1)).astype(bool)
    pair = np.zeros(len(s.name), bool)
    pair[:-1] = ~right[:-1] & right[1:] & joined[:-1]
    taken = np.zeros(len(s.name), bool)
    taken[1:] = pair[:-1]
    at = np.flatnonzero(~taken)
    is_pair = pair[at]
    other = np.where(is_pair, at + 1, at)
    name = np.where(is_pair, combine(s.name[at], s.name[other], seed), s.name[at])
    # A single left symbol stayed so for what follows it, a right one for what precedes it.
    low = np.where(is_pair | ~right[at], s.low[at], before[at])
    high = np.where(is_pair, s.high[other], np.where(right[at], s.high[at], after[at]))
    return Symbols(name, s.start[at], s.end[other], low, high, s.doc[at])


def recompress(words: Words, hashes: np.ndarray, rounds: int) -> Symbols:
    place = np.arange(len(hashes))
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    s = Symbols(hashes, place, place + 1, place, place + 1, doc)
    if not len(hashes):
        return s
    for r in range(rounds):
        s = name_pairs(name_runs(s), 101 + r)
    return s


def telling(s: Symbols, window: int) -> np.ndarray:
    """Symbols of more than one word whose stretch fits in a window."""
    return np.flatnonzero((s.end - s.start > 1) & (s.high - s.low <= window))


def window_hashes(hashes: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes of the windows that start at the given words."""
    out = []
    for seed, base in enumerate(_BASES):
        n = len(hashes)
        powers = np.full(n + 1, base, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        inverse = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(hashes, 31 + seed) * powers[:n], out=sums[1:])
        out.append(mix((sums[at + window] - sums[at]) * inverse[at], 61 + seed))
    return out[0], out[1]


# ---- the stages -------------------------------------------------------------


def _blocks(doc_id: str, text: str, block_bytes: int):
    """Documents in blocks, each numbered by its task and place there."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i, j in slices(batch.column("text"), block_bytes):
                ids, texts = batch.column("doc_id")[i:j], batch.column("text")[i:j]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([(task << 40) + n], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), ids),
                        pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), texts),
                        pa.array([int(np.diff(words_of(texts).first).sum())], pa.int64()),
                    ],
                    names=["block", "ids", "texts", "words"],
                )
                n += 1

    return pack


def _parsed(row: dict, rounds: int | None):
    words = words_of(row["texts"].values)
    hashes = words.hashes()
    return words, hashes, None if rounds is None else recompress(words, hashes, rounds)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i] for name in batch.schema.names}


def _by_bucket(values: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of values by bucket and value, and where each bucket starts."""
    bucket = (values % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((values, bucket))
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _block_names(s: Symbols, window: int, buckets: int):
    """Distinct telling names of a block, by bucket: names, whether the block
    has each more than once, bucket bounds, and the symbols' places among them."""
    at = telling(s, window)
    names, inverse, count = np.unique(s.name[at], return_inverse=True, return_counts=True)
    order, bounds = _by_bucket(names, buckets)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return at, names[order], count[order] > 1, bounds, rank[inverse]


def _emit_names(p: Passages, buckets: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            _, _, s = _parsed(row, p.rounds)
            _, names, twice, bounds, _ = _block_names(s, p.window, buckets)
            # 32 bits beside the bucket: a chance equality costs work, not truth.
            short = (names >> np.uint64(32)).astype("<u4")
            yield from _bucket_rows(
                row["block"].as_py(), bounds, lambda a, b: {"names": short[a:b].tobytes(), "twice": np.packbits(twice[a:b]).tobytes()}
            )

    return emit


def _bucket_rows(block: int, bounds: np.ndarray, columns) -> Iterator[pa.RecordBatch]:
    rows = [
        {"block": block, "bucket": k, **columns(a, b)}
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))
        if b > a
    ]
    if rows:
        yield pa.RecordBatch.from_pylist(
            rows, schema=pa.schema([(c, pa.int64() if isinstance(v, int) else pa.binary()) for c, v in rows[0].items()])
        )


def _repeated_names(group: pa.Table) -> pa.Table:
    """For one bucket: which names of each block occur again anywhere."""
    parts = [np.frombuffer(x, "<u4") for x in group["names"].to_pylist()]
    sizes = [len(x) for x in parts]
    twice = np.concatenate(
        [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(group["twice"].to_pylist(), sizes)]
    ).astype(bool)
    _, inverse, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    again = twice | (count > 1)[inverse]
    cuts = np.split(again, np.cumsum(sizes)[:-1])
    return pa.table({"block": group["block"], "bucket": group["bucket"], "bits": [np.packbits(c).tobytes() for c in cuts]})


def _unpacked(flags: list[dict], bounds: np.ndarray) -> np.ndarray:
    """Flags of a block from its buckets' bits."""
    out = np.zeros(bounds[-1], bool)
    for f in flags:
        a, b = bounds[f["bucket"]], bounds[f["bucket"] + 1]
        out[a:b] = np.unpackbits(np.frombuffer(f["bits"], np.uint8), count=b - a)
    return out


def _candidates(words: Words, s: Symbols, p: Passages, buckets: int, flags) -> np.ndarray:
    """Starts of the windows in which no telling name stands alone."""
    n = len(words.start)
    at, _, _, bounds, place = _block_names(s, p.window, buckets)
    alone = at[~_unpacked(flags, bounds)[place]]
    hits = np.zeros(n + 2, np.int64)
    low = np.maximum(s.high[alone] - p.window, 0)
    np.add.at(hits, low, 1)
    np.add.at(hits, s.low[alone] + 1, -1)
    left = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(n)
    return np.flatnonzero((np.cumsum(hits[:n]) == 0) & (left >= p.window))


@dataclass
class _Windows:
    """Windows of a block that may repeat, by bucket and hash, in order of their
    documents' ids and places; first marks the earliest of equal ones."""

    start: np.ndarray
    doc: np.ndarray
    high: np.ndarray
    low: np.ndarray
    first: np.ndarray
    bounds: np.ndarray


def _windows(row: dict, names: _Answers, p: Passages, buckets: int) -> tuple[Words, _Windows | None]:
    words, hashes, s = _parsed(row, p.rounds)
    at = _candidates(words, s, p, buckets, names.of(row["block"].as_py()))
    if not len(at):
        return words, None
    h1, h2 = window_hashes(hashes, at, p.window)
    doc = _order_ids(row["ids"])[np.searchsorted(words.first, at, "right") - 1]
    bucket = (h1 % np.uint64(buckets)).astype(np.int64)
    # What travels tells windows apart, here as there.
    low = (h2 >> np.uint64(32)).astype("<u4")
    order = np.lexsort((at, doc, low, h1, bucket))
    h1, low, doc, at, bucket = (x[order] for x in (h1, low, doc, at, bucket))
    first = np.ones(len(at), bool)
    first[1:] = (h1[1:] != h1[:-1]) | (low[1:] != low[:-1])
    return words, _Windows(at, doc, h1, low, first, np.searchsorted(bucket, np.arange(buckets + 1)))


def _emit_windows(p: Passages, folder: str, buckets: int):
    """Windows that may repeat; of equal ones in a block the earliest goes on."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _Answers(folder, "names")
        for row in _rows(batches):
            _, w = _windows(row, names, p, buckets)
            if w is not None:
                yield from _bucket_rows(
                    row["block"].as_py(),
                    w.bounds,
                    lambda a, b: {
                        "high": w.high[a:b][w.first[a:b]].tobytes(),
                        "low": w.low[a:b][w.first[a:b]].tobytes(),
                        "docs": _packed(w.doc[a:b][w.first[a:b]]),
                    },
                )

    return emit


def _order_ids(ids) -> np.ndarray:
    return ids.values.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def _packed(values: np.ndarray) -> bytes:
    """Integers as their least and the distances from it, in 4 bytes if these do."""
    least = values.min()
    distance = (values - least).view(np.uint64)
    width = 4 if distance.max() < 1 << 32 else 8
    return int(least).to_bytes(8, "little", signed=True) + distance.astype(f"<u{width}").tobytes()


def _from_packed(raw: bytes, n: int) -> np.ndarray:
    least = int.from_bytes(raw[:8], "little", signed=True)
    width = (len(raw) - 8) // n
    return np.frombuffer(raw, f"<u{width}", n, 8).astype(np.int64) + least


def _joined(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """The values of a column of packed arrays behind one another."""
    parts = []
    for chunk in column.chunks:
        width = np.int64 if pa.types.is_large_binary(chunk.type) else np.int32
        offsets = np.frombuffer(chunk.buffers()[1], width)[chunk.offset : chunk.offset + len(chunk) + 1]
        if len(chunk):
            parts.append(np.frombuffer(memoryview(chunk.buffers()[2])[offsets[0] : offsets[-1]], kind))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _earlier_windows(group: pa.Table) -> pa.Table:
    """For one bucket: which windows of each block have an equal one earlier."""
    h, l = _joined(group["high"], "<u8"), _joined(group["low"], "<u4")
    sizes = pc.binary_length(group["low"]).to_numpy() // 4
    docs = np.concatenate([_from_packed(x, n) for x, n in zip(group["docs"].to_pylist(), sizes)])
    block = np.repeat(group["block"].to_numpy(), sizes)
    by = np.lexsort((block, docs, l, h))
    del block, docs
    first = np.ones(len(by), bool)
    for values in (h, l):
        first[1:] &= values[by[1:]] == values[by[:-1]]
    first[1:] = ~first[1:]
    earlier = np.empty(len(by), bool)
    earlier[by] = ~first
    cuts = np.split(earlier, np.cumsum(sizes)[:-1])
    return pa.table({"block": group["block"], "bucket": group["bucket"], "bits": [np.packbits(c).tobytes() for c in cuts]})


def removed_words(words: Words, starts: np.ndarray, window: int) -> np.ndarray:
    """Flags of the words that any of the windows covers."""
    n = len(words.start)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return np.cumsum(cover[:n]) > 0


def kept_texts(words: Words, removed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that stay, joined by one space within each document: bytes, offsets."""
    n_docs = len(words.first) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(words.first))
    keep = np.flatnonzero(~removed)
    follows = np.zeros(len(keep), bool)
    follows[:-1] = doc[keep][1:] == doc[keep][:-1]
    # The byte after a word that another one follows is white space.
    ends = words.end[keep] + follows
    edges = np.zeros(len(words.data) + 1, np.int64)
    np.add.at(edges, words.start[keep], 1)
    np.add.at(edges, ends, -1)
    mask = np.cumsum(edges[:-1]) > 0
    data = words.data.copy()
    data[words.end[keep][follows]] = 0x20
    offsets = np.concatenate([[0], np.cumsum(mask)])[words.offsets]
    return data[mask], offsets


def _emit_documents(p: Passages, folder: str, buckets: int, texts: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, earlier = _Answers(folder, "names"), _Answers(folder, "earlier")
        for row in _rows(batches):
            words, w = _windows(row, names, p, buckets)
            starts = np.zeros(0, np.int64)
            if w is not None:
                gone = ~w.first
                for f in earlier.of(row["block"].as_py()):
                    a, b = w.bounds[f["bucket"]], w.bounds[f["bucket"] + 1]
                    here = a + np.flatnonzero(w.first[a:b])
                    gone[here] = np.unpackbits(np.frombuffer(f["bits"], np.uint8), count=len(here))
                starts = w.start[gone]
            removed = removed_words(words, starts, p.window)
            data, offsets = kept_texts(words, removed)
            view = memoryview(data)
            totals = np.concatenate([[0], np.cumsum(removed)])[words.first]
            columns = [
                row["ids"].values,
                pa.array(np.diff(words.first)),
                pa.array(np.diff(totals)),
                pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]),
            ]
            fields = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if texts:
                columns.append(pa.array([bytes(view[a:b]).decode() for a, b in zip(offsets[:-1], offsets[1:])]))
                fields.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names=fields)

    return emit


def _published(answers: DataFrame, folder: str, name: str) -> None:
    """Write answers to blocks as one file for each task that packed blocks. A
    file holds what belongs to one partition of the input, so that blocks need
    neither be dealt anew nor answers be sent to all tasks."""

    def write(group: pa.Table) -> pa.Table:
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, group.schema) as stream:
            stream.write_table(group)
        publish_file(folder, f"{name}-{group['task'][0].as_py()}", [out.getvalue()])
        return group.slice(0, 1).select(["task"])

    tasks = answers.withColumn("task", F.shiftright("block", 40))
    tasks.groupBy("task").applyInArrow(write, "task long").write.format("noop").mode("overwrite").save()


class _Answers:
    """Answers to the blocks of one task after another, read from their files."""

    def __init__(self, folder: str, name: str) -> None:
        self.folder, self.name, self.task, self.held, self.places = folder, name, None, None, {}

    def of(self, block: int) -> list[dict]:
        if block >> 40 != self.task:
            self.task, self.held, self.places = block >> 40, None, {}
            try:
                raw = read_range(self.folder, f"{self.name}-{self.task}")
            except FileNotFoundError:  # none of this task's blocks got an answer
                return []
            # Rows stay packed: a task has one for each of its blocks and each bucket.
            self.held = pa.ipc.open_stream(raw).read_all()
            blocks = self.held["block"].to_numpy()
            order = np.argsort(blocks, kind="stable")
            cuts = np.flatnonzero(np.diff(blocks[order])) + 1
            self.places = {int(blocks[at[0]]): at for at in np.split(order, cuts) if len(at)}
        return self.held.take(self.places[block]).to_pylist() if block in self.places else []


def drop_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", texts: bool = True, p: Passages = Passages()
) -> DataFrame:
    """Remove every word that a repeated passage covers: doc_id, n_words,
    n_removed, kept_sha256 and, if wanted, kept (the words that stay, joined by
    one space).

    A passage is a window of p.window words of one document whose sequence also
    starts earlier: in a document of a smaller id, or in the same one before.
    Windows are judged on the whole input. Null and empty texts have no words;
    texts shorter than a window lose none. Rows of a null id come before all
    others; rows that repeat an id follow one another in the order in which the
    table is read. Windows are told apart by 96 bits of hash beside their bucket.

    Documents are packed into blocks, which stay where they are written. Names
    and windows travel as packed arrays, one for each block and bucket, and only
    once per block: however often a passage occurs, a bucket receives it at most
    once from every block. Answers come back by files, and the last pass finds a
    block's windows again rather than have them stored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    packed = rows.mapInArrow(_blocks("doc_id", "text", p.block_bytes), "block long, ids array<long>, texts array<string>, words long")
    folder = new_folder(docs.sparkSession, "passages")
    # Readers open a row group as a whole, so each block is one.
    packed.write.option("compression", "zstd").option("parquet.block.row.count.limit", "1").parquet(f"{folder}/blocks")
    blocks = docs.sparkSession.read.schema(packed.schema).parquet(f"{folder}/blocks")
    n_words = blocks.agg(F.sum("words")).first()[0] or 0
    buckets = max(1, ceil(n_words / p.bucket_words))

    flags = "block long, bucket long, bits binary"
    names = blocks.mapInArrow(_emit_names(p, buckets), "block long, bucket long, names binary, twice binary")
    _published(names.groupBy("bucket").applyInArrow(_repeated_names, flags), folder, "names")

    windows = blocks.mapInArrow(
        _emit_windows(p, folder, buckets), "block long, bucket long, high binary, low binary, docs binary"
    )
    _published(windows.groupBy("bucket").applyInArrow(_earlier_windows, flags), folder, "earlier")
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if texts else "")
    return blocks.mapInArrow(_emit_documents(p, folder, buckets, texts), out)
