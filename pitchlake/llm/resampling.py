"""Importance resampling: draw the documents whose hashed word features are
likelier in a target text collection than in the corpus.

Texts are cut into lines at newlines, which no word spans. The features of a
distinct line are counted once and multiplied by how often the line occurs;
pairs of words across a line's end are counted separately.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .storage import written
from .words import ALPHANUMERIC, LOWER, Words, find_words, slices, text_bytes


@dataclass(frozen=True)
class Resampling:
    """buckets: of the hashed features; the table of gains has as many numbers.
    least_words: of a document that may be drawn. percent: of those documents
    that are drawn. seed: of the draw. window_bytes: text of distinct lines that
    a task holds before it counts their features; a line that comes back later,
    or in another task, is counted there again, which changes no sum."""

    buckets: int = 10_000
    least_words: int = 20
    percent: int = 25
    seed: int = 7
    window_bytes: int = 8 << 20


# ---- checksums of words and word pairs ---------------------------------------


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_CRC = _crc_table()
#: Longer words are few and go through zlib one by one.
_STEPS = 48
_ALL = np.uint32(0xFFFFFFFF)


def _continued(crc: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each word, data[start:end], going on from earlier checksums."""
    out = crc ^ _ALL
    size = end - start
    left = np.flatnonzero((size > 0) & (size <= _STEPS))
    for k in range(_STEPS):
        left = left[size[left] > k]
        if not len(left):
            break
        now = out[left]
        out[left] = _CRC[(now ^ data[start[left] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out ^= _ALL
    for i in np.flatnonzero(size > _STEPS):
        out[i] = zlib.crc32(data[start[i] : end[i]], int(crc[i]))
    return out


def _word_crcs(words: Words) -> np.ndarray:
    return _continued(np.zeros(len(words.start), np.uint32), words.data, words.start, words.end)


def _pair_crcs(words: Words, crcs: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Of words first[i] and second[i] joined by a space."""
    spaced = crcs[first] ^ _ALL
    spaced = _CRC[(spaced ^ np.uint32(0x20)) & np.uint32(255)] ^ (spaced >> np.uint32(8)) ^ _ALL
    return _continued(spaced, words.data, words.start[second], words.end[second])


def _lower_words(lines: pa.Array) -> Words:
    data, offsets = text_bytes(lines)
    return find_words(LOWER[data], offsets, ALPHANUMERIC)


def _inner_pairs(words: Words) -> np.ndarray:
    """Words that another word of the same line follows."""
    last = np.zeros(len(words.start) + 1, bool)
    last[words.first[1:] - 1] = True  # a line without words marks the one before, which is a last one
    return np.flatnonzero(~last[: len(words.start)])


def _feature_buckets(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and line of every word and every pair of words of some lines."""
    crcs = _word_crcs(words)
    first = _inner_pairs(words)
    found = np.concatenate([crcs, _pair_crcs(words, crcs, first, first + 1)])
    line = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    return (found % np.uint32(buckets)).astype(np.int64), np.concatenate([line, line[first]])


# ---- lines of a batch of texts -----------------------------------------------


class _Lines:
    """Distinct lines of some texts and where they occur. line[i] is the number
    of the i-th line among the distinct ones, doc[i] its text's number."""

    def __init__(self, texts: pa.Array) -> None:
        lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
        coded = lists.flatten().dictionary_encode()
        offsets = np.asarray(lists.offsets)
        self.distinct = coded.dictionary
        self.line = coded.indices.to_numpy()
        self.doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
        self.occurs = np.bincount(self.line, minlength=len(self.distinct))

    def ends(self) -> tuple[Words, np.ndarray]:
        """First and last words of the distinct lines: word 2i is the first of
        line i, 2i + 1 its last; and how many words each line has."""
        parts, counts, at = [], [], 0
        starts, ends = [], []
        for i, j in slices(self.distinct):
            words = _lower_words(self.distinct[i:j])
            n = np.diff(words.first)
            some = np.flatnonzero(n)
            edge = np.zeros((2, j - i, 2), np.int64)
            for k, word in enumerate((words.first[:-1][some], words.first[1:][some] - 1)):
                edge[0, some, k], edge[1, some, k] = words.start[word], words.end[word]
            parts.append(words.data)
            starts.append(edge[0].ravel() + at)
            ends.append(edge[1].ravel() + at)
            counts.append(n)
            at += len(words.data)
        empty = np.zeros(0, np.int64)
        data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        flat = Words(data, np.concatenate([*starts, empty]), np.concatenate([*ends, empty]), empty, empty)
        return flat, np.concatenate([*counts, empty])

    def crossings(self, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lines with words that follow each other in a text, none with words
        between them: numbers of both lines, and of the text."""
        full = np.flatnonzero(n_words[self.line] > 0)
        here = np.flatnonzero(self.doc[full[1:]] == self.doc[full[:-1]]) if len(full) else full
        return self.line[full[here]], self.line[full[here + 1]], self.doc[full[here]]

    def crossing_buckets(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bucket of every distinct pair of lines that meet; the pair's number
        and text of each meeting; words of the distinct lines."""
        flat, n_words = self.ends()
        left, right, doc = self.crossings(n_words)
        pairs, number = np.unique(left.astype(np.int64) * len(self.distinct) + right, return_inverse=True)
        a, b = 2 * (pairs // max(1, len(self.distinct))) + 1, 2 * (pairs % max(1, len(self.distinct)))
        crcs = np.zeros(len(flat.start), np.uint32)
        used = np.unique(a)
        crcs[used] = _continued(np.zeros(len(used), np.uint32), flat.data, flat.start[used], flat.end[used])
        found = _pair_crcs(flat, crcs, a, b) % np.uint32(buckets)
        return found.astype(np.int64), number, doc, n_words


# ---- counts over a collection ------------------------------------------------


class _Window:
    """Distinct lines of a task with their occurrences, and the sums of what has
    left the window."""

    def __init__(self, p: Resampling) -> None:
        self.p, self.sums = p, np.zeros(p.buckets, np.int64)
        self.lines, self.occurs = pa.array([], pa.string()), np.zeros(0, np.int64)

    def add(self, texts: pa.Array) -> None:
        found = _Lines(texts)
        bucket, number, _, _ = found.crossing_buckets(self.p.buckets)
        np.add.at(self.sums, bucket, np.bincount(number, minlength=len(bucket)))
        coded = pa.concat_arrays([self.lines, found.distinct]).dictionary_encode()
        occurs = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(occurs, coded.indices.to_numpy(), np.concatenate([self.occurs, found.occurs]))
        self.lines, self.occurs = coded.dictionary, occurs
        if self.lines.nbytes > self.p.window_bytes:
            self.close()

    def close(self) -> np.ndarray:
        for i, j in slices(self.lines):
            bucket, line = _feature_buckets(_lower_words(self.lines[i:j]), self.p.buckets)
            counted = np.bincount(bucket, self.occurs[i:j][line], self.p.buckets)
            self.sums += np.rint(counted).astype(np.int64)
        self.lines, self.occurs = self.lines[:0], self.occurs[:0]
        return self.sums


def _text_batches(column: pa.Array) -> Iterator[tuple[int, int, pa.Array]]:
    for i, j in slices(column, 2 << 20):
        yield i, j, column[i:j]


def feature_counts(texts: DataFrame, text: str = "text", p: Resampling = Resampling()) -> DataFrame:
    """How often the features of each bucket occur in all texts: bucket, n.
    Buckets without any have no row. A task sends one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = _Window(p)
        for batch in batches:
            for _, _, part in _text_batches(batch.column(0)):
                window.add(part)
        sums = window.close()
        some = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(sums[some])], names=["bucket", "n"])

    counted = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def _vector(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets)
    for row in counts.collect():  # one row per bucket at most
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    n = float(len(raw))
    ratio = ((target + 1.0) * (raw.sum() + n)) / ((raw + 1.0) * (target.sum() + n))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


# ---- weights of documents ----------------------------------------------------


def _weigh(batch_texts: pa.Array, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, and the sum of the gains of all features, of each text."""
    found = _Lines(batch_texts)
    bucket, number, doc, n_words = found.crossing_buckets(len(gains))
    of_line = np.zeros(len(found.distinct), np.int64)
    for i, j in slices(found.distinct):
        own, line = _feature_buckets(_lower_words(found.distinct[i:j]), len(gains))
        np.add.at(of_line, i + line, gains[own])
    total, words = np.zeros(len(batch_texts), np.int64), np.zeros(len(batch_texts), np.int64)
    np.add.at(total, found.doc, of_line[found.line])
    np.add.at(words, found.doc, n_words[found.line])
    np.add.at(total, doc, gains[bucket[number]])
    return words, np.maximum(2 * words - 1, 0), total


def weigh_documents(docs: DataFrame, gains: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and weight (mean gain of the features, rounded
    down; 0 without any) of each document."""
    sent = docs.sparkSession.sparkContext.broadcast(gains)  # one number per bucket

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, part in _text_batches(batch.column(1)):
                words, features, total = _weigh(part, sent.value)
                weight = total // np.maximum(features, 1)  # rounds down
                yield pa.record_batch(
                    [batch.column(0)[i:j], pa.array(words), pa.array(features), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def _noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel number that depends on the id alone, rounded down."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _ranked(rows: DataFrame, order: list[Column], percent: int) -> DataFrame:
    """Rows with their place (1, 2, ...) in the given order; null beyond percent
    of the rows. Ranges of the order are sorted by themselves and their sizes,
    one number per partition, added up."""
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(spread.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect())
    before, total = [], 0
    for number, n in sizes:
        before.append((number, total))
        total += n
    offsets = rows.sparkSession.createDataFrame(before, "_part long, _before long")
    rank = F.col("_before") + F.col("_place") + 1
    out = placed.withColumns({"_part": part, "_place": place}).join(F.broadcast(offsets), "_part")
    return out.withColumn("rank", F.when(rank <= percent * total // 100, rank)).select(*rows.columns, "rank")


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    p: Resampling = Resampling(),
) -> DataFrame:
    """Draw documents that resemble the target texts.

    Returns doc_id, n_features, weight, score and rank of every document; rank
    (1 is the highest score, ties to the smaller id) is null for those that are
    not drawn: all but p.percent of the documents of at least p.least_words
    words. Words are runs of ASCII letters and digits and of all other
    characters beyond ASCII, A-Z lower-cased; features are single words and
    pairs of neighbours, hashed to p.buckets.

    A null text has no words: no features, weight 0, not drawn. A null id takes
    the random number of an empty id and comes after all others in a tie. Rows
    that repeat an id are documents of their own with the same random number;
    equal scores of equal ids are ordered by n_features, then as they are read.
    Empty tables give no rows, or all gains from smoothing alone.

    The corpus is scanned twice and no text is shuffled: the counts of a task
    are one number per bucket, and only short rows are sorted for the ranks.
    """
    gains = bucket_gains(
        _vector(feature_counts(docs, text, p), p.buckets),
        _vector(feature_counts(target, target_text, p), p.buckets),
    )
    weighed = weigh_documents(docs, gains, doc_id, text)
    scored = weighed.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), p.seed))
    scored = written(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")
    enough = F.col("n_words") >= p.least_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("_row")]
    drawn = _ranked(scored.where(enough), order, p.percent)
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select(F.col("doc_id").alias(doc_id), "n_features", "weight", "score", "rank")
