"""Quality classifier: gated attention over the passages of a document, learned
from labels of whole documents (multiple-instance learning)."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import written
from .words import LOWER, Words, slices, words_of


@dataclass(frozen=True)
class Learning:
    """passage: words of one. most_rows: labelled documents that the model is
    fitted on at most, those of least hash of their id. Learning and scoring read
    every passage of a document. local_bytes: of their features that the driver
    learns from at most; gradients of more are summed in Spark. hidden, gate:
    widths of the encoder and of the attention. keep: least score that counts as
    good."""

    passage: int = 32
    most_rows: int = 4000
    local_bytes: int = 64 << 20
    hidden: int = 16
    gate: int = 8
    steps: int = 100
    rate: float = 0.03
    decay: float = 1e-3
    keep: float = 0.3
    seed: int = 9


def _byte_class(test) -> np.ndarray:
    return np.array([test(b) for b in range(256)])


#: Kinds of bytes; a word is described by what it has of each.
KINDS = [
    _byte_class(lambda b: 65 <= b <= 90),
    _byte_class(lambda b: 97 <= b <= 122),
    _byte_class(lambda b: 48 <= b <= 57),
    _byte_class(lambda b: b >= 128),
    _byte_class(lambda b: chr(b) in ".,;:'\"-()?"),
    _byte_class(lambda b: 32 < b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:'\"-()?"),
]
FEATURES = 27


def passages(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of size words, the last of a document shorter;
    and each document's first. A document without words has one, of zeros."""
    n_words = np.diff(words.first)
    n = len(words.start)
    per_doc = np.maximum(1, -(-n_words // size))
    first = np.concatenate([[0], np.cumsum(per_doc)])
    total = int(first[-1])
    out = np.zeros((total, FEATURES), np.float32)
    if not n:
        return out, first
    doc = np.repeat(np.arange(len(n_words)), n_words)
    place = np.arange(n) - words.first[:-1][doc]
    passage = first[:-1][doc] + place // size

    def per_passage(values: np.ndarray) -> np.ndarray:
        return np.bincount(passage, values, total)

    length = (words.end - words.start).astype(np.float64)
    count = np.maximum(per_passage(np.ones(n)), 1)
    bytes_ = np.maximum(per_passage(length), 1)
    kinds = []
    for marks in KINDS:
        sums = np.zeros(len(words.data) + 1, np.int32)
        np.cumsum(marks[words.data], out=sums[1:])
        kinds.append((sums[words.end] - sums[words.start]).astype(np.float64))
    upper, lower, digit, high, point, sign = kinds
    columns = [per_passage(k) / bytes_ for k in kinds]
    h = words.hashes(LOWER)
    same = np.zeros(n)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    # Passage and 40 bits of the word's hash: equal neighbours are equal words.
    key = np.sort((passage.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    fresh = np.ones(n)
    fresh[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key >> np.uint64(40)).astype(np.int64), fresh, total)
    last = words.data[words.end - 1]
    lead = words.data[words.start]
    letters = (upper > 0) & (lower == 0) & (length > 1)
    long = length > 25
    mean = per_passage(length) / count
    columns += [
        per_passage(same) / count,
        distinct / count,
        mean / 10,
        np.sqrt(np.maximum(per_passage(length**2) / count - mean**2, 0)) / 10,
        per_passage(letters) / count,
        per_passage(long) / count,
        per_passage(length == 1) / count,
        per_passage(sign > 0) / count,
        per_passage(sign == length) / count,
        per_passage((digit > 0)) / count,
        per_passage((upper > 0) & (upper < length)) / count,
        per_passage(point > 0) / count,
        per_passage(high > 0) / count,
        per_passage(last == ord(".")) / count,
        per_passage(last == ord("!")) / count,
        per_passage(last == ord("|")) / count,
        per_passage(np.isin(last, [ord(c) for c in "*#$%&"])) / count,
        per_passage((lead >= 97) & (lead <= 122)) / count,
        np.minimum(count / size, 1),
        np.ones(total),
        np.log1p(n_words)[np.repeat(np.arange(len(n_words)), per_doc)] / 10,
    ]
    found = np.stack(columns, axis=1).astype(np.float32)
    empty = np.repeat(n_words == 0, per_doc)
    found[empty] = 0
    out[:] = found
    return out, first


class Attention:
    """Passages are encoded, weighed by a gated attention over their document,
    and the weighted sum is scored (logistic)."""

    def __init__(self, learning: Learning) -> None:
        rng = np.random.default_rng(learning.seed)
        f, d, g = FEATURES, learning.hidden, learning.gate
        shapes = {"W": (f, d), "b": (d,), "V": (d, g), "U": (d, g), "w": (g,), "c": (d,), "o": (1,)}
        self.weights = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if k.isupper() or k in "wc" else np.zeros(s) for k, s in shapes.items()}
        self.mean, self.spread = np.zeros(f), np.ones(f)

    def _forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        p = self.weights
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        h = np.tanh(x @ p["W"] + p["b"])
        t = np.tanh(h @ p["V"])
        u = 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * u) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, first[:-1])[doc])
        a = e / np.add.reduceat(e, first[:-1])[doc]
        z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
        logit = np.clip(z @ p["c"] + p["o"], -30, 30)
        return {"doc": doc, "h": h, "t": t, "u": u, "a": a, "z": z, "score": 1 / (1 + np.exp(-logit))}

    def scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if len(first) < 2:
            return np.zeros(0)
        return self._forward((x - self.mean) / self.spread, first)["score"]

    def moments(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict:
        return {"docs": np.array([len(y)]), "n": np.array([len(x)]), "sum": x.sum(axis=0), "squares": (x**2).sum(axis=0)}

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict:
        """Of the log losses of some whole documents, summed."""
        p = self.weights
        x = (x - self.mean) / self.spread
        f = self._forward(x, first)
        doc, h, t, u, a, z = (f[k] for k in ("doc", "h", "t", "u", "a", "z"))
        d_logit = f["score"] - y
        dz = d_logit[:, None] * p["c"]
        da = (h * dz[doc]).sum(axis=1)
        mean = np.add.reduceat(a * da, first[:-1])
        de = a * (da - mean[doc])
        dt, du = de[:, None] * p["w"] * u * (1 - t**2), de[:, None] * p["w"] * t * u * (1 - u)
        dh = a[:, None] * dz[doc] + dt @ p["V"].T + du @ p["U"].T
        dh *= 1 - h**2
        return {
            "W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ du,
            "w": (t * u).T @ de, "c": z.T @ d_logit, "o": d_logit.sum(keepdims=True),
        }

    def fit(self, total: Callable[[Callable], dict | None], learning: Learning) -> Attention:
        """Adam on the mean log loss of whole documents; total sums what a function
        of (x, first, y) returns over all of them."""
        found = total(self.moments)
        if found is None:
            return self
        docs = int(found["docs"][0])
        self.mean = found["sum"] / found["n"]
        self.spread = np.sqrt(np.maximum(found["squares"] / found["n"] - self.mean**2, 0)) + 1e-3
        p = self.weights
        m = {k: np.zeros_like(v) for k, v in p.items()}
        s = {k: np.zeros_like(v) for k, v in p.items()}
        for step in range(1, learning.steps + 1):
            for k, g in total(self.gradients).items():
                g = g / docs
                if k not in ("b", "o"):
                    g = g + learning.decay * p[k] / docs**0.5
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                p[k] = p[k] - learning.rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
        return self


def _parts(x: list[bytes], y: list[float], most: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Whole documents of about most passages, ready for the model."""
    ends = np.cumsum([len(v) // (4 * FEATURES) for v in x])
    for part in np.split(np.arange(len(x)), np.flatnonzero(np.diff(ends // most)) + 1):
        held = [np.frombuffer(x[i], np.float32).reshape(-1, FEATURES) for i in part]
        if held:
            first = np.concatenate([[0], np.cumsum([len(v) for v in held])])
            yield np.concatenate(held).astype(np.float64), first, np.array([y[i] for i in part])


def _summed(results: Iterable[dict]) -> dict | None:
    total = None
    for found in results:
        total = found if total is None else {k: total[k] + v for k, v in found.items()}
    return total


def _total_local(rows: list) -> Callable[[Callable], dict | None]:
    x, y = [r["x"] for r in rows], [r["quality"] for r in rows]
    return lambda of: _summed(of(*part) for part in _parts(x, y))


def _total_spark(stored: DataFrame) -> Callable[[Callable], dict | None]:
    """Every task sums over its documents; one short row of each comes back."""

    def total(of: Callable) -> dict | None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = (part for b in batches for part in _parts(b.column("x").to_pylist(), b.column("quality").to_pylist()))
            found = _summed(of(*part) for part in parts)
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], names=["found"])

        return _summed(pickle.loads(r["found"]) for r in stored.mapInArrow(run, "found binary").collect())

    return total


def _features(learning: Learning):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text")):
                x, first = passages(words_of(batch.column("text")[i:j]), learning.passage)
                held = [x[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[i:j], batch.column("quality")[i:j], pa.array(held, pa.binary())],
                    names=["id", "quality", "x"],
                )

    return run


def held_out(doc_id: str):
    """Rows that a model never learns from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    learning: Learning = Learning(),
) -> Attention:
    """Fit the model on labelled documents that are not held out.

    Labels other than 0 and 1 and labels or documents without an id are left
    out; of several labels of one id the least counts, and of several rows of one
    document id the one whose features come first. Without any label the model
    scores every document alike.
    """
    ids = docs.select(F.col(doc_id).alias("id")).distinct()
    given = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1) & ~held_out(doc_id))
        .groupBy(F.col(doc_id).alias("id"))
        .agg(F.min(label).cast("double").alias("quality"))
        .join(ids, "id", "left_semi")
        .orderBy(F.xxhash64("id"), "id")
        .limit(learning.most_rows)
    )
    # At most most_rows short rows, by the limit.
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(given), "id")
    kind = docs.schema[doc_id].dataType.simpleString()
    described = rows.mapInArrow(_features(learning), f"id {kind}, quality double, x binary")
    # One row per labelled id, however often an id is repeated.
    once = described.groupBy("id").agg(F.min("quality").alias("quality"), F.min("x").alias("x"))
    stored = written(once, "features")
    held = stored.agg(F.sum(F.octet_length("x"))).first()[0] or 0
    if held > learning.local_bytes:
        return Attention(learning).fit(_total_spark(stored), learning)
    return Attention(learning).fit(_total_local(sorted(stored.collect(), key=lambda r: r["id"])), learning)


def _score(model: Attention, learning: Learning, text: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.zeros(0)]
            for i, j in slices(batch.column(text)):
                x, first = passages(words_of(batch.column(text)[i:j]), learning.passage)
                scores.append(model.scores(x.astype(np.float64), first))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in keep], pa.array(np.concatenate(scores))], names=[*keep, "_score"]
            )

    return run


def score_quality(
    docs: DataFrame, model: Attention, keep: list[str], text: str = "text", learning: Learning = Learning()
) -> DataFrame:
    """Columns keep of docs, with score (0 to 1, higher for good documents) and
    predicted (1 if the score is at least learning.keep). Every passage of the
    whole text counts; null and empty texts score as one empty passage. Neither
    labels nor any other column is an input."""
    rows = docs.select(*dict.fromkeys([*keep, text]))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    scored = rows.mapInArrow(_score(model, learning, text, keep), f"{kinds}, _score double")
    return scored.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col("_score").alias("score"),
        F.when(F.col("_score") >= learning.keep, 1).otherwise(0).cast("int").alias("predicted"),
    )
