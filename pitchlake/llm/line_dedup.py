"""Reversible removal of repeated lines: exact tables count in how many documents
a line occurs, and sharded cuckoo filters tell which lines need a look there.
Documents can be added and deleted; the state is then that of a fresh start."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .storage import open_folder, publish_file, read_range, written
from .words import LOWER, NOT_SPACE, mix, slices, text_bytes


@dataclass(frozen=True)
class LineRule:
    """least_chars: code points of a line that can be removed, stripped of space
    at both ends. least_docs: documents that hold it."""

    least_chars: int = 20
    least_docs: int = 3


@dataclass(frozen=True)
class IndexLayout:
    """keys_per_shard: lines of a shard, on average, before shards are halved.
    least_shards: of any index, a power of two. local_bytes: largest filters and
    table of repeated lines that every task reads whole; larger ones are met by
    shuffles. salt: tasks that share one line there. layers: count tables before
    they are put together."""

    keys_per_shard: int = 1 << 19
    least_shards: int = 32
    local_bytes: int = 48 << 20
    salt: int = 32
    layers: int = 8


# ---- cuckoo filter -----------------------------------------------------------


class CuckooFilter:
    """Set of keys by 16-bit fingerprints in buckets of four: may take a key for
    one that is in, never misses one, and forgets keys that were added."""

    SLOTS = 4

    def __init__(self, table: np.ndarray) -> None:
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        """Empty, with room for so many keys."""
        buckets = 1 << max(3, int(np.ceil(np.log2(max(1, keys) / (0.8 * cls.SLOTS)))))
        return cls(np.zeros((buckets, cls.SLOTS), np.uint16))

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, np.uint16).reshape(-1, cls.SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _other(self, at: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return at ^ (mix(mark.astype(np.uint64), 7) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _places(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = (b.view(np.uint64) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        at = (a.view(np.uint64) & np.uint64(len(self.table) - 1)).astype(np.int64)
        return mark, at, self._other(at, mark)

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        mark, at, other = self._places(a, b)
        return ((self.table[at] == mark[:, None]) | (self.table[other] == mark[:, None])).any(1)

    def add(self, a: np.ndarray, b: np.ndarray, rounds: int = 400) -> bool:
        """Add keys, each of which is not in yet. False where they do not all
        fit; the filter is of no use then and must be built anew, larger."""
        mark, at, _ = self._places(a, b)
        if np.count_nonzero(self.table) + len(a) > 0.95 * self.table.size:
            return False
        for n in range(rounds):
            order = np.argsort(at, kind="stable")
            at, mark = at[order], mark[order]
            free = self.table[at] == 0
            rank = np.arange(len(at)) - np.searchsorted(at, at)
            fits = rank < free.sum(1)
            slot = (free & (np.cumsum(free, axis=1) == rank[:, None] + 1)).argmax(1)
            self.table[at[fits], slot[fits]] = mark[fits]
            at, mark = at[~fits], mark[~fits]
            if not len(at):
                return True
            if n:  # full on both sides: one of each bucket takes a place there
                bucket, first = np.unique(at, return_index=True)
                taken = (mix(bucket.astype(np.uint64), n) % np.uint64(self.SLOTS)).astype(np.int64)
                out = self.table[bucket, taken]
                self.table[bucket, taken] = mark[first]
                mark[first] = out
            at = self._other(at, mark)
        return False

    def remove(self, a: np.ndarray, b: np.ndarray) -> None:
        """Forget keys that were added, one fingerprint for each."""
        mark, at, other = self._places(a, b)
        while len(mark):
            here, there = self.table[at] == mark[:, None], self.table[other] == mark[:, None]
            inside = here.any(1)
            if not (inside | there.any(1)).all():
                raise ValueError("a key is removed that was not added")
            place = np.where(inside, at * self.SLOTS + here.argmax(1), other * self.SLOTS + there.argmax(1))
            _, first = np.unique(place, return_index=True)
            self.table.ravel()[place[first]] = 0
            left = np.ones(len(mark), bool)
            left[first] = False
            mark, at, other = mark[left], at[left], other[left]


# ---- lines of texts ----------------------------------------------------------


@dataclass
class _Lines:
    """Lines of some texts: line i is data[start[i]:end[i]], text d has the lines
    first[d] to first[d + 1]. long marks lines that count, of which a and b are
    the halves of the 128-bit key."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    long: np.ndarray
    a: np.ndarray
    b: np.ndarray

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _find_lines(texts: pa.Array, least_chars: int) -> _Lines:
    """A line's key is a cryptographic digest of the line without space at both
    ends, A-Z lower-cased; a null text is an empty line."""
    data, offsets = text_bytes(texts)
    breaks = np.flatnonzero(data == 10)
    first = np.arange(len(offsets)) + np.searchsorted(breaks, offsets)
    after = np.arange(len(breaks)) + np.searchsorted(offsets[1:], breaks, "right") + 1
    start, end = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    start[first[:-1]], start[after] = offsets[:-1], breaks + 1
    end[first[1:] - 1], end[after - 1] = offsets[1:], breaks
    solid = np.flatnonzero(NOT_SPACE[data])
    low, high = np.searchsorted(solid, start), np.searchsorted(solid, end)
    some = np.flatnonzero(high > low)
    low, high = solid[low[some]], solid[high[some] - 1] + 1
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    enough = chars[high] - chars[low] >= least_chars
    long = np.zeros(len(start), bool)
    long[some[enough]] = True
    lower = LOWER[data].tobytes()
    keys = b"".join(
        hashlib.blake2b(lower[i:j], digest_size=16).digest() for i, j in zip(low[enough].tolist(), high[enough].tolist())
    )
    halves = np.frombuffer(keys, "<i8").reshape(-1, 2)
    return _Lines(data, start, end, first, long, halves[:, 0].copy(), halves[:, 1].copy())


def _emit_keys(least_chars: int):
    """Keys of all lines that count, with the text's id and row: each once a slice."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text")):
                found = _find_lines(batch.column("text")[i:j], least_chars)
                text = found.text[found.long]
                order = np.lexsort((text, found.b, found.a))
                a, b, text = found.a[order], found.b[order], text[order]
                new = np.ones(len(a), bool)
                new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (text[1:] != text[:-1])
                at = pa.array(text[new] + i)
                yield pa.record_batch(
                    [pa.array(a[new]), pa.array(b[new]), batch.column("doc_id").take(at), batch.column("row").take(at)],
                    names=["a", "b", "doc_id", "row"],
                )

    return emit


# ---- which lines are repeated ------------------------------------------------


def _shard(a: Column, shards: int) -> Column:
    bits = shards.bit_length() - 1
    return F.shiftrightunsigned(a, 64 - bits).cast("int") if bits else F.lit(0)


class _Filters:
    """The filters of one kind, read shard by shard by a task that needs them."""

    def __init__(self, folder: str, kind: str, versions: list[str]) -> None:
        self.folder, self.kind, self.versions = folder, kind, versions
        self.held: dict[int, CuckooFilter] = {}

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        bits = len(self.versions).bit_length() - 1
        shard = (a.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(a), np.int64)
        out = np.zeros(len(a), bool)
        for k in np.unique(shard).tolist():
            if k not in self.held:
                raw = read_range(self.folder, f"{self.kind}-{k}-{self.versions[k]}")
                self.held[k] = CuckooFilter.from_bytes(raw)
            mine = shard == k
            out[mine] = self.held[k].holds(a[mine], b[mine])
        return out


class _Repeated:
    """Exact table of repeated lines, whole: key halves and last document."""

    def __init__(self, path: str) -> None:
        filesystem, folder = open_folder(path)
        rows = pq.read_table(folder, filesystem=filesystem)
        self.last = rows["last"].combine_chunks()
        a, b = rows["a"].to_numpy(), rows["b"].to_numpy()
        order = np.lexsort((b, a))
        self.a, self.b, self.last = a[order], b[order], self.last.take(pa.array(order))

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of each key in the table, -1 where it is not there."""
        out, at = np.full(len(a), -1), np.searchsorted(self.a, a)
        left = np.arange(len(a))
        while len(left):
            left = left[at[left] < len(self.a)]
            left = left[self.a[at[left]] == a[left]]
            same = self.b[at[left]] == b[left]
            out[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1
        return out


def _kept(found: _Lines, gone: np.ndarray, texts: bool) -> dict:
    """Columns of texts without the lines marked gone (flags of the long lines)."""
    drop = np.zeros(len(found.start), bool)
    drop[np.flatnonzero(found.long)[gone]] = True
    text = found.text
    dropped = np.bincount(text[drop], minlength=len(found.first) - 1)
    raw = found.data.tobytes()
    rest = []
    for d in range(len(dropped)):
        i, j = found.first[d], found.first[d + 1]
        if not dropped[d]:
            rest.append(raw[found.start[i] : found.end[j - 1]])
        else:
            keep = np.flatnonzero(~drop[i:j]) + i
            rest.append(b"\n".join(raw[s:e] for s, e in zip(found.start[keep].tolist(), found.end[keep].tolist())))
    columns = {
        "n_lines": pa.array(np.diff(found.first)),
        "n_dropped": pa.array(dropped),
        "kept_sha256": pa.array([hashlib.sha256(r).hexdigest() for r in rest], pa.string()),
    }
    return columns | ({"kept_text": pa.array(rest, pa.string())} if texts else {})


# ---- the index ---------------------------------------------------------------


@dataclass
class _State:
    """What a version of the index consists of: postings (a batch of a, b,
    doc_id for each insertion), deletions (ids, and how many batches they
    concern), layers of counts (later ones replace earlier ones) and the name
    under which each shard's filters were written last."""

    version: int = 0
    id_type: str = ""
    keys: int = 0
    repeated: int = 0
    postings: list[str] = field(default_factory=list)
    deletions: list[tuple[str, int]] = field(default_factory=list)
    counts: list[str] = field(default_factory=list)
    shards: list[str] = field(default_factory=list)


class LineIndex:
    """Which documents hold which lines, in a folder that all executors share.

    insert() adds documents, delete() takes them out again, keep_lines() drops
    the lines that at least rule.least_docs of the documents hold, except in
    the one of largest id among them. After any insertions and deletions results
    are the same as of an index filled at once with what is left.

    Rows of one id are one document; all rows without an id are one, of the
    smallest id. Inserting an id that is there adds lines to that document.
    Documents need not be in the index to be cut by keep_lines().

    Each operation publishes one small state file at its end, so one that dies
    leaves the index as it was, and a new session can open the folder. There
    must be one writer at a time. Files of earlier versions stay until the
    folder is deleted.
    """

    def __init__(
        self, spark: SparkSession, folder: str, rule: LineRule = LineRule(), layout: IndexLayout = IndexLayout()
    ) -> None:
        self.spark, self.folder, self.rule, self.layout = spark, folder.rstrip("/"), rule, layout
        self.state = self._stored()

    def _stored(self) -> _State:
        as_path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = as_path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(as_path(f"{self.folder}/states")):
            return _State()
        names = [f.getPath().getName() for f in files.listStatus(as_path(f"{self.folder}/states"))]
        last = max((int(n) for n in names if n.isdigit()), default=None)
        return _State() if last is None else _State(**json.loads(read_range(f"{self.folder}/states", str(last))))

    def _publish(self, state: _State) -> None:
        publish_file(f"{self.folder}/states", str(state.version), [json.dumps(state.__dict__).encode()])
        self.state = state

    def _table(self, df: DataFrame, name: str) -> tuple[str, DataFrame]:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path, self.spark.read.schema(df.schema).parquet(path)

    def _read(self, path: str, shape: str) -> DataFrame:
        return self.spark.read.schema(shape).parquet(path)

    # What the state stands for.

    def _postings(self, state: _State) -> DataFrame:
        """Every line key of every document that is there: a, b, doc_id."""
        shape, out = f"a long, b long, doc_id {state.id_type}", None
        for i, path in enumerate(state.postings):
            rows = self._read(path, shape)
            for ids, upto in state.deletions:
                if i < upto:
                    gone = self._read(ids, f"_gone {state.id_type}")
                    rows = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti")
            out = rows if out is None else out.unionAll(rows)
        return out

    def _counts(self, state: _State) -> DataFrame:
        """a, b, refs (documents), last (largest id); keys of no document with 0."""
        shape = f"a long, b long, refs long, last {state.id_type}, was long"
        rows = [self._read(p, shape).withColumn("layer", F.lit(i)) for i, p in enumerate(state.counts)]
        if len(rows) == 1:
            return rows[0].select("a", "b", "refs", "last")
        both = rows[0]
        for more in rows[1:]:
            both = both.unionAll(more)
        newest = both.groupBy("a", "b").agg(F.max_by(F.struct("refs", "last"), "layer").alias("v"))
        return newest.select("a", "b", "v.refs", "v.last")

    def counts(self) -> DataFrame:
        """Keys with the documents that hold them now: a, b, refs, last."""
        return self._counts(self.state).where("refs > 0")

    # Filters.

    def _seen(self, rows: DataFrame, kind: str, seen: bool = True) -> DataFrame:
        """Rows (a, b, ...; one per key) that the filters hold, or do not."""
        folder, versions = f"{self.folder}/filters", self.state.shards

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = _Filters(folder, kind, versions)
            for batch in batches:
                if len(filters.held) > 8:
                    filters.held.clear()
                hit = filters.holds(batch.column("a").to_numpy(), batch.column("b").to_numpy())
                yield batch.filter(pa.array(hit == seen))

        shard = _shard(F.col("a"), len(versions))
        dealt = rows.repartition(shard).sortWithinPartitions(shard)
        return dealt.mapInArrow(probe, rows.schema)

    def _update_filters(self, layer: DataFrame, state: _State) -> bool:
        """Put the changes of a layer (refs now, was before) into the filters of
        their shards. False where a filter is full."""
        folder, versions, new_name, m = f"{self.folder}/filters", state.shards, uuid.uuid4().hex, self.rule.least_docs

        def update(group: pa.Table) -> pa.Table:
            shard = group["shard"][0].as_py()
            a, b, refs, was = (group[c].to_numpy() for c in ("a", "b", "refs", "was"))
            fits = True
            for kind, least in (("seen", 1), ("repeated", m)):
                filter_ = CuckooFilter.from_bytes(read_range(folder, f"{kind}-{shard}-{versions[shard]}"))
                out, new = (refs < least) & (was >= least), (refs >= least) & (was < least)
                filter_.remove(a[out], b[out])
                fits &= filter_.add(a[new], b[new])
                publish_file(folder, f"{kind}-{shard}-{new_name}", [filter_.to_bytes()])
            return pa.table({"shard": pa.array([shard], pa.int32()), "fits": [bool(fits)]})

        rows = layer.select(_shard(F.col("a"), len(versions)).alias("shard"), "a", "b", "refs", "was")
        done = written(rows.groupBy("shard").applyInArrow(update, "shard int, fits boolean"), "filters").collect()
        for row in done:  # one row per shard
            versions[row["shard"]] = new_name
        return all(row["fits"] for row in done)

    def _build_filters(self, counts: DataFrame, state: _State) -> None:
        """All filters anew, with room for growth, in as many shards as the keys ask for."""
        folder, new_name, m = f"{self.folder}/filters", uuid.uuid4().hex, self.rule.least_docs
        shards = self.layout.least_shards
        while state.keys > shards * self.layout.keys_per_shard:
            shards *= 2

        def build(group: pa.Table) -> pa.Table:
            shard = group["shard"][0].as_py()
            a, b, refs = (group[c].to_numpy() for c in ("a", "b", "refs"))
            for kind, least in (("seen", 1), ("repeated", m)):
                mine, room = refs >= least, 1.5
                while True:
                    filter_ = CuckooFilter.sized(int(room * mine.sum()))
                    if filter_.add(a[mine], b[mine]):
                        break
                    room *= 2
                publish_file(folder, f"{kind}-{shard}-{new_name}", [filter_.to_bytes()])
            return pa.table({"shard": pa.array([shard], pa.int32())})

        rows = counts.select(_shard(F.col("a"), shards).alias("shard"), "a", "b", "refs")
        done = written(rows.groupBy("shard").applyInArrow(build, "shard int"), "filters").collect()
        for shard in set(range(shards)) - {row["shard"] for row in done}:
            for kind in ("seen", "repeated"):
                publish_file(folder, f"{kind}-{shard}-{new_name}", [CuckooFilter.sized(0).to_bytes()])
        state.shards = [new_name] * shards

    def _advance(self, state: _State, layer: DataFrame) -> None:
        """Publish a state whose counts end with the given layer."""
        new, gone, up, down = layer.agg(
            F.count_if(F.expr("refs > 0 and was = 0")),
            F.count_if(F.expr("refs = 0 and was > 0")),
            F.count_if(F.expr(f"refs >= {self.rule.least_docs} and was < {self.rule.least_docs}")),
            F.count_if(F.expr(f"refs < {self.rule.least_docs} and was >= {self.rule.least_docs}")),
        ).first()
        state.keys, state.repeated = state.keys + new - gone, state.repeated + up - down
        if len(state.counts) > self.layout.layers:
            whole = self._counts(state).where("refs > 0").withColumn("was", F.col("refs"))
            state.counts = [self._table(whole, "counts")[0]]
        full = not state.shards or state.keys > len(state.shards) * self.layout.keys_per_shard
        if full or not self._update_filters(layer, state):
            self._build_filters(self._counts(state).where("refs > 0"), state)
        self._publish(state)

    def _next(self) -> _State:
        now = self.state
        lists = {k: list(getattr(now, k)) for k in ("postings", "deletions", "counts", "shards")}
        return replace(now, version=now.version + 1, **lists)

    # Operations.

    def _keys(self, docs: DataFrame, doc_id: str, text: str, row: Column) -> DataFrame:
        plain = docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), row.alias("row")
        )
        kind = plain.schema["doc_id"].dataType.simpleString()
        return plain.mapInArrow(_emit_keys(self.rule.least_chars), f"a long, b long, doc_id {kind}, row long")

    def insert(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> None:
        state = self._next()
        state.id_type = docs.schema[doc_id].dataType.simpleString()
        keys = self._keys(docs, doc_id, text, F.lit(0).cast("long")).select("a", "b", "doc_id").distinct()
        if not self.state.postings:
            path, batch = self._table(keys, "postings")
            fresh = batch.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
            changed = fresh.select("a", "b", F.col("n").alias("refs"), "last", F.lit(0).cast("long").alias("was"))
        else:
            keys = written(keys, "keys")
            # Only keys that the filters may hold are looked up in the exact tables.
            known = written(self._seen(keys.select("a", "b").distinct(), "seen"), "known")
            mine = self._postings(self.state).join(known, ["a", "b"], "left_semi").alias("p")
            same = (F.col("k.a") == F.col("p.a")) & (F.col("k.b") == F.col("p.b"))
            path, batch = self._table(
                keys.alias("k").join(mine, same & F.col("k.doc_id").eqNullSafe(F.col("p.doc_id")), "left_anti"), "postings"
            )
            fresh = batch.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("doc_id").alias("late"))
            old = self._counts(self.state).join(known, ["a", "b"], "left_semi")
            changed = fresh.join(old, ["a", "b"], "left").select(
                "a",
                "b",
                (F.coalesce("refs", F.lit(0)) + F.col("n")).alias("refs"),
                F.greatest("last", "late").alias("last"),
                F.coalesce("refs", F.lit(0)).cast("long").alias("was"),
            )
        state.postings.append(path)
        path, layer = self._table(changed, "counts")
        state.counts.append(path)
        self._advance(state, layer)

    def delete(self, ids: DataFrame, doc_id: str = "doc_id") -> None:
        """Take documents out: those whose ids are given, a null for all rows
        without one. Ids that are not there change nothing."""
        if not self.state.postings:
            return
        state = self._next()
        kind = state.id_type
        path, gone = self._table(ids.select(F.col(f"`{doc_id}`").cast(kind).alias("_gone")).distinct(), "deletions")
        state.deletions.append((path, len(state.postings)))
        out = self._postings(self.state).join(gone, F.col("doc_id").eqNullSafe(F.col("_gone")), "left_semi")
        touched = written(out.groupBy("a", "b").agg(F.count("*").alias("n")), "touched")
        left = self._postings(state).join(touched, ["a", "b"], "left_semi").groupBy("a", "b").agg(F.max("doc_id").alias("late"))
        changed = touched.join(self._counts(self.state), ["a", "b"]).join(left, ["a", "b"], "left")
        path, layer = self._table(
            changed.select("a", "b", (F.col("refs") - F.col("n")).alias("refs"), F.col("late").alias("last"), F.col("refs").alias("was")),
            "counts",
        )
        state.counts.append(path)
        self._advance(state, layer)

    def keep_lines(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", texts: bool = True) -> DataFrame:
        """doc_id, n_lines, n_dropped, kept_sha256 of every row and, with texts,
        kept_text: its text without the lines that go. A null or empty text is
        one empty line. Lines are compared by 128 bits of a cryptographic digest.
        """
        id_type = docs.schema[doc_id].dataType.simpleString()
        shape = f"doc_id {id_type}, n_lines long, n_dropped long, kept_sha256 string" + (", kept_text string" if texts else "")
        plain = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
        if not self.state.shards:
            cut = plain.mapInArrow(self._cut_nothing(texts), shape)
        elif 40 * self.state.repeated + 64 * len(self.state.shards) <= self.layout.local_bytes:
            cut = plain.mapInArrow(self._cut_locally(texts), shape)
        else:
            cut = self._cut_by_shuffles(plain, texts, shape)
        return cut.withColumnRenamed("doc_id", doc_id)

    def _repeated(self) -> DataFrame:
        return self.counts().where(F.col("refs") >= self.rule.least_docs).select("a", "b", "last")

    def _cut_nothing(self, texts: bool):
        least = self.rule.least_chars

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, j in slices(batch.column("text")):
                    found = _find_lines(batch.column("text")[i:j], least)
                    none = np.zeros(len(found.a), bool)
                    yield pa.record_batch({"doc_id": batch.column("doc_id")[i:j], **_kept(found, none, texts)})

        return cut

    def _cut_locally(self, texts: bool):
        """Every task reads the filters and the table of repeated lines, whose
        size was checked; keys that the filters do not hold are not looked up."""
        least, folder, versions = self.rule.least_chars, f"{self.folder}/filters", self.state.shards
        path, _ = self._table(self._repeated().repartition(8), "repeated")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters, table = _Filters(folder, "repeated", versions), _Repeated(path)
            for batch in batches:
                for i, j in slices(batch.column("text")):
                    found = _find_lines(batch.column("text")[i:j], least)
                    hit = np.flatnonzero(filters.holds(found.a, found.b))
                    at = table.find(found.a[hit], found.b[hit])
                    hit, at = hit[at >= 0], at[at >= 0]
                    ids = batch.column("doc_id")[i:j]
                    mine = ids.take(pa.array(found.text[found.long][hit]))
                    last = table.last.take(pa.array(at))
                    own = pc.or_(pc.fill_null(pc.equal(mine, last), False), pc.and_(mine.is_null(), last.is_null()))
                    gone = np.zeros(len(found.a), bool)
                    gone[hit] = ~own.to_numpy(zero_copy_only=False)
                    yield pa.record_batch({"doc_id": ids, **_kept(found, gone, texts)})

        return cut

    def _cut_by_shuffles(self, plain: DataFrame, texts: bool, shape: str) -> DataFrame:
        """Distinct keys meet the filters shard by shard, what these hold meets
        the exact table, and each row gets the list of its lines that go. A line
        of many rows is dealt over several tasks."""
        staged = written(plain.withColumn("row", F.monotonically_increasing_id()), "rows")
        keys = written(self._keys(staged, "doc_id", "text", F.col("row")), "keys")
        maybe = self._seen(keys.select("a", "b").distinct(), "repeated")
        # Each key of the table as often as there are parts of its rows.
        known = maybe.join(self._repeated(), ["a", "b"]).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(self.layout.salt - 1))))
        dealt = keys.withColumn("_s", F.pmod(F.xxhash64("row"), F.lit(self.layout.salt)).cast("int"))
        gone = dealt.join(known, ["a", "b", "_s"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
        lists = gone.groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("gone"))  # lines of one text
        least = self.rule.least_chars

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, j in slices(batch.column("text")):
                    found = _find_lines(batch.column("text")[i:j], least)
                    lists = batch.column("gone")[i:j]
                    owner = np.repeat(np.arange(j - i), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                    pairs = lists.flatten()
                    listed = set(zip(owner.tolist(), *(pairs.field(k).to_numpy().tolist() for k in (0, 1))))
                    lines = zip(found.text[found.long].tolist(), found.a.tolist(), found.b.tolist())
                    mark = np.fromiter((k in listed for k in lines), bool, len(found.a))
                    yield pa.record_batch({"doc_id": batch.column("doc_id")[i:j], **_kept(found, mark, texts)})

        return staged.join(lists, "row", "left").select("doc_id", "text", "gone").mapInArrow(cut, shape)


def drop_repeated_lines(
    docs: DataFrame,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    texts: bool = True,
    rule: LineRule = LineRule(),
    layout: IndexLayout = IndexLayout(),
) -> DataFrame:
    """A new index of docs in folder, and docs without their repeated lines."""
    index = LineIndex(docs.sparkSession, folder, rule, layout)
    index.insert(docs, doc_id, text)
    return index.keep_lines(docs, doc_id, text, texts)
