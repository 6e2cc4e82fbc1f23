"""Token ids in binary shards, with a minimal perfect hash index from document
keys to their place.

Layout of a folder: `shard-00000.ids` and so on hold nothing but ids, little
endian, 2 bytes each where the vocabulary allows and else 4, in ascending order
of documents; `index-00000.mph` and so on, one for each bucket of keys;
`manifest.json` with the width, the number of buckets and the first id of every
shard. `entries` is a table of the keys with their places.
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .storage import open_folder, publish_file, read_range
from .words import combine, mix, text_bytes

ENTRY = "copy long, shard int, at long, n_tokens long"
SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("at", "<u8"), ("n", "<u8")])


@dataclass(frozen=True)
class ShardLayout:
    """end_id: id after each document. bucket_keys: keys of one index file.
    read_ids: ids that one reading task takes at a time, about."""

    end_id: int = 2
    bucket_keys: int = 1 << 17
    read_ids: int = 4 << 20


# ---- encoding ---------------------------------------------------------------


class WordEncoder:
    """Ids of texts, by their words between spaces.

    Only for tokenizers that cut at white space and drop it, so that the ids of
    a text are those of its words one after the other; `fits` tells them by
    their file. A word's ids are kept for the next time it is met; words that
    come often are among the first and stay.
    """

    #: Bytes of all kept words and ids, beyond which new words are encoded each
    #: time they come up, and what a word takes beside them.
    KEPT_BYTES, WORD_BYTES = 48 << 20, 100
    SIMPLE = re.compile(r"([A-Za-z]+)([.,]?)\Z")

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.kept: dict[str, bytes] = {}
        self.kept_bytes = 0
        self.marks = {"": []}
        for mark in ".,":
            self.marks[mark] = tokenizer.encode(mark, add_special_tokens=False).ids

    @staticmethod
    def fits(spec: dict) -> bool:
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = steps[0] if steps else {}
        return (
            split.get("type") == "Split"
            and split.get("behavior") == "Removed"
            and split.get("invert") is True
            and split.get("pattern", {}).get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
            and not any(t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", []))
            and any(
                s.get("type") == "Lowercase"
                for s in (spec.get("normalizer") or {}).get("normalizers", [])
            )
            and spec.get("post_processor") is None
        )

    def word(self, text: str) -> bytes:
        simple = self.SIMPLE.match(text)
        if simple:  # letters in one piece, then at most one mark in another
            ids = [t.id for t in self.tokenizer.model.tokenize(simple[1].lower())]
            ids = ids + self.marks[simple[2]]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        found = np.array(ids, "<u4").tobytes()
        size = len(text) + len(found) + self.WORD_BYTES
        if self.kept_bytes + size <= self.KEPT_BYTES:
            self.kept[text] = found
            self.kept_bytes += size
        return found

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the number of ids of each."""
        lists = pc.split_pattern_regex(pc.fill_null(texts, ""), "[ \t-\r]+")
        words = lists.flatten().dictionary_encode()
        encode = self.word
        pieces = [self.kept.get(w) or encode(w) for w in words.dictionary.to_pylist()]
        lengths = np.fromiter((len(p) // 4 for p in pieces), np.int64, len(pieces))
        flat = np.frombuffer(b"".join(pieces), "<u4")
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        at = words.indices.to_numpy()
        n = lengths[at]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(starts[at] - total[:-1], n) + np.arange(total[-1])]
        ends = np.asarray(lists.offsets)
        return ids, np.diff(total[ends - ends[0]])


class TextEncoder:
    """Ids of texts by any tokenizer."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [
            e.ids
            for e in self.tokenizer.encode_batch_fast(
                pc.fill_null(texts, "").to_pylist(), add_special_tokens=False
            )
        ]
        lengths = np.array([len(x) for x in found], np.int64)
        return np.array([i for x in found for i in x], "<u4"), lengths


@cache
def encoder(tokenizer_file: str):
    """The encoder of a file, kept by the worker process for its next tasks."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    with open(tokenizer_file) as file:
        fits = WordEncoder.fits(json.load(file))
    return WordEncoder(tokenizer) if fits else TextEncoder(tokenizer)


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(lengths), end_id), lengths + 1


# ---- minimal perfect hash ---------------------------------------------------


class KeyIndex:
    """Minimal perfect hash of a set of keys, each two 64-bit hashes.

    Each level hashes the keys that are left to a row of bits twice their
    number, and marks the bits that one key alone falls on. A key's slot is the
    number of marks before its own. Lookups take a few steps whatever the size;
    a stored fingerprint tells nearly all keys that are not in the set.
    """

    SPACE = 2.0

    def __init__(self, levels: list[int], bits: np.ndarray, slots: np.ndarray) -> None:
        self.levels, self.bits, self.slots = levels, bits, slots
        marks = np.bitwise_count(bits).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(marks)])[:-1]

    @staticmethod
    def prints(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        return (combine(h2, h1, 77) >> np.uint64(32)).astype("<u4")

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, shard, at, n) -> KeyIndex:
        left = np.arange(len(h1))
        levels, rows = [], []
        while len(left):
            if len(levels) == 64:
                raise ValueError("two keys have the same two hashes")
            size = 64 * max(1, ceil(cls.SPACE * len(left) / 64))
            place = (combine(h1[left], h2[left], len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(size)
            rows.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[place]]
        bits = np.concatenate(rows) if rows else np.zeros(0, "<u8")
        index = cls(levels, bits, np.zeros(len(h1), SLOT))
        slot = index.slot(h1, h2)
        for name, values in (("print", cls.prints(h1, h2)), ("shard", shard), ("at", at), ("n", n)):
            index.slots[name][slot] = values
        return index

    def slot(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for some that are not in the set."""
        found = np.full(len(h1), -1, np.int64)
        left, base = np.arange(len(h1)), 0
        for level, size in enumerate(self.levels):
            place = (combine(h1[left], h2[left], level) % np.uint64(size)).astype(np.int64) + base
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            here = (self.bits[word] >> bit) & np.uint64(1) == 1
            below = self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            rank = self.before[word] + np.bitwise_count(below)
            found[left[here]] = rank[here]
            left, base = left[~here], base + size
        return found

    def find(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots' contents, and which keys have one whose fingerprint agrees."""
        slot = self.slot(h1, h2)
        if not len(self.slots):
            return np.zeros(len(h1), SLOT), np.zeros(len(h1), bool)
        held = self.slots[np.maximum(slot, 0)]
        return held, (slot >= 0) & (held["print"] == self.prints(h1, h2))

    def to_bytes(self) -> list[bytes]:
        head = json.dumps({"levels": self.levels, "keys": len(self.slots)}).encode()
        return [len(head).to_bytes(4, "little"), head, self.bits.tobytes(), self.slots.tobytes()]

    @classmethod
    def from_bytes(cls, raw: bytes) -> KeyIndex:
        start = 4 + int.from_bytes(raw[:4], "little")
        head = json.loads(raw[4:start])
        words = sum(head["levels"]) // 64
        bits = np.frombuffer(raw, "<u8", words, start)
        return cls(head["levels"], bits, np.frombuffer(raw, SLOT, head["keys"], start + 8 * words))


def _key_hashes(key: str, buckets: int) -> dict[str, Column]:
    h1 = F.xxhash64(F.lit(1), F.col(key), F.col(key).isNull(), F.col("copy"))
    return {
        "h1": h1,
        "h2": F.xxhash64(F.lit(2), F.col("copy"), F.col(key).isNull(), F.col(key)),
        "bucket": F.pmod(h1, F.lit(buckets)).cast("int"),
    }


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


# ---- writing ----------------------------------------------------------------


def _write_shards(folder: str, key: str, tokenizer_file: str, layout: ShardLayout, width: int, schema: pa.Schema):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encode = encoder(tokenizer_file)
        filesystem, path = open_folder(folder)
        filesystem.create_dir(path, recursive=True)
        draft = posixpath.join(path, f"_draft.{uuid.uuid4().hex}")
        at, last, copy = 0, None, 0
        with filesystem.open_output_stream(draft) as out:
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids, lengths = with_end(*encode.texts(batch.column("text")), layout.end_id)
                out.write(ids.astype(f"<u{width}").tobytes())
                copies = []
                for value in batch.column(key).to_pylist():
                    copy = copy + 1 if copies or at else 0
                    copy = copy if value == last else 0
                    last = value
                    copies.append(copy)
                places = at + np.concatenate([[0], np.cumsum(lengths)])
                at = int(places[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key),
                        pa.array(copies, pa.int64()),
                        pa.array(np.full(batch.num_rows, shard, np.int32)),
                        pa.array(places[:-1]),
                        pa.array(lengths),
                    ],
                    schema=schema,
                )
        filesystem.move(draft, posixpath.join(path, f"shard-{shard:05d}.ids"))

    return write


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    key: str = "doc_id",
    text: str = "text",
    layout: ShardLayout = ShardLayout(),
) -> None:
    """Encode whole texts and write them with their index to a new folder.

    Documents are dealt to shards by ranges of the key, null first, and lie in
    ascending order in each. Null texts are empty; an empty document has its end
    id alone. Rows of equal keys lie side by side, in order of their text, and
    are told apart by a copy number from 0. Empty tables give an index of none.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    width = 2 if Tokenizer.from_file(tokenizer_file).get_vocab_size() <= 1 << 16 else 4
    rows = docs.select(F.col(key), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(F.col(key)).sortWithinPartitions(key, "text")
    key_type = docs.schema[key].dataType
    entry_type = T.StructType([T.StructField(key, key_type), *T._parse_datatype_string(ENTRY).fields])
    arrow = pa.schema(
        [
            pa.field(key, _arrow_type(key_type)),
            *[pa.field(*f) for f in (("copy", pa.int64()), ("shard", pa.int32()), ("at", pa.int64()), ("n_tokens", pa.int64()))],
        ]
    )
    entries_path = f"{folder}/entries"
    ordered.mapInArrow(_write_shards(folder, key, tokenizer_file, layout, width, arrow), entry_type).write.parquet(
        entries_path
    )
    entries = spark.read.schema(entry_type).parquet(entries_path)
    # One row per shard file.
    totals = {r[0]: (r[1], r[2]) for r in entries.groupBy("shard").agg(F.sum("n_tokens"), F.count("*")).collect()}
    starts, n = {}, 0
    for shard in sorted(totals):
        starts[shard] = n
        n += totals[shard][0]
    documents = sum(c for _, c in totals.values())
    buckets = max(1, ceil(documents / layout.bucket_keys))
    manifest = {"width": width, "buckets": buckets, "ids": n, "documents": documents, "starts": starts}

    def build(group: pa.Table) -> pa.Table:
        index = KeyIndex.build(
            _unsigned(group["h1"]),
            _unsigned(group["h2"]),
            *[group[c].to_numpy() for c in ("shard", "at", "n_tokens")],
        )
        bucket = group["bucket"][0].as_py()
        publish_file(folder, f"index-{bucket:05d}.mph", index.to_bytes())
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "keys": pa.array([group.num_rows], pa.int64())})

    built = (
        entries.withColumns(_key_hashes(key, buckets))
        .select("bucket", "h1", "h2", "shard", "at", "n_tokens")
        .groupBy("bucket")
        .applyInArrow(build, "bucket int, keys long")
    )
    indexed = built.agg(F.sum("keys")).first()[0] or 0
    if indexed != documents:
        raise RuntimeError(f"{indexed} of {documents} keys are in the index")
    publish_file(folder, "manifest.json", [json.dumps(manifest).encode()])


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


# ---- reading ----------------------------------------------------------------


def find_keys(keys: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Places of keys (columns key and copy) by the index: shard, at, n_tokens.
    Keys that the index does not hold give no row, but for one in 2^32 of them."""
    manifest = json.loads(read_range(folder, "manifest.json"))
    if not manifest["documents"]:
        return keys.select(key, "copy", *[F.lit(0).cast(t).alias(c) for c, t in (("shard", "int"), ("at", "long"), ("n_tokens", "long"))]).where("false")

    def look_up(group: pa.Table) -> pa.Table:
        index = KeyIndex.from_bytes(read_range(folder, f"index-{group['bucket'][0].as_py():05d}.mph"))
        held, found = index.find(_unsigned(group["h1"]), _unsigned(group["h2"]))
        out = group.select([key, "copy"])
        for name, values, kind in (("shard", "shard", np.int32), ("at", "at", np.int64), ("n_tokens", "n", np.int64)):
            out = out.append_column(name, pa.array(held[values].astype(kind)))
        return out.filter(pa.array(found))

    schema = T.StructType([keys.schema[key], *T._parse_datatype_string(ENTRY).fields])
    return (
        keys.select(key, "copy")
        .withColumns(_key_hashes(key, manifest["buckets"]))
        .groupBy("bucket")
        .applyInArrow(look_up, schema)
    )


def read_tokens(
    keys: DataFrame, folder: str, key: str = "doc_id", ids: bool = True, layout: ShardLayout = ShardLayout()
) -> DataFrame:
    """Documents of the given keys (columns key and copy), read from their
    shards by way of the index: key, start (ids of all documents before it),
    n_tokens, ids_crc32 (of the ids as unsigned 32-bit little endian) and, if
    wanted, ids. Keys of the same stretch of a shard are read together."""
    manifest = json.loads(read_range(folder, "manifest.json"))
    width = manifest["width"]
    key_field = keys.schema[key]

    def read(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        at, n = group["at"].to_numpy(), group["n_tokens"].to_numpy()
        low, high = int(at.min()), int((at + n).max())
        raw = read_range(folder, f"shard-{shard:05d}.ids", low * width, (high - low) * width)
        held = np.frombuffer(raw, f"<u{width}").astype("<u4")
        parts = [held[a - low : a - low + k] for a, k in zip(at, n)]
        out = group.select([key])
        out = out.append_column("start", pa.array(at + manifest["starts"][str(shard)]))
        out = out.append_column("n_tokens", pa.array(n))
        out = out.append_column("ids_crc32", pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()))
        if ids:
            out = out.append_column("ids", pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
        return out

    fields = "start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")
    schema = T.StructType([key_field, *T._parse_datatype_string(fields).fields])
    places = find_keys(keys, folder, key).withColumn("stretch", F.floor(F.col("at") / layout.read_ids))
    return places.groupBy("shard", "stretch").applyInArrow(read, schema)


def stored_keys(spark, folder: str) -> DataFrame:
    """Table of the keys that a folder holds, with their places."""
    return spark.read.parquet(f"{folder}/entries")
