"""Word hashes, and what worker processes keep."""

from __future__ import annotations

import gc
import os

import numpy as np
import psutil
import pyarrow as pa
import pytest

from pitchlake.llm import queries, words
from pitchlake.llm.decontaminate import find_items
from pitchlake.llm.near_duplicates import near_duplicates
from pitchlake.llm.substrings import drop_repeats
from pitchlake.llm.token_shards import encoder


def complements(n):
    """A word of n bytes (n a power of two) and the one with both letters changed
    over: polynomial hashes modulo a power of two cannot tell them apart."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def hashed_by_force(word: bytes) -> int:
    def mixed(x, seed=0):
        return int(words.mix(np.array([x % 2**64], np.uint64), seed)[0])

    return mixed(sum(mixed(place << 8 | byte, words._SEED) for place, byte in enumerate(word)) + len(word))


@pytest.mark.parametrize("at_once", [7, 1 << 18])
def test_hashes_do_not_depend_on_pieces(monkeypatch, at_once):
    monkeypatch.setattr(words, "_HASHED_BYTES", at_once)
    texts = ["a b  ccc " + "x" * 70 + " é", "", None, "z" * 300 + " end", "   ", "ba ab"]
    want = [hashed_by_force(w) for t in texts for w in (t or "").encode().split()]
    assert words.words_of(pa.array(texts)).hashes().tolist() == want and len(set(want)) == len(want)


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_words_that_powers_cannot_tell_apart(spark, n):
    queries.prepare(spark)
    one, other = complements(n)
    assert len(set(words.words_of(pa.array([f"{one} {other}"])).hashes().tolist())) == 2
    same = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{same} {one}"), (2, f"{same} {other}"), (3, one), (4, other)]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["n_removed"] for r in drop_repeats(given).collect()} == {0}
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(given.where("doc_id > 2")).collect()} == {3: 3, 4: 4}
    items = spark.createDataFrame([(9, other)], "item_id long, text string")
    assert {r["doc_id"] for r in find_items(given.where("doc_id > 2"), items).collect()} == {4}


def test_workers_do_not_grow_with_the_slices_they_hash():
    text = pa.array([" ".join(f"w{i % 5003}x{i % 7}" for i in range(600_000))])
    process, size = psutil.Process(os.getpid()), {}
    for k in range(50):
        words.words_of(text).hashes(words.LOWER)
        if k in (4, 49):
            gc.collect()
            size[k] = process.memory_info().rss
    assert size[49] - size[4] < 20 << 20


def test_kept_words_are_bounded(monkeypatch):
    encode = encoder.__wrapped__(queries.tokenizer_file())
    monkeypatch.setattr(type(encode), "KEPT_BYTES", 50_000)
    for k in range(30):
        texts = pa.array([" ".join(f"word{k}x{i}" for i in range(200))] * 2)
        ids, lengths = encode.texts(texts)
        want = encode.tokenizer.encode(texts[0].as_py(), add_special_tokens=False).ids
        assert ids[: lengths[0]].tolist() == want and len(ids) == 2 * len(want)
        assert encode.kept_bytes <= 50_000 and len(encode.kept) * encode.WORD_BYTES <= 50_000
