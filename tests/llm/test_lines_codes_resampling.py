"""Line dedup, vector codes and importance resampling against brute force, and
what they do with nulls, empty and long texts, ties and empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.llm import line_dedup, queries
from pitchlake.llm.line_dedup import CuckooFilter, IndexLayout, LineIndex, drop_repeated_lines
from pitchlake.llm.resampling import Resampling, feature_counts, resample
from pitchlake.llm.storage import new_folder
from pitchlake.llm.vector_codes import Codes, Tree, assign, coded_rows, component_limit, learn_codes

ID_TEXT = "doc_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    queries.prepare(spark)


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


# ---- lines -------------------------------------------------------------------


def random_docs(seed, n):
    rng = random.Random(seed)
    pool = [f"A line that many documents hold, number {i}" + " é" * (i % 3) for i in range(25)] + ["short", "", " \t", "x" * 19, "é" * 20]

    def line():
        return rng.choice(["", "  ", "\t"]) + rng.choice([str.upper, str])(rng.choice(pool)) + rng.choice(["", " ", "\r"])

    def text():
        return "\n".join(line() if rng.random() < 0.7 else f"its own line {rng.random()} of some length" for _ in range(rng.randrange(9)))

    return [(i, rng.choice([text(), text(), text(), None, "\n\n"])) for i in range(n)]


def key(line):
    return line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(LOWER)


def lines_by_force(index_rows, rows):
    """n_lines, n_dropped and kept text of rows, by the documents of index_rows."""
    holders = {}
    for doc, text in index_rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(doc)
    last = {k: max((d for d in v if d is not None), default=None) for k, v in holders.items() if len(v) >= 3}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return sorted(out, key=repr)


def kept(index, given):
    return sorted(map(tuple, index.keep_lines(given).collect()), key=repr)


LAYOUTS = [IndexLayout(), IndexLayout(keys_per_shard=8, least_shards=2, local_bytes=0, salt=3, layers=2)]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_lines_come_back_when_documents_go(spark, layout):
    rows = random_docs(1, 90) + [(None, "A line that many documents hold, number 3"), (None, "\n".join(["y" * 30] * 3)), (7, "y" * 30 + "\nmore")]
    given = spark.createDataFrame(rows, ID_TEXT).withColumn("row", F.lit("x")).withColumn("a", F.lit(1))
    folder = new_folder(spark, "index-test")
    index = LineIndex(spark, folder, layout=layout)
    assert kept(index, given) == lines_by_force([], rows)  # nothing is there yet
    parts = [rows[:40], rows[40:60], rows[55:]]  # some rows come twice
    for part in parts:
        index.insert(spark.createDataFrame(part, ID_TEXT))
    assert kept(index, given) == lines_by_force(rows, rows)
    gone = {r[0] for r in rows[::2]} | {7, None, 12345}
    index.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))
    left = [r for r in rows if r[0] not in gone]
    index = LineIndex(spark, folder, layout=layout)  # as another session finds it
    assert kept(index, given) == lines_by_force(left, rows)
    back = [r for r in rows if r[0] in (0, 4, 7)]
    index.insert(spark.createDataFrame(back, ID_TEXT))
    assert kept(index, given) == lines_by_force(left + back, rows)
    fresh = LineIndex(spark, new_folder(spark, "index-fresh"), layout=layout)
    fresh.insert(spark.createDataFrame(left + back, ID_TEXT))
    columns = ["a", "b", "refs", "last"]
    assert sorted(map(tuple, index.counts().select(columns).collect())) == sorted(map(tuple, fresh.counts().select(columns).collect()))
    assert (index.state.keys, index.state.repeated) == (fresh.state.keys, fresh.state.repeated)
    index.delete(spark.createDataFrame([(r[0],) for r in rows], "doc_id long"))
    assert index.counts().count() == 0 and index.state.keys == 0
    assert kept(index, given) == lines_by_force([], rows)


def test_broken_operation_leaves_the_index_as_it_was(spark, monkeypatch):
    rows = random_docs(2, 40)
    folder = new_folder(spark, "index-broken")
    index = LineIndex(spark, folder)
    index.insert(spark.createDataFrame(rows[:30], ID_TEXT))

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(LineIndex, "_publish", fail)
    with pytest.raises(OSError):
        index.insert(spark.createDataFrame(rows[30:], ID_TEXT))
    monkeypatch.undo()
    given = spark.createDataFrame(rows, ID_TEXT)
    for found in (index, LineIndex(spark, folder)):
        assert kept(found, given) == lines_by_force(rows[:30], rows)
        found.insert(spark.createDataFrame(rows[30:], ID_TEXT))
        assert kept(found, given) == lines_by_force(rows, rows)


def test_lines_of_no_documents_and_of_one_long_text(spark):
    empty = spark.createDataFrame([], ID_TEXT)
    assert drop_repeated_lines(empty, new_folder(spark, "index-none")).count() == 0
    long = "\n".join(f"line {i % 5000} of a text that is very long" for i in range(60_000))
    rows = [(1, long), (2, long), (3, long), (4, long.replace("\n", " "))]
    got = drop_repeated_lines(spark.createDataFrame(rows, ID_TEXT), new_folder(spark, "index-long"))
    assert sorted(map(tuple, got.collect()), key=repr) == lines_by_force(rows, rows)
    assert line_dedup.LineRule() == line_dedup.LineRule(20, 3)


def test_cuckoo_filter_forgets_what_is_removed():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 3000, 50_000):
        a, b = rng.integers(-(2**63), 2**63, (2, n), dtype=np.int64)
        small = CuckooFilter.sized(n)
        assert small.add(a, b) and small.holds(a, b).all()
        small = CuckooFilter.from_bytes(small.to_bytes())
        half = n // 2
        small.remove(a[:half], b[:half])
        assert small.holds(a[half:], b[half:]).all() and np.count_nonzero(small.table) == n - half
        if n >= 3000:
            assert small.holds(a[:half], b[:half]).mean() < 0.01
        assert small.add(a[:half], b[:half]) and small.holds(a, b).all()
        small.remove(a, b)
        assert not small.table.any()
    full = CuckooFilter.sized(10)
    a, b = rng.integers(0, 2**63, (2, 500), dtype=np.int64)
    assert not full.add(a, b)
    with pytest.raises(ValueError):
        CuckooFilter.sized(10).remove(a[:1], b[:1])


# ---- vector codes ------------------------------------------------------------


def codes_by_force(rows, p=Codes()):
    """(vec_id, code, error) of rows (vec_id, vector), by whole Python numbers."""
    whole = [(i, [math.floor(p.scale * x) for x in v]) for i, v in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))]
    width = len(whole[0][1]) // p.parts
    parts = [[v[j * width : (j + 1) * width] for j in range(p.parts)] for _, v in whole]
    books = [[parts[e][j] for e in range(min(p.entries, len(parts)))] for j in range(p.parts)]

    def nearest(x, book):
        gaps = [sum((a - b) ** 2 for a, b in zip(x, entry)) for entry in book]
        return min(gaps), gaps.index(min(gaps))

    for _ in range(p.rounds):
        for j, book in enumerate(books):
            own = [[] for _ in book]
            for v in parts:
                own[nearest(v[j], book)[1]].append(v[j])
            books[j] = [[sum(c) // len(m) for c in zip(*m)] if m else book[e] for e, m in enumerate(own)]
    out = []
    for (i, _), v in zip(whole, parts):
        found = [nearest(v[j], books[j]) for j in range(p.parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(g for g, _ in found)))
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted(out, key=repr), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("kind, n, d", [("float", 300, 16), ("double", 90, 8), ("double", 5, 24)])
def test_codes_equal_brute_force(spark, kind, n, d):
    rng = random.Random(n)
    rows = [(i, [float(np.float32(rng.choice([-1.5, 0, 2]) + rng.gauss(0, 0.1 * (1 + i % 3)))) for _ in range(d)]) for i in range(n)]
    rows += rows[3:5] + [(n + 1, [0.0] * d), (n + 2, [-0.0] * d), (None, [7000.0] * d)]  # repeated rows, ties, far ones
    p = Codes(block_rows=64, leaf=4)
    bad = [(n + 3, None), (n + 4, []), (n + 5, [None] * d), (n + 6, [math.nan] * d), (0, [math.inf] + [1.0] * (d - 1)), (n + 7, [1.0] * (d + 8))]
    given = spark.createDataFrame([(i, v, None if i is None else i % 3) for i, v in rows + bad], f"vec_id long, embedding array<{kind}>, label int")
    given = given.withColumn("error", F.lit("x")).withColumn("block", F.lit("y")).repartition(3)
    codes = learn_codes(given, p=p)
    want, digest = codes_by_force(rows)
    got = coded_rows(spark, codes, p).collect()
    assert sorted(((r["vec_id"], r["code"], r["error"]) for r in got), key=repr) == want
    assert {r["codebooks_sha256"] for r in got} == {digest}
    sums = {}
    for i, _, e in want:
        sums[None if i is None else i % 3] = sums.get(None if i is None else i % 3, 0) + e
    assert all(r["label_error"] == sums[None if r["vec_id"] is None else r["vec_id"] % 3] for r in got)
    salted = coded_rows(spark, codes, Codes(broadcast_labels=0, label_salt=3)).collect()
    assert sorted(map(tuple, salted), key=repr) == sorted(map(tuple, got), key=repr)


def test_codes_of_nothing_and_of_odd_lengths(spark):
    shape = "vec_id long, embedding array<double>, label int"
    for rows in ([], [(1, None, 1)], [(1, [1.0] * 7, 1), (2, [1.0] * 8, 1)]):
        codes = learn_codes(spark.createDataFrame(rows, shape))
        assert codes.books == [] and coded_rows(spark, codes).count() == 0
    huge = learn_codes(spark.createDataFrame([(1, [1e300] * 8, 1), (2, [-1e300] * 8, 2)], shape))
    assert sorted(r["error"] for r in huge.rows.collect()) == [0, 0] and huge.books[0].max() == component_limit(8)


def test_dual_tree_assigns_like_comparing_all():
    rng = np.random.default_rng(1)
    for n, k, d, spread in [(1, 1, 1, 3), (5, 3, 2, 4), (300, 16, 8, 20), (1000, 7, 3, 5), (50, 16, 4, 2), (900, 256, 2, 40)]:
        points, book = rng.integers(-spread, spread, (n, d)), rng.integers(-spread, spread, (k, d))
        tree = Tree.build(points, 8)
        found, want = assign(tree, book), ((points[:, None] - book[None]) ** 2).sum(2).argmin(1)
        assert (found.entry == want[tree.order]).all() and (found.count == np.bincount(want, minlength=k)).all()
        total = np.zeros((k, d), np.int64)
        np.add.at(total, want, points)
        assert (found.total == total).all()
    clumps = np.repeat(rng.integers(-900, 900, (12, 4)), 100, 0) + rng.integers(-5, 5, (1200, 4))
    assert assign(Tree.build(clumps, 8), clumps[::100].copy()).whole > 900  # most points go by cached sums


# ---- importance resampling ---------------------------------------------------

FEATURE_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    words = FEATURE_WORD.findall((text or "").translate(LOWER))
    return words, [zlib.crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def resampled_by_force(docs, target):
    raw, wanted = np.zeros(10_000), np.zeros(10_000)
    for into, texts in ((raw, [t for _, t in docs]), (wanted, target)):
        for text in texts:
            np.add.at(into, features(text)[1], 1)
    s, t = raw.sum(), wanted.sum()
    gain = [math.floor(1000 * math.log((t_ + 1) * (s + 10_000) / ((s_ + 1) * (t + 10_000)))) for s_, t_ in zip(raw, wanted)]
    out, able = {}, []
    for i, text in docs:
        words, found = features(text)
        weight = sum(gain[f] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = (len(found), weight, score)
        if len(words) >= 20:
            able.append((-score, i is None, i))
    rank = {x[2]: n + 1 for n, x in enumerate(sorted(able)[: 25 * len(able) // 100])}
    return {i: (*v, rank.get(i)) for i, v in out.items()}


def odd_texts():
    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in ("Word", "é", "x1", "ünder", "日本") for b in range(40)] + ["w" * 47, "w" * 48, "w" * 49, "y" * 5000]
    texts = [None, "", "\n\n", " . ", "one", "one\n\n--\ntwo", "a b\nc", "A\x00b`c{d", "é　ß x", "\n".join(["same line here"] * 50)]
    for _ in range(300):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        texts.append("".join(w + rng.choice([" ", " ", "\n", "\n\n", ", ", "\n - \n"]) for w in words))
    texts += [texts[20], texts[21] + "\n" + texts[20], "boilerplate of every page\n" + texts[30], "boilerplate of every page\n" + texts[31]]
    return [*enumerate(texts), (None, texts[40])]


@pytest.mark.parametrize("window", [50, 8 << 20])
def test_resampling_equals_brute_force(spark, window):
    rows, target = odd_texts(), [None, "", "Word3 Word4 x11", "é0 é1\né2 " * 30]
    given = spark.createDataFrame(rows, ID_TEXT).withColumn("score", F.lit("x")).withColumn("bucket", F.lit(1)).repartition(3)
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in resample(given, wanted, p=Resampling(window_bytes=window)).collect()}
    assert got == resampled_by_force(rows, target)


def test_resampling_of_nothing_and_of_one_hot_line(spark):
    empty = spark.createDataFrame([], ID_TEXT)
    given = spark.createDataFrame([(i, "the same words in all the lines\n" * 40) for i in range(60)], ID_TEXT)
    assert resample(empty, given).count() == 0 and resample(empty, empty).count() == 0
    rows = [(i, "the same words in all the lines\n" * 40) for i in range(60)]
    assert {r["doc_id"]: tuple(r)[1:] for r in resample(given, empty).collect()} == resampled_by_force(rows, [])
    counted = {r["bucket"]: r["n"] for r in feature_counts(given).collect()}
    assert counted[zlib.crc32(b"lines the") % 10_000] == 60 * 39 and counted[zlib.crc32(b"same words") % 10_000] == 60 * 40


def test_resampling_orders_equal_scores_by_id(spark):
    text = "word " * 30
    given = spark.createDataFrame([(9, text)] * 20 + [(8, text)] * 20, ID_TEXT)
    got = resample(given, given).where("rank is not null").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 11)) and len({r["doc_id"] for r in got}) == 1
