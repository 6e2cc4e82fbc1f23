"""The ten operators against SQL, brute force, round trips and held-out labels,
and what they do with nulls, empty and long texts, ties and empty tables."""

from __future__ import annotations

import hashlib
import io
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import differences, oracle_connection
from pitchlake.llm import oracle, queries
from pitchlake.llm.decontaminate import EditSearch, find_items
from pitchlake.llm.embedding_pairs import Tiles, link_vectors, possible_pairs, quantise
from pitchlake.llm.license_scan import TEMPLATES, Scan, scan_licenses
from pitchlake.llm.mixing import mix_sources
from pitchlake.llm.near_duplicates import ChosenPaths, near_duplicates
from pitchlake.llm.quality import Learning, learn_quality, score_quality
from pitchlake.llm.storage import new_folder
from pitchlake.llm.substrings import Passages, drop_repeats
from pitchlake.llm.token_shards import KeyIndex, ShardLayout, find_keys, read_tokens, stored_keys, write_tokens
from pitchlake.llm.url_filter import FilterSize, rules_table, url_filter
from pitchlake.llm.warc import Archive, DamagedArchive, read_archive, records_in, write_archive

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, kept string"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    queries.prepare(spark)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, one-word, repeated and very long texts, clashing columns."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    texts = [None, "", " \n\t", "one", "one", "Released under the MIT License.", long, long, "a b " * 40, "Ünï cödé \u3000 x"]
    rows = [(i, t, None, [None, "b", "a"][i % 3], None, "x", None, "y") for i, t in enumerate(texts)]
    rows += [(None, "no id at all", "en", "a", 1, None, None, None), rows[5], rows[5]]
    return spark.createDataFrame(rows, DOC)


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_equals_sql(spark, name):
    connection = oracle_connection(SF_DIR)
    assert differences(queries.queries()[name](spark, SF_DIR), connection, oracle.statements()[name]) == []


# ---- licenses ---------------------------------------------------------------


def test_licenses_in_odd_rows(odd):
    found = scan_licenses(odd)
    assert rows_of(found, "doc_id", "license", "containment", "windows") == [(5, "MIT-notice", 1.0, 3)]


def test_license_with_changed_words_is_found(spark):
    words = TEMPLATES["MIT"].split()
    changed = " ".join(["zzz"] * 37 + words[:-4] + ["other", "words", "end", "here"])
    far = " ".join(w if i % 4 else "zzz" for i, w in enumerate(words))
    given = spark.createDataFrame([(1, changed), (2, far), (3, " ".join(words).upper())], "doc_id long, text string")
    assert {r[0] for r in scan_licenses(given).where("license = 'MIT'").collect()} == {1, 3}
    assert Scan().bands() * Scan().rows < 200


# ---- tokens -----------------------------------------------------------------


def test_tokens_round_trip(spark, docs, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    given = docs.select("doc_id", "text").unionAll(odd.select(F.col("doc_id") + 100_000, "text"))
    folder = new_folder(spark, "tokens-test")
    write_tokens(given, folder, queries.tokenizer_file(), layout=ShardLayout(bucket_keys=64))
    got = sorted(map(tuple, read_tokens(stored_keys(spark, folder), folder).collect()), key=lambda r: r[1])
    want = sorted(map(tuple, given.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for (doc_id, at, n, crc, ids), (want_id, text) in zip(got, want, strict=True):
        expected = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert (doc_id, at, n, ids) == (want_id, start, len(expected), expected)
        assert crc == zlib.crc32(np.array(expected, "<u4").tobytes())
        start += n
    strangers = spark.range(10**9, 10**9 + 500).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("copy"))
    assert find_keys(strangers, folder).count() == 0


def test_key_index_is_minimal_and_perfect():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000, 20_000):
        h = rng.integers(0, 2**63, (2, n), dtype=np.uint64)
        index = KeyIndex.build(h[0], h[1], np.arange(n), np.arange(n), np.ones(n))
        index = KeyIndex.from_bytes(b"".join(index.to_bytes()))
        assert sorted(index.slot(h[0], h[1])) == list(range(n))
        held, found = index.find(h[0], h[1])
        assert found.all() and (held["at"] == np.arange(n)).all()


def test_no_documents_give_no_tokens(spark, docs):
    assert queries.token_rows(docs.limit(0)).count() == 0


# ---- web archives -----------------------------------------------------------


@pytest.mark.parametrize("split", [701, 1 << 20])
def test_archive_is_split_anywhere(spark, split):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").limit(60).select("page_id", "url", "html")
    extra = [(900, None, None), (901, "http://a\r\nb", ""), (902, "u", "x" * 99), (903, "u", "x" * 99), (905, "u", "é" * 60), (904, "u", "é" * 60), (None, "u", "é" * 60)]
    pages = pages.unionAll(spark.createDataFrame(extra, pages.schema))
    folder = new_folder(spark, "warc-test")
    archive = Archive(split_bytes=split)
    got = {r["page_id"]: r for r in read_archive(write_archive(pages, folder, archive), folder, True, archive).collect()}
    given = {r["page_id"]: r for r in pages.collect()}
    assert got.keys() == given.keys()
    for key, row in got.items():
        payload = (given[key]["html"] or "").encode()
        assert (row["payload_bytes"], row["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        if row["record_type"] == "response":
            assert bytes(row["payload"]) == payload
    assert [got[k]["refers_to"] for k in (902, 903, 904, 905, None)] == [None, None, None, 904, 904]
    assert write_archive(pages.limit(0), new_folder(spark, "warc-none")).count() == 0


def ranges_of(content: bytes, size: int, step: int):
    """Records of all ranges of a file, as tasks read them."""
    return [r for at in range(0, size, step) for r in records_in(io.BytesIO(content), size, at, at + step)]


def archive_of(spark, n=40):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html").orderBy("page_id").limit(n).coalesce(1)
    folder = new_folder(spark, "warc-damaged")
    files = write_archive(pages, folder)
    (row,) = files.collect()
    return files, folder, Path(folder.removeprefix("file:")) / row["file"], row["bytes"]


def test_no_changed_or_lost_byte_goes_unnoticed(spark):
    _, _, path, size = archive_of(spark)
    whole = path.read_bytes()
    want = ranges_of(whole, size, size)
    assert len(want) == 40 and len(whole) == size
    random.seed(3)
    for step in (997, 20_000, size):
        assert ranges_of(whole, size, step) == want
        for at in [0, 1, 2, 3, 9, size - 1, size - 8, *random.sample(range(size), 60)]:
            changed = bytearray(whole)
            changed[at] ^= random.randrange(1, 256)
            try:  # a few bytes of a gzip header say nothing: the records are as they were
                assert ranges_of(bytes(changed), size, step) == want
            except DamagedArchive:
                pass
        for at in random.sample(range(1, size), 20):
            with pytest.raises(DamagedArchive):
                ranges_of(whole[:at], size, step)
            with pytest.raises(DamagedArchive):  # zeros in place of the rest, as a broken disk gives them
                ranges_of(whole[:at] + bytes(size - at), size, step)


@pytest.mark.parametrize("harm", ["changed", "cut", "longer", "missing"])
def test_damaged_archive_fails_the_read(spark, harm):
    files, folder, path, size = archive_of(spark)
    archive = Archive(split_bytes=5000)
    assert read_archive(files, folder, False, archive).count() == 40
    whole = bytearray(path.read_bytes())
    path.unlink()
    checksum = path.with_name(f".{path.name}.crc")
    if checksum.exists():
        checksum.unlink()
    whole[size // 2] ^= 255
    if harm != "missing":
        path.write_bytes({"changed": whole, "cut": whole[:-30], "longer": whole + b"x"}[harm])
    with pytest.raises(Exception, match="FileNotFound" if harm == "missing" else "DamagedArchive"):
        read_archive(files, folder, False, archive).collect()


# ---- decontamination --------------------------------------------------------


def least_distance(item, text):
    last = [0] * (len(text) + 1)
    for i, word in enumerate(item):
        now = [i + 1]
        for j, other in enumerate(text):
            now.append(min(last[j] + (word != other), last[j + 1] + 1, now[j] + 1))
        last = now
    return min(last)


def test_edited_items_are_found_like_by_brute_force(spark):
    random.seed(4)
    vocabulary = [f"w{int(random.expovariate(0.02))}" for _ in range(4000)]
    items = [[random.choice(vocabulary) for _ in range(n)] for n in (5, 9, 12, 20, 20, 35, 60) for _ in range(3)]
    texts = []
    for _ in range(120):
        words = [random.choice(vocabulary) for _ in range(random.randrange(5, 150))]
        item = list(random.choice(items))
        for _ in range(random.randrange(0, len(item) // 4 + 1)):
            at = random.randrange(len(item))
            item[at : at + random.randrange(2)] = random.choice([[], [random.choice(vocabulary)]])
        at = random.randrange(len(words))
        texts.append(words[:at] + item + words[at:])
    want = {
        (d, i, least)
        for d, t in enumerate(texts)
        for i, item in enumerate(items)
        if (least := least_distance(item, t)) <= EditSearch().edits(len(item))
    }
    given = spark.createDataFrame([(d, ", ".join(t).title()) for d, t in enumerate(texts)], "doc_id long, text string")
    listed = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = set(map(tuple, find_items(given, listed).select("doc_id", "item_id", "distance").collect()))
    assert got == want
    some = find_items(given, listed, search=EditSearch(item_bytes=2000)).select("doc_id", "item_id", "distance")
    assert set(map(tuple, some.collect())) == want


def copies_at_full_distance(item, edits, strange):
    """Copies of an item with so many edits, of every kind that moves its words."""
    n = len(item)
    yield item[edits:]
    yield item[: n - edits]
    yield strange[:edits] + item[edits:]
    yield item[edits // 2 : n - (edits - edits // 2)]
    yield item[: n // 3] + item[n // 3 + edits :]
    gone = set(random.sample(range(n), edits))
    yield [w for i, w in enumerate(item) if i not in gone]
    yield [strange[i] if i in gone else w for i, w in enumerate(item)]
    yield [x for i, w in enumerate(item) for x in ([strange[i], w] if i in gone else [w])]


def test_cut_items_are_found_like_by_brute_force(spark):
    random.seed(44)
    lengths = (15, 16, 19, 20, 25, 30, 40, 50, 59, 60, 90, 120, 200)
    items = [[f"i{n}w{random.randrange(9 * n)}" for _ in range(n)] for n in lengths]
    texts = []
    for item in items:
        strange = [f"s{i}" for i in range(len(item))]
        for copy in copies_at_full_distance(item, EditSearch().edits(len(item)), strange):
            # In the middle of a text, at its start, its end, and alone.
            before, after = ([f"{c}{i}" for i in range(2 * len(item))] for c in "ba")
            texts += [before + copy + after, copy + after, before + copy, copy]
    per_item = len(texts) // len(items)
    want = {(d, d // per_item, least_distance(items[d // per_item], t)) for d, t in enumerate(texts)}
    assert all(least <= EditSearch().edits(lengths[i]) for _, i, least in want)
    given = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")
    listed = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    assert set(map(tuple, find_items(given, listed).select("doc_id", "item_id", "distance").collect())) == want


def test_decontamination_of_odd_rows(spark, odd):
    listed = spark.createDataFrame(
        [(1, None), (2, ""), (3, "released under the mit license"), (3, "released under the mit license"), (None, "no id at all you see")],
        "item_id long, text string",
    )
    assert rows_of(find_items(odd, listed), "doc_id", "item_id", "distance", "last_word") == [(5, 3, 0, 5)]
    assert find_items(odd, listed.limit(0)).count() == 0
    assert find_items(odd.limit(0), listed).count() == 0


def test_short_items_and_scripts_without_spaces(spark):
    chinese = "春眠不觉晓处处闻啼鸟夜来风雨声花落知多少"
    items = [(1, "Alpha"), (2, "beta gamma"), (2, "delta beta gamma, zeta"), (3, "..."), (4, chinese), (5, "ไทย"), (6, "カナ文字"), (7, "Beta gamma!")]
    texts = ["an alphabet", "x ALPHA y alpha", "beta. Gamma", "gamma beta", "beta", "gamma", "delta beta gamma zeta",
             f"前言{chinese}后记", f"x{chinese[3:]}y", chinese[:9], "สวัสดีไทยแลนด์", "半角カナ文字だ", "", None]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    listed = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(find_items(given, listed), "*") == sorted(
        [(1, 1, 0, 2), (2, 2, 0, 2), (2, 7, 0, 2), (6, 2, 0, 3), (6, 7, 0, 3), (7, 4, 0, 22), (8, 4, 3, 18), (10, 5, 0, 9), (11, 6, 0, 6)], key=repr
    )


# ---- substrings -------------------------------------------------------------


def kept_by_force(rows, window=20):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        out[doc_id] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return out


@pytest.mark.parametrize("block_bytes", [3000, 1 << 20])
def test_repeats_go_like_by_brute_force(spark, docs, block_bytes):
    random.seed(5)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    words = [f"w{i}" for i in range(400)]
    for k in range(40):
        a = random.randrange(350)
        body = words[a : a + random.randrange(15, 50)] + ["x"] * random.randrange(60) + ["y", "x"] * random.randrange(30)
        rows.append((10_000 + k, "\t".join(body + words[a : a + 22])))
    given = spark.createDataFrame(random.sample(rows, len(rows)), "doc_id long, text string").repartition(5)
    got = drop_repeats(given, p=Passages(block_bytes=block_bytes, bucket_words=9000))
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in got.collect()}
    assert found == kept_by_force(rows)


def test_repeats_in_odd_rows(odd):
    rows = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    want = {k: v[:2] for k, v in kept_by_force([(r["doc_id"], r["text"]) for r in rows.collect()]).items()}
    assert {r[0]: (r[1], r[2]) for r in drop_repeats(rows, texts=False).select("doc_id", "n_words", "n_removed").collect()} == want
    assert drop_repeats(odd).count() == odd.count()
    assert drop_repeats(odd.limit(0)).count() == 0


# ---- vectors ----------------------------------------------------------------


def test_vectors_link_like_by_brute_force(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(30, 16))
    vectors = (base[rng.integers(0, 30, 500)] + rng.normal(size=(500, 16)) * rng.choice([0, 0.15, 0.6], (500, 1))).astype(np.float32)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(600, None), (601, []), (602, [0.0] * 16), (603, [float("nan")] * 16), (604, [None] * 16), (605, [1.0, 2.0]), (606, [2.0, 4.0])]
    got = {r[0]: tuple(r)[1:] for r in link_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>"), tiles=Tiles(vectors=64, rows=16)).collect()}
    v = vectors.astype(float)
    links = (v @ v.T / np.outer(np.linalg.norm(v, axis=1), np.linalg.norm(v, axis=1)) >= 0.9) & ~np.eye(500, dtype=bool)
    label = np.arange(500)
    for _ in range(500):
        label = np.minimum(label, np.where(links, label[None, :], 10**6).min(axis=1))
    for i in range(500):
        assert got[i] == (links[i].sum(), label[i], label[i] == i)
    assert [got[i][0] for i in range(600, 607)] == [0, 0, 0, 0, 0, 1, 1]
    assert got[606][1] == 605


def test_doubles_are_compared_as_doubles(spark):
    """Cosines next to the threshold, which single precision cannot tell from it,
    and lengths whose squares no double holds."""
    rows, want = [], {}
    for i in range(40):
        cosine = 0.9 + (1e-10 if i % 2 else -1e-10)
        size = (1.0, 1e-200, 1e200, 3.0)[i % 4]
        a, b = [0.0] * 80, [0.0] * 80
        a[2 * i], b[2 * i], b[2 * i + 1] = size, cosine, (1 - cosine * cosine) ** 0.5
        rows += [(2 * i, a), (2 * i + 1, b)]
        want |= {2 * i: i % 2, 2 * i + 1: i % 2}
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {r["vec_id"]: r["n_links"] for r in link_vectors(given, tiles=Tiles(vectors=16, rows=8)).collect()} == want


@pytest.mark.parametrize("threshold", [-0.5, 0.0, 0.3, 0.9, 0.999])
def test_no_pair_above_the_threshold_is_ruled_out(threshold):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 24)) * rng.choice([1.0, 0.05], (300, 24))
    y = np.concatenate([rng.normal(size=(200, 24)), x[:100] + rng.normal(size=(100, 24)) * rng.choice([1e-6, 0.02, 0.3], (100, 1))])
    cosine = x @ y.T / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    possible = possible_pairs(quantise(x), quantise(y), threshold)
    assert possible[cosine >= threshold].all()
    assert not possible[cosine < threshold - 0.1].any()


# ---- near duplicates --------------------------------------------------------


def groups_by_force(rows, shingle=2):
    sets = {}
    for doc_id, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1)} or {tuple(words)} - {()}
    label = {d: d for d in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return {d: (len(sets[d]), label[d], label[d] == d) for d in sets}


@pytest.mark.parametrize("p", [ChosenPaths(), ChosenPaths(small=3, tile_docs=4, broadcast_bytes=0)])
def test_near_duplicates_like_by_brute_force(spark, p):
    random.seed(7)
    rows = []
    for k in range(140):
        if k % 7 == 0 or not rows:
            words = [f"w{random.randrange(3000)}" for _ in range(random.randrange(1, 120))]
        else:
            words = list(base)
            for _ in range(random.randrange(0, max(1, len(words) // 8))):
                words[random.randrange(len(words))] = f"w{random.randrange(3000)}"
        if k % 7 == 0:
            base = words
        rows.append((k, "  ".join(words).title()))
    rows += [(500, None), (501, ""), (502, "One"), (503, "oNE"), (504, "ONE one")]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in near_duplicates(given, p=p).collect()}
    assert got == groups_by_force(rows)


def test_near_duplicates_of_odd_rows(odd):
    got = near_duplicates(odd)
    found = {r["doc_id"]: r["component_id"] for r in got.collect()}
    assert (found[4], found[7], found[None], got.count()) == (3, 6, None, odd.count())
    assert near_duplicates(odd.limit(0)).count() == 0


# ---- mixing -----------------------------------------------------------------


def filled(sizes, share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), {}, set(names)
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        full = {s for s in open_ if level * weight[s] >= most * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_mix_meets_its_targets(request, table):
    given = request.getfixturevalue(table)
    rows = mix_sources(given).collect()
    assert rows_of(mix_sources(given.repartition(3)), "*") == sorted(map(tuple, rows), key=repr)
    sizes, taken, largest = {}, {}, {}
    for r in given.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
    target = filled(sizes)
    for r in rows:
        s = r["source"]
        assert r["target"] == pytest.approx(target[s]) and r["source_size"] == sizes[s]
        assert r["taken"] <= 2 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        taken[s] = taken.get(s, 0) + r["taken"]
        largest[s] = max(largest.get(s, 0), r["size"])
    assert len(rows) == given.count()
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6
    assert mix_sources(given.limit(0)).count() == 0


def test_many_equal_rows_are_one_unit(spark):
    given = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    more = spark.createDataFrame([(2, "x " * 15000, "t")], given.schema)
    taken = mix_sources(given.unionAll(more)).where("source = 's'").agg(F.sum("taken"), F.max("target")).first()
    assert abs(taken[0] - taken[1]) <= 3


# ---- quality ----------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = queries.op9_quality(spark, sf).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in found]) >= 0.95


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (5, None), (6, 1), (8, 0), (3, 7)], "doc_id long, quality int")
    for given in (labels, labels.limit(0)):
        model = learn_quality(odd, given)
        rows = score_quality(odd, model, ["doc_id", "size"]).collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert score_quality(odd.limit(0), model, ["doc_id"]).count() == 0


def test_quality_learns_each_id_once(spark, odd):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    once, often = learn_quality(odd, labels), learn_quality(odd.unionAll(odd).unionAll(odd), labels)
    assert all(np.array_equal(once.weights[k], often.weights[k]) for k in once.weights)


def test_quality_learns_from_all_passages_of_given_documents(spark):
    plain = ["word"] * 6400
    strange = plain[:32] + ["$#% 12"] * 16 + plain[64:]
    texts = [" ".join(strange if i % 2 else plain) for i in range(40)]
    given = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, quality int")
    model = learn_quality(given, labels)
    scores = {r["doc_id"]: r["score"] for r in score_quality(given, model, ["doc_id"]).collect()}
    assert min(v for i, v in scores.items() if i % 2 == 0) > max(v for i, v in scores.items() if i % 2) + 0.5
    summed = learn_quality(given, labels, learning=Learning(local_bytes=0))
    assert all(np.allclose(model.weights[k], summed.weights[k], rtol=1e-3, atol=1e-4) for k in model.weights)
    # Labels without a document take no place of the rows.
    absent = spark.range(1000, 9000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    few = learn_quality(given, labels.unionAll(absent), learning=Learning(most_rows=40))
    assert all(np.array_equal(model.weights[k], few.weights[k]) for k in model.weights)


# ---- urls -------------------------------------------------------------------


@pytest.mark.parametrize("size", [FilterSize(), FilterSize(bits_per_key=1, broadcast_bytes=0)])
def test_urls_by_rules(spark, size):
    urls = [None, "", "no scheme/x", "http://NET/", "http://net", "http://a.net/q?x#y", "s://example.net/en/1", "s://www.Example.net/EN/1",
            "s://b.example.com/de/", "s://notexample.com/de/", "s://x.org/fr/?://net/", "s://org?/fr/", "s://a.net/" * 2]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(None, "s://a.net/")], "page_id long, url string").withColumn("host", F.lit(1))
    rules = rules_table(spark, queries.URL_RULES + [(None, "/", "block"), ("net", "/", "allow")])
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter(pages, rules, size=size).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("net", "/", "net/", "block") and got[4] == ("net", "", None, "allow")
    assert got[5] == ("a.net", "/q", "net/", "block")
    assert [got[k][2:] for k in (6, 7)] == [("example.net/en/", "allow"), ("net/", "block")]
    assert [got[k][2] for k in (8, 9, 10, 11)] == ["example.com/de/", None, "org/fr/", None]
    assert got[12][1] == "/s://a.net/" and got[None][2] == "net/"
    assert url_filter(pages, rules.limit(0)).where("rule is not null").count() == 0


# ---- pipeline ---------------------------------------------------------------


def dropped_by_force(df):
    """Rows whose id is not the least of its group by runs of five words."""
    rows = df.where("doc_id is not null").select("doc_id", "text").collect()
    kept = groups_by_force(dict(rows).items(), shingle=5)
    return sum(not kept[r["doc_id"]][2] for r in rows)


def test_pipeline_stage_by_stage(spark, docs):
    given = docs.withColumn("score", F.lit("x")).withColumn("kept", F.lit(1))
    for name in ("_gone", "_id", "_size", "_more", "_words", "_row", "c0"):
        given = given.withColumn(name, F.concat(F.lit(f"{name} of "), F.col("doc_id").cast("string")))
    given = given.unionByName(given.where("doc_id = 3")).unionByName(given.where("doc_id = 4").withColumn("doc_id", F.lit(None).cast("long")))
    before = given
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR).cache()
        assert after.columns == given.columns
        if name != "mixing":
            assert after.exceptAll(before).count() == 0 and after.count() > 0.5 * before.count()
        if name == "near-duplicates":
            texts = [(r["doc_id"], r["text"]) for r in after.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()]
            assert all(kept for _, _, kept in groups_by_force(texts, shingle=5).values())
            assert after.count() == before.count() - dropped_by_force(before)
        if name == "decontamination":
            assert find_items(after, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).count() == 0
        if name == "mixing":
            words = lambda df: df.agg(F.sum(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")))).first()[0]
            assert words(after) == pytest.approx(1.5 * words(before), rel=0.1)
            assert after.select("doc_id").exceptAll(before.select("doc_id").unionAll(before.select("doc_id"))).count() == 0
        odd_names = [F.col(c) == F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in ("_gone", "_words", "_more", "c0")]
        assert after.where("doc_id is not null").where(~(odd_names[0] & odd_names[1] & odd_names[2] & odd_names[3])).count() == 0
        before = after
    tokens = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR)
    assert tokens.count() == before.count()


@pytest.mark.parametrize("ranked", [3, 4096])
def test_mix_takes_each_unit_as_often_as_drawn(spark, monkeypatch, ranked):
    monkeypatch.setattr(corpus_pipeline, "RANKED_ROWS", ranked)
    rows = [(1, "a b c", "s", i) for i in range(700)] + [(1, f"a b x{i % 50}", "s", i) for i in range(900)]
    rows += [(None, f"n{i} n", None, i) for i in range(300)] + [(i, f"x{i} y z", "t", i) for i in range(10, 500)] + [(5, "", "s", 0), (5, None, "t", 0)]
    given = spark.createDataFrame(rows, "doc_id long, text string, source string, place long").repartition(4)
    got = corpus_pipeline.mix_to_weights(spark, given, SF_DIR)
    assert got.columns == given.columns and "collect_list" not in got._jdf.queryExecution().toString()
    per_row, per_unit = {}, {}
    for r in got.collect():
        unit = (r["doc_id"], r["source"], len(WORD.findall(r["text"])))
        per_row[tuple(r)] = per_row.get(tuple(r), 0) + 1
        per_unit[unit] = per_unit.get(unit, 0) + 1
    want = {}
    for r in mix_sources(given).where("taken > 0").collect():
        unit = (r["doc_id"], r["source"], r["size"])
        want[unit] = want.get(unit, 0) + r["taken"] // r["size"]
    assert per_unit == want and set(per_row) <= set(rows)
    for unit, n in want.items():
        own = [per_row.get(r, 0) for r in rows if (r[0], r[2], len(WORD.findall(r[1] or ""))) == unit]
        assert sum(own) == n and max(own) - min(own) <= 1


def test_pipeline_of_no_documents(spark, docs):
    before = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        before = stage(spark, before, SF_DIR)
    assert before.count() == 0
