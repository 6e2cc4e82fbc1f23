"""URL filter: rules by host and path, found by a blocked Bloom filter and an
exact hash join behind it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

#: Words of one block: 8 x 64 bits, a cache line. A key sets one bit in each.
BLOCK_WORDS = 8


@dataclass(frozen=True)
class FilterSize:
    """bits_per_key: space of the filter; about 12 bits a key let 1 % of other
    keys pass. broadcast_bytes: largest filter or rule table that is sent to all
    tasks; beyond it they are joined by a shuffle."""

    bits_per_key: int = 16
    broadcast_bytes: int = 64 << 20


def with_host_and_path(urls: DataFrame, url: str = "url") -> DataFrame:
    """Host in lower case (A-Z) and path as written; both empty for a null url
    or one without `://`."""
    text = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(text.contains("://"), F.regexp_extract(text, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    before = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(before, r"(?s)^([^/]*)", 1)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return urls.withColumns(
        {
            "host": F.translate(host, letters, letters.lower()),
            "path": F.substring(before, F.length(host) + 1, F.length(before)),
        }
    )


def _bits(key: Column) -> Column:
    """One bit for each word of the key's block."""
    return F.array(
        *[
            F.expr("shiftleft(1L, cast(pmod({h}, 64) as int))".format(h=f"xxhash64(key, {w})"))
            for w in range(BLOCK_WORDS)
        ]
    )


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("key", F.lit(BLOCK_WORDS)), F.lit(blocks))


def build_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """Blocked Bloom filter of the column key: one row per block in use. Bits are
    joined by a grouped bit_or, so that building it needs no single task."""
    bits = keys.select(_block(blocks).alias("block"), _bits(F.col("key")).alias("bits"))
    return bits.groupBy("block").agg(
        *[F.bit_or(F.col("bits")[w]).alias(f"w{w}") for w in range(BLOCK_WORDS)]
    )


def url_filter(
    pages: DataFrame, rules: DataFrame, key_column: str = "page_id", size: FilterSize = FilterSize()
) -> DataFrame:
    """Judge urls by rules (columns host, path, verdict).

    A rule fits urls of its host and all subdomains whose path starts with the
    rule's. Of several the longest wins; of rules of the same text the greatest
    verdict (block before allow). Urls that no rule fits are allowed.

    Returns key_column, host, path, rule (host and path of the rule, or null)
    and verdict, one row for each row of pages. Null urls have an empty host,
    which only a rule of an empty host could fit. Keys may be null or repeated:
    every row is judged. Rules with null parts are left out.

    Each url is looked up under every suffix of its host at a dot, combined with
    those lengths of its path that rules have. Keys that pass the Bloom filter
    go on to a hash join with the rules, which removes false positives.
    """
    listed = (
        rules.where("host is not null and path is not null and verdict is not null")
        .select(
            F.lower("host").alias("r_host"),
            F.col("path").alias("r_path"),
            F.col("verdict").alias("r_verdict"),
        )
        .groupBy("r_host", "r_path")
        .agg(F.max("r_verdict").alias("r_verdict"))
        .withColumn("key", F.concat_ws("/", "r_host", "r_path"))
    )
    measured = listed.agg(
        F.count("*"),
        F.coalesce(F.sum(F.octet_length("key") * 2 + 64), F.lit(0)),
        F.array_sort(F.collect_set(F.length("r_path"))),  # at most the length of a path
    ).first()
    n_rules, rule_bytes, lengths = measured[0], measured[1], list(measured[2])
    blocks = max(1, ceil(n_rules * size.bits_per_key / (64 * BLOCK_WORDS)))

    judged = with_host_and_path(pages.select(F.col(key_column).alias("_key"), "url"))
    # Equal urls are judged once; the answer goes back by host and path.
    labels = F.split("host", r"\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    paths = F.filter(
        F.array(*[F.struct(F.lit(n).alias("n"), F.substring("path", 1, n).alias("p")) for n in lengths])
        if lengths
        else F.expr("array(named_struct('n', 1, 'p', ''))"),
        lambda x: F.length(x["p"]) == x["n"],
    )
    asked = (
        judged.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(hosts).alias("k_host"), paths.alias("_paths"))
        .select("host", "path", "k_host", F.explode("_paths.p").alias("k_path"))
        .withColumn("key", F.concat_ws("/", "k_host", "k_path"))
    )

    def sent(df: DataFrame, size_in_bytes: int) -> DataFrame:
        return F.broadcast(df) if size_in_bytes <= size.broadcast_bytes else df

    table = build_filter(listed.select("key"), blocks)
    passes = F.lit(True)
    for w in range(BLOCK_WORDS):
        passes = passes & (F.col(f"w{w}").bitwiseAND(F.col("bits")[w]) != 0)
    possible = (
        asked.withColumn("block", _block(blocks))
        .withColumn("bits", _bits(F.col("key")))
        .join(sent(table, blocks * (BLOCK_WORDS + 1) * 8), "block")
        .where(passes)
    )
    exact = possible.join(
        sent(listed, rule_bytes),
        (possible.key == listed.key)
        & (possible.k_host == listed.r_host)
        & (possible.k_path == listed.r_path),
    )
    best = exact.groupBy("host", "path").agg(
        F.max_by(
            F.struct(F.concat("r_host", "r_path").alias("rule"), "r_verdict"),
            F.struct(F.length(F.concat("r_host", "r_path")), F.concat("r_host", "r_path")),
        ).alias("best")
    )
    return (
        judged.join(best, ["host", "path"], "left")
        .select(
            F.col("_key").alias(key_column),
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.r_verdict", F.lit("allow")).alias("verdict"),
        )
    )


def rules_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")
