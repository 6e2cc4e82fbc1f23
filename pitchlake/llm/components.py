"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .storage import written


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Smallest reachable id of every id that has a link: columns id, component.

    Links with a null end or from an id to itself are left out. Each step links
    the neighbours of an id to their smallest one; neighbourhoods are reduced
    by a grouped minimum, which sums up before its shuffle, and looked up by a
    join, whose hot ids adaptive execution splits. Every round is written to
    the shared folder. Rounds grow with the logarithm of the longest chain.
    """
    links = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    links, state = _settled(links)
    while state[0]:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(least.where("m < u").select("u", F.col("m").alias("v")))
            .distinct()
        )
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(root, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(root.select("u", F.col("m").alias("v")))
            .distinct()
        )
        links, now = _settled(small)
        if now == state:
            break
        state = now
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots)


def _settled(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as a written table, and figures that tell two sets of links apart."""
    links = written(links, "links")
    figures = links.agg(
        F.count("*"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
    ).first()
    return links, tuple(figures)
