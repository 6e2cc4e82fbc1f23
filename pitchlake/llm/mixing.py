"""Mix sources to target weights: whole documents are drawn so that each source
takes its share of words, by pivotal dependent rounding over a reduction tree."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import written

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """weights: of the sources in code point order, null last, repeating.
    share: words of the mix against those of all documents. most: copies of a
    document, and of a source's words, at most. fan: units that one step of the
    reduction tree rounds together; it changes which documents are drawn, never
    how many words. seed: of the draw."""

    weights: Sequence[float] = (3, 1, 2)
    share: float = 1.5
    most: float = 2.0
    fan: int = 64
    seed: int = 8


def source_targets(sized: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Words to take from each source: source, source_size, target.

    The words are dealt by weight; a source that would get more than mix.most
    times its size gets just that, and the rest is dealt among the others. In
    order of size per weight these sources come first, so running sums give the
    level at which the others stand. The windows run over one row per source.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    dealt = F.array(*[F.lit(float(w)) for w in mix.weights])
    weighed = sizes.withColumn(
        "weight", F.element_at(dealt, ((F.row_number().over(by_name) - 1) % len(mix.weights)) + 1)
    ).withColumn("cap", F.col("source_size") * mix.most)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = weighed.withColumn(
        "level",
        (
            F.sum("source_size").over(everything) * mix.share
            - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
        )
        / F.sum("weight").over(later),
    ).withColumn("open", F.col("level") < F.col("cap") / F.col("weight"))
    water = F.min_by(
        F.when(F.col("open"), F.col("level")),
        F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "source")),
    ).over(everything)
    filled = level.withColumn("water", water)
    return filled.select(
        "source",
        "source_size",
        F.when(F.col("open"), F.col("water") * F.col("weight")).otherwise(F.col("cap")).alias("target"),
    )


def _draw(seed: int, *columns: Column) -> Column:
    """Number in [0, 1) that depends on the columns only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) * F.lit(2.0**-53)


def _pivot(seed: int, state: Column, y: Column) -> Column:
    """One step: the open unit x and the next unit y exchange mass until one of
    them is empty or full. That one is done, the other stays open."""
    x = state["open"]
    up = F.least(x["size"] - x["mass"], y["mass"])
    down = F.least(x["mass"], y["size"] - y["mass"])
    chance = _draw(seed, x["hash"], y["hash"])
    x_gains = chance * (up + down) < down
    x_full = (x["size"] - x["mass"]) <= y["mass"]
    x_empty = x["mass"] <= (y["size"] - y["mass"])
    x_done = (x_gains & x_full) | (~x_gains & x_empty)

    def unit(u: Column, mass: Column) -> Column:
        return F.struct(
            u["hash"].alias("hash"),
            u["doc_id"].alias("doc_id"),
            u["size"].alias("size"),
            u["copies"].alias("copies"),
            mass.alias("mass"),
        )

    done = F.when(x_done, unit(x, F.when(x_gains, x["size"]).otherwise(F.lit(0.0)))).otherwise(
        unit(y, F.when(x_gains, F.lit(0.0)).otherwise(y["size"]))
    )
    still = (
        F.when(x_gains & x_full, unit(y, y["mass"] - (x["size"] - x["mass"])))
        .when(x_gains, unit(x, x["mass"] + y["mass"]))
        .when(x_empty, unit(y, y["mass"] + x["mass"]))
        .otherwise(unit(x, x["mass"] - (y["size"] - y["mass"])))
    )
    return F.struct(F.concat(state["done"], F.array(done)).alias("done"), still.alias("open"))


def _step(seed: int):
    return lambda state, y: _pivot(seed, state, y)


def mix_sources(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", mix: Mix = Mix()
) -> DataFrame:
    """Words that a mix takes from every document.

    Returns doc_id, source, size (words of the text; null: 0), source_size,
    target (words wanted from the source) and taken (a whole multiple of size,
    at most mix.most times it).

    Every document of a source has the same wanted number of copies, target over
    size of the source. Its whole part is taken as it is. The fraction, times
    the size, is a mass of words; pairs of documents exchange mass at random
    until one of them has none or all of its words, which changes neither the
    sum of the masses nor the chance of any document. Buckets of about mix.fan
    documents are folded by themselves; what stays open in each goes on to the
    next level of the tree. The last open document of a source is rounded by
    its chance, so that a source misses its target by less than one document.

    Equal rows (id, source and size) are one unit with a number of copies, so
    that many of them do not meet in a bucket. Null ids and null sources are
    values like others. Empty documents take 0 words. The draw depends on ids
    and sizes only: reruns agree.
    """
    sized = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        ),
        "sizes",
    )
    equal = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies"))
    targets = written(source_targets(sized, mix), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # One row per source, and the sides are equal in null sources too.
    units = (
        equal.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .drop("_s")
        .withColumn("whole", F.floor(rate))
        .withColumn("part", (rate - F.col("whole")) * F.col("copies"))
        .withColumn("extra", F.floor("part"))
        .withColumn("mass", (F.col("part") - F.col("extra")) * F.col("size"))
        .withColumn("hash", F.xxhash64(F.lit(mix.seed), "doc_id", "source", "size"))
    )
    units = written(units, "units")
    open_units = units.where("mass > 0")
    most = open_units.groupBy("source").agg(F.count("*").alias("n"))
    most = written(most, "counts")
    largest = most.agg(F.max("n")).first()[0] or 0
    buckets = F.greatest(F.lit(1), F.ceil(F.col("n") / mix.fan))
    level = (
        open_units.join(most.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("bucket", F.pmod(F.col("hash"), buckets))
        .select(
            "source",
            "bucket",
            F.struct("hash", "doc_id", F.col("size").cast("double").alias("size"), "copies", "mass").alias("u"),
        )
    )
    settled, nodes, depth = [], ceil(largest / mix.fan), 0
    while largest:
        folded = level.groupBy("source", "bucket").agg(F.array_sort(F.collect_list("u")).alias("us"))
        first = F.struct(F.slice("us", 1, 0).alias("done"), F.col("us")[0].alias("open"))
        folded = folded.select(
            "source",
            "bucket",
            F.aggregate(
                F.slice("us", 2, F.size("us")),
                first,
                _step(mix.seed + 1 + depth),
            ).alias("f"),
        )
        folded = written(folded, f"level{depth}")
        settled.append(folded.select("source", F.explode("f.done").alias("u")))
        level = folded.select(
            "source", F.floor(F.col("bucket") / mix.fan).alias("bucket"), F.col("f.open").alias("u")
        )
        if nodes <= 1:
            break
        nodes, depth = ceil(nodes / mix.fan), depth + 1
    if largest:
        last = F.col("u.mass") > _draw(mix.seed, F.col("u.hash")) * F.col("u.size")
        settled.append(
            level.select(
                "source",
                F.col("u").withField("mass", F.when(last, F.col("u.size")).otherwise(F.lit(0.0))).alias("u"),
            )
        )
    chosen = units.where("mass <= 0").select(
        "source", "doc_id", "size", "copies", F.lit(0).alias("chosen")
    )
    for part in settled:
        chosen = chosen.unionAll(
            part.select(
                "source",
                "u.doc_id",
                F.col("u.size").cast("long"),
                "u.copies",
                F.when(F.col("u.mass") > 0, 1).otherwise(0),
            )
        )
    # whole and extra depend on the source and the number of copies alone.
    rated = targets.withColumn("rate", rate).withColumnRenamed("source", "_s")
    drawn = (
        chosen.join(rated, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("whole", F.floor("rate"))
        .withColumn("more", F.floor((F.col("rate") - F.col("whole")) * F.col("copies")) + F.col("chosen"))
    )
    return drawn.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "whole",
        "more",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).select(
        F.col("doc_id").alias(doc_id),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("whole") + F.when(F.col("copy") <= F.col("more"), 1).otherwise(0))).alias("taken"),
    )
