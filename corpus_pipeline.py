"""Corpus pipeline: good documents, one of each near-duplicate group, without
benchmark items, mixed to source weights, as token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the
columns of documents, extra ones included, whatever their names. Documents are told apart by doc_id;
rows without one are judged for quality and mixed like others, and kept by the
stages that compare documents by id. Empty tables pass through every stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pitchlake.llm.decontaminate import find_items
from pitchlake.llm.mixing import WORD, mix_sources
from pitchlake.llm.near_duplicates import ChosenPaths, near_duplicates
from pitchlake.llm.quality import learn_quality, score_quality
from pitchlake.llm.queries import keep_workers_small, table, token_rows
from pitchlake.llm.storage import written

#: Largest list of ids that is sent to all tasks; larger ones are shuffled.
BROADCAST_BYTES = 64 << 20
#: Most rows of one unit of the mix that are ranked in one task.
RANKED_ROWS = 4096


#: Columns that stages read; others are carried along.
READ = ("doc_id", "text", "source")
#: Near duplicates share four fifths of their runs of five words.
NEAR = ChosenPaths(shingle=5)


def _carrying(stage: Callable) -> Callable:
    """The stage with all columns that it does not read under names of no
    meaning, so that none of them is taken for one of its own."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        keep_workers_small(spark)
        plain = docs.toDF(*[c if c in READ else f"c{i}" for i, c in enumerate(docs.columns)])
        return stage(spark, plain, sf_dir).toDF(*docs.columns)

    return run


def _sent(df: DataFrame, row_bytes: int) -> DataFrame:
    df = written(df, "listed")
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose id is not listed."""
    listed = _sent(ids.select(F.col("doc_id").alias("_gone")).where("_gone is not null").distinct(), 32)
    return docs.join(listed, docs["doc_id"] == F.col("_gone"), "left_anti")


@_carrying
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    model = learn_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model, docs.columns).where("predicted = 1").select(*docs.columns)


@_carrying
def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates. Rows that
    repeat an id stay or go together."""
    return _without(docs, near_duplicates(docs, p=NEAR).where("not kept").select("doc_id"))


@_carrying
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _without(docs, find_items(docs, table(spark, sf_dir, "benchmark")).select("doc_id"))


def _with_one_more(rows: DataFrame) -> DataFrame:
    """The _row of _more rows of each _unit, which has _rows, in order of _hash.

    Large units are cut by ten bits of the order at a time: counts by unit and
    digit tell where the last chosen row lies, until few rows are left to rank.
    Rows of equal text are told apart by their number.
    """
    digits = [
        F.pmod(F.shiftrightunsigned(h, 10 * k), F.lit(1024)).alias("_digit")
        for h in (F.col("_hash"), F.xxhash64("_row"))
        for k in range(6)
    ]
    order = [*digits, F.col("_row")]
    few, large, chosen = rows.where(F.col("_rows") <= RANKED_ROWS), rows.where(F.col("_rows") > RANKED_ROWS), []
    most = rows.agg(F.max("_rows")).first()[0]
    for digit in digits:
        if most <= RANKED_ROWS:
            break
        counts = large.groupBy("_unit", digit).agg(F.count("*").alias("_n"), F.min("_more").alias("_more"))
        upto = F.sum("_n").over(Window.partitionBy("_unit").orderBy("_digit"))
        cut = counts.withColumn("_upto", upto).where("_upto >= _more and _upto - _n < _more")
        cut = _sent(cut.selectExpr("_unit as _of", "_digit as _cut", "_more - _upto + _n as _left", "_n"), 64)
        most = cut.agg(F.max("_n")).first()[0]
        split = large.withColumn("_digit", digit).join(cut, F.col("_unit") == F.col("_of"))
        chosen.append(split.where("_digit < _cut").select("_row"))
        at = split.where("_digit = _cut").selectExpr("_unit", "_left as _more", "_n as _rows", "_hash", "_row")
        few = few.unionAll(at.where(F.col("_rows") <= RANKED_ROWS))
        large = at.where(F.col("_rows") > RANKED_ROWS)
    ranked = few.withColumn("_rank", F.row_number().over(Window.partitionBy("_unit").orderBy(*order)))
    out = ranked.where("_rank <= _more").select("_row")
    for part in chosen:
        out = out.unionAll(part)
    return out


@_carrying
def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; empty ones are taken never.

    Rows of equal id, source and size are one unit of the mix: all are taken
    equally often, and some of them once more, in order of a hash of their text.
    """
    unit = [F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size")]
    copies = mix_sources(docs).where("size > 0").select(*unit, (F.col("taken") / F.col("size")).cast("long").alias("_copies"))
    listed = copies.groupBy("_id", "_source", "_size").agg(
        F.count("*").alias("_rows"), F.min("_copies").alias("_whole"), F.sum("_copies").alias("_all")
    )
    listed = listed.where("_all > 0").withColumn("_more", F.col("_all") - F.col("_whole") * F.col("_rows"))
    listed = written(listed.drop("_all").withColumn("_unit", F.monotonically_increasing_id()), "copies")
    repeated = listed.where("_more > 0").limit(1).count() > 0
    sized = docs.withColumn(
        "_words", F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    )
    joined = sized.join(
        _sent(listed, 64),
        F.col("doc_id").eqNullSafe(F.col("_id"))
        & F.col("source").eqNullSafe(F.col("_source"))
        & (F.col("_words") == F.col("_size")),
    )
    own = [F.col(f"`{c}`") for c in docs.columns]
    times = joined.where("_more = 0").select(*own, F.col("_whole").cast("int").alias("_times"))
    if repeated:
        some = joined.where("_more > 0").select(
            *own, "_unit", "_more", "_rows", "_whole", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row")
        )
        some = written(some, "repeated")
        more = _with_one_more(some.select("_unit", "_more", "_rows", "_hash", "_row"))
        some = some.join(more.select(F.col("_row").alias("_chosen")), F.col("_row") == F.col("_chosen"), "left")
        once = F.when(F.col("_chosen").isNotNull(), 1).otherwise(0)
        times = times.unionAll(some.select(*own, (F.col("_whole") + once).cast("int").alias("_times")))
    return times.select(*own, F.explode(F.array_repeat(F.lit(0), F.col("_times"))).alias("_time")).drop("_time")


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in shards, and what they hold, read back."""
    keep_workers_small(spark)
    return token_rows(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("near-duplicates", keep_one_of_group),
    ("decontamination", drop_contaminated),
    ("mixing", mix_to_weights),
    ("token ids", write_token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: Edit distance, a learned model and a random draw have no SQL form.
ORACLE_SQL = None
