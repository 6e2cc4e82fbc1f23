"""Queries of the operators over their whole tables, with production
parameters. Each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from .decontaminate import find_items
from .embedding_pairs import link_vectors
from .license_scan import scan_licenses
from .line_dedup import drop_repeated_lines
from .mixing import mix_sources
from .near_duplicates import near_duplicates
from .quality import held_out, learn_quality, score_quality
from .resampling import resample
from .storage import new_folder
from .substrings import drop_repeats
from .token_shards import read_tokens, stored_keys, write_tokens
from .url_filter import rules_table, url_filter
from .vector_codes import coded_rows, learn_codes
from .warc import read_archive, write_archive

# The rules of the url query.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


#: Worker processes live as long as their executor and go from stage to stage.
#: By these settings of the C library and of Arrow, blocks of a megabyte or more
#: are not kept once freed, which costs up to twice the time of a stage.
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(4 << 20),
    "MALLOC_ARENA_MAX": "2",
}


def keep_workers_small(spark: SparkSession) -> None:
    """For chains of many stages: workers started from now on give memory back."""
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and
    hand texts over in smaller batches than Spark's own, which are for short rows."""
    for batch, given, wanted in (("maxRecordsPerBatch", "10000", "2000"), ("maxBytesPerBatch", "67108864b", "8m")):
        if spark.conf.get(f"spark.sql.execution.arrow.{batch}") == given:
            spark.conf.set(f"spark.sql.execution.arrow.{batch}", wanted)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(":")
    if root not in known:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def token_rows(docs: DataFrame) -> DataFrame:
    """Write the tokens of docs, and read every document back by its key."""
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    write_tokens(docs, folder, tokenizer_file())
    return read_tokens(stored_keys(spark, folder), folder, ids=False)


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    files = write_archive(table(spark, sf_dir, "pages"), folder)
    return read_archive(files, folder, payloads=False).drop("url")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents"), texts=False)


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("source")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_quality(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), rules_table(spark, URL_RULES))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(table(spark, sf_dir, "documents"), new_folder(spark, "line-index"), texts=False)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_rows(spark, learn_codes(table(spark, sf_dir, "embeddings")))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            op1_license_scan,
            op2_token_shards,
            op3_warc,
            op4_decontaminate,
            op5_substring_dedup,
            op6_embedding_dedup,
            op7_minhash_dedup,
            op8_mix_sources,
            op9_quality,
            op10_url_filter,
            op11_line_dedup,
            op12_vector_codes,
            op13_importance_resampling,
        )
    }
