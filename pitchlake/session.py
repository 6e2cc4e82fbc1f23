"""Session settings of the job, and the shared folder for cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Size of rebalanced partitions, and so of published files before compression.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Call sites of Column operations are looked up in the JVM one by one.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "pitchlake", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors can reach, named by spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute a small result once and cut its lineage in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    with dropping_shuffles(df.sparkSession):
        return df.select("*").checkpoint()  # a plan of its own, made under the setting


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit"
PARTITION_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for what is run here."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def dropping_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of each write made here go from the executors' disks when it
    ends. Otherwise they stay until the driver next collects its garbage, beside
    those of the writes that follow."""
    return setting(spark, SHUFFLES_GO, "true")


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """For writes of wide rows: shuffles go with them, and a stage whose generated
    method the JVM would not compile (beyond 8,000 bytes) is cut into small ones."""
    with dropping_shuffles(spark), setting(spark, METHOD_BYTES, "8000"):
        yield


def finer_partitions(spark: SparkSession, times: float) -> AbstractContextManager[None]:
    """Adaptive partitions smaller by a factor, for rows that grow by it behind
    their shuffle."""
    wanted = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(PARTITION_BYTES))
    return setting(spark, PARTITION_BYTES, str(max(1 << 20, int(wanted / max(1.0, times)))))


def shuffle_partitions(input_bytes: int, partition_bytes: int = 256 << 20) -> int:
    """Shuffle partitions for an input of so many bytes on disk; adaptive
    execution lowers the number where the data turn out smaller."""
    return max(200, -(-input_bytes // partition_bytes))


def stored_bytes(spark: SparkSession, path: str) -> int:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def _files_of(spark: SparkSession, path: str) -> tuple[Any, Any]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole, by one rename, or not at all; fails if
    there is one of that name."""
    files, target = _files_of(spark, path)
    _, draft = _files_of(spark, f"{path}-{uuid.uuid4().hex}")
    out = files.create(draft)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise FileExistsError(path)


def read_note(spark: SparkSession, path: str) -> str | None:
    """Text of a small file; None where there is none."""
    files, target = _files_of(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, spark._jvm.java.nio.charset.StandardCharsets.UTF_8)
    finally:
        stream.close()
