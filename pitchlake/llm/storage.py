"""Tables and files in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import posixpath
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where none is named, a local
    session gets one of its own; a cluster must name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="pitchlake-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder below the shared one, deleted as the program ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None:  # the session has ended before; its folder is the user's
        return
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


#: Set while a table is written: its shuffle files go from the executors' disks
#: with the write, and not when the driver next collects its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: the result is
    computed once and its lineage ends there."""
    path, conf = new_folder(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(SHUFFLES_GO, None)
    conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(SHUFFLES_GO) if before is None else conf.set(SHUFFLES_GO, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, local or remote, for use inside tasks."""
    return fs.FileSystem.from_uri(path)


def publish_file(path: str, name: str, parts) -> None:
    """Write byte strings as one file. The file appears under its name only when
    complete, so a task that is lost and run again leaves a whole one."""
    filesystem, folder = open_folder(path)
    filesystem.create_dir(folder, recursive=True)
    draft = posixpath.join(folder, f"_{name}.{uuid.uuid4().hex}")
    with filesystem.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    filesystem.move(draft, posixpath.join(folder, name))


def read_range(path: str, name: str, start: int = 0, length: int | None = None) -> bytes:
    filesystem, folder = open_folder(path)
    with filesystem.open_input_file(posixpath.join(folder, name)) as source:
        source.seek(start)
        return source.read(length) if length is not None else source.read()
