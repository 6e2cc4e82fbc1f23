"""A shared folder for checks in sessions that name none."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def name_shared_folder(spark: SparkSession) -> None:
    """On one machine a temporary folder will do; a cluster must name its own."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local"):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pitchlake-checks-"))
