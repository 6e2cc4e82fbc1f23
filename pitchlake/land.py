"""Land the source tables of a database as Parquet, for `job.py` to publish from:
`spark-submit --jars DRIVER pitchlake/land.py --url URL --properties FILE
--games LOW HIGH --out DIR`."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession

if not __package__:  # run as a file: the folder above holds the package
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pitchlake.session import build_session
from pitchlake.sources import JdbcSource, bucket_landed, land_sources, read_jdbc
from pitchlake.sources.ranges import read_jdbc_in_ranges


def land(
    spark: SparkSession, source: JdbcSource, game_range: tuple[int, int], folder: str, staging: str | None = None
) -> None:
    """Read every table once and keep it. Publishing reads only what is landed:
    a live table could change between its passes. With a staging folder the reads
    are of even size, and a landing that breaks off goes on there."""
    if staging:
        land_sources(read_jdbc_in_ranges(spark, source, game_range, staging), folder)
    else:
        land_sources(read_jdbc(spark, source, game_range), folder)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Land the source tables of a database.")
    parser.add_argument("--url", required=True, help="JDBC address")
    parser.add_argument("--properties", required=True, help="JSON file: user, password, driver")
    parser.add_argument("--games", required=True, nargs=2, type=int, metavar=("LOW", "HIGH"), help="game_seq, to cut reads by")
    parser.add_argument("--partitions", type=int, default=JdbcSource.partitions, help="parallel reads of a table")
    parser.add_argument("--out", required=True, help="folder of the landed tables; must be new")
    parser.add_argument("--staging", help="folder to read into first, in even ranges; name it again to go on after a break")
    parser.add_argument("--buckets", action="store_true", help="keep log and trace in buckets of their join keys too")
    parser.add_argument("--shared", help="folder that all executors reach: spark.checkpoint.dir")
    options = parser.parse_args(arguments)
    properties = json.loads(Path(options.properties).read_text())
    source = JdbcSource(options.url, properties, options.partitions)
    spark = build_session(**({"spark.checkpoint.dir": options.shared} if options.shared else {}))
    land(spark, source, tuple(options.games), options.out, options.staging)
    if options.buckets:
        bucket_landed(spark, options.out)


if __name__ == "__main__":
    main()
