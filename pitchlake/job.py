"""Publish the pitch fact: `spark-submit pitchlake/job.py --sources DIR --out DIR
--shared DIR`, or `python -m pitchlake.job` where the package is installed."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

if not __package__:  # run as a file: the folder above holds the package
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pitchlake.leagues import LEAGUES
from pitchlake.plans.changes import publish_changes
from pitchlake.plans.fact import publish
from pitchlake.session import build_session, shuffle_partitions, stored_bytes
from pitchlake.sources import read_parquet


def main(arguments: list[str] | None = None) -> None:
    by_code = {league.code: league for league in LEAGUES}
    parser = argparse.ArgumentParser(description="Publish the pitch fact.")
    parser.add_argument("--sources", required=True, help="folder of the landed source tables")
    parser.add_argument("--out", required=True, help="folder of the published fact")
    parser.add_argument("--league", action="append", choices=sorted(by_code), help="default: all")
    parser.add_argument("--shared", help="folder that all executors reach: spark.checkpoint.dir")
    parser.add_argument("--changes", action="store_true", help="write only the seasons that changes of the sources reach")
    options = parser.parse_args(arguments)
    leagues = tuple(by_code[code] for code in options.league or by_code)
    settings = {"spark.checkpoint.dir": options.shared} if options.shared else {}
    spark = build_session(**settings)
    wanted = str(shuffle_partitions(stored_bytes(spark, options.sources)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", wanted)
    try:
        run = publish_changes if options.changes else publish
        run(read_parquet(spark, options.sources), options.out, leagues)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


if __name__ == "__main__":
    main()
