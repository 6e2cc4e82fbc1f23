"""Pitch-by-pitch tracking data to a wide pitch fact, as Spark jobs."""

from pitchlake.leagues import LEAGUES, League
from pitchlake.plans.changes import publish_changes
from pitchlake.plans.fact import pitch_fact, publish
from pitchlake.sources import Sources, read_fact, read_jdbc, read_parquet

__all__ = [
    "LEAGUES",
    "League",
    "Sources",
    "pitch_fact",
    "publish",
    "publish_changes",
    "read_fact",
    "read_jdbc",
    "read_parquet",
]
