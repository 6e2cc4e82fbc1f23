"""Tracked pitches with the operator's log and the sampled flight path."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pitchlake.operators.joins import (
    DEFAULT_LIMITS,
    NO_HOT_KEYS,
    HotKeys,
    JoinLimits,
    hot_keys,
    hot_keys_by,
    split_left_join,
)

LOG_KEY = ["game_seq", "pit_seq"]
TRACE_KEY = ["game_seq", "pitchno"]
PITCH_KEYS = {"log": LOG_KEY, "trace": TRACE_KEY}


def trace_by_pitchno(trace: DataFrame) -> DataFrame:
    return trace.withColumnRenamed("pitch_no", "pitchno")


def join_pitch_log(
    pitches: DataFrame,
    log: DataFrame,
    hot_left: HotKeys = NO_HOT_KEYS,
    hot_right: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    return split_left_join(pitches, log, LOG_KEY, hot_left, hot_right, grow_together=True)


def join_trace(
    pitches: DataFrame,
    trace: DataFrame,
    hot_left: HotKeys = NO_HOT_KEYS,
    hot_right: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    side = trace_by_pitchno(trace)
    return split_left_join(pitches, side, TRACE_KEY, hot_left, hot_right, grow_together=True)


def join_pitch_tables(
    pitches: DataFrame,
    log: DataFrame,
    trace: DataFrame,
    limits: JoinLimits = DEFAULT_LIMITS,
    hot: dict[str, HotKeys] | None = None,
) -> DataFrame:
    """Both joins. The three tables grow together, so neither side is ever
    hinted for broadcast; each join shuffles on its full key, far finer than
    the game, so that no game weighs on one task. `hot` gives the hot keys of
    the pitches by log and by trace where the caller has them."""
    hot = hot or hot_keys_by(pitches, PITCH_KEYS, limits)
    logged = join_pitch_log(pitches, log, hot["log"], hot_keys(log, LOG_KEY, limits))
    by_trace = hot_keys(trace_by_pitchno(trace), TRACE_KEY, limits)
    return join_trace(logged, trace, hot["trace"], by_trace)
