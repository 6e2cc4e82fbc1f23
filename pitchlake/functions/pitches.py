"""Pitch identity: kind, family, count and base state."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pitchlake.functions.text import decode, fold

# Pitch codes of the log, tracker labels, names and families.
LOG_PITCH_CODES = {
    "FF": ["31"],
    "CU": ["32"],
    "SL": ["33"],
    "CH": ["34"],
    "FS": ["35"],
    "SI": ["36"],
    "FT": ["37"],
    "FC": ["38"],
    "ST": ["131"],
}
TRACKER_PITCH_TYPES = {
    "FF": ["fastball", "four-seam"],
    "SI": ["sinker"],
    "CU": ["curveball"],
    "SL": ["slider"],
    "CH": ["changeup"],
    "FS": ["splitter"],
    "FC": ["cutter"],
    "ST": ["sweeper"],
}
PITCH_NAMES = {
    "4-Seam Fastball": ["FF"],
    "Changeup": ["CH"],
    "Slider": ["SL"],
    "Curveball": ["CU"],
    "Sweeper": ["ST"],
    "Split-Finger": ["FS"],
    "2-Seam Fastball": ["FT", "SI"],
    "Cutter": ["FC"],
}
PITCH_FAMILIES = {
    "Fastball": ["4-Seam Fastball", "2-Seam Fastball", "Cutter"],
    "Breaking": ["Slider", "Curveball", "Sweeper"],
    "Off_Speed": ["Changeup", "Split-Finger"],
}
COUNT_LEVERAGE = {
    "Neutral": ["0-0", "3-2"],
    "Pitcher": ["0-1", "0-2", "1-1", "1-2", "2-2"],
    "Hitter": ["1-0", "2-0", "2-1", "3-0", "3-1"],
}
UNCLASSIFIED = "OT"


def season(gameid: Column) -> Column:
    return F.substring(gameid, 1, 4)


def doubleheader_game(gameid: Column) -> Column:
    return F.right(gameid, F.lit(1))


def pitch_kind(log_code: Column, tracker_type: Column) -> Column:
    """Two-letter kind. The tracker's label counts only where the log has no code:
    an unknown code stays unclassified whatever the tracker says."""
    from_tracker = F.when(log_code.isNull(), decode(fold(tracker_type), TRACKER_PITCH_TYPES))
    return F.coalesce(decode(log_code, LOG_PITCH_CODES), from_tracker, F.lit(UNCLASSIFIED))


def pitch_name(kind: Column) -> Column:
    return F.coalesce(decode(kind, PITCH_NAMES), kind)


def pitch_family(name: Column) -> Column:
    return F.coalesce(decode(name, PITCH_FAMILIES), F.lit(UNCLASSIFIED))


def runners(first: Column, second: Column, third: Column) -> Column:
    """Occupied bases as digits, '0' for none. A base is occupied when its turn
    number is not zero; one unknown base makes the whole state unknown."""
    occupied = F.concat(
        *[
            F.when(turn == 0, "").when(turn != 0, base)
            for base, turn in zip("123", (first, second, third))
        ]
    )
    return F.when(occupied == "", "0").otherwise(occupied)


def count_columns(balls: Column, strikes: Column) -> dict[str, Column]:
    balls, strikes = balls.cast("string"), strikes.cast("string")
    count = F.concat(balls, F.lit("-"), strikes)
    return {
        "balls": balls,
        "strikes": strikes,
        "count": count,
        "count_value": decode(count, COUNT_LEVERAGE),
    }
