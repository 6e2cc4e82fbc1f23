"""Batter-specific strike zone and pitch location cells. All edges are open: a
pitch exactly on a line, or with no location, belongs to no cell."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pitchlake.functions.text import decode

# Zone edges in metres, body-height factors, cell labels.
PLATE_EDGE = 0.271
PLATE_THIRD = 0.0903
SHADOW_EDGE = 0.381
CORE_EDGE = 0.161
SHADOW_DEPTH = 0.11
DEFAULT_TOP, TOP_SLOPE, TOP_SHIFT = 1.049, 0.5575, 3.5
DEFAULT_BOTTOM, BOTTOM_SLOPE, BOTTOM_SHIFT = 0.463, 0.2704, -3.5
QUADRANT_SPLIT = 0.75
NO_CELL = 99
NOT_SPECIFIED = "Not Specified"
LEFT_CELLS = [1, 4, 7]
RIGHT_CELLS = [3, 6, 9]
HIGH_CELLS = [1, 2, 3]
LOW_CELLS = [7, 8, 9]
CORE_CELLS = ["nz1", "nz2", "nz3", "nz4", "core", "nz6", "nz7", "nz8", "nz9"]

NUMBER_TEXT = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"


def clean_height(height: Column) -> Column:
    """Height in cm, NULL when the text is no number. The pattern keeps out what a
    cast alone would take, such as a trailing `d`."""
    text = height.cast("string")
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def zone_limits(height: Column) -> dict[str, Column]:
    def limit(slope: float, shift: float, default: float) -> Column:
        return F.coalesce((height * slope + shift) / 100, F.lit(default))

    return {
        "high": limit(TOP_SLOPE, TOP_SHIFT, DEFAULT_TOP),
        "low": limit(BOTTOM_SLOPE, BOTTOM_SHIFT, DEFAULT_BOTTOM),
    }


def zone_lines(high: Column, low: Column) -> dict[str, Column]:
    """Lines inside and around the zone: thirds, shadow and core."""
    third = (high - low) / 3
    return {
        "1/3": low + third,
        "2/3": high - third,
        "zonehigh": high + SHADOW_DEPTH,
        "corehigh": high - SHADOW_DEPTH,
        "corelow": low + SHADOW_DEPTH,
        "zonelow": low - SHADOW_DEPTH,
    }


def _between(value: Column, low: Column, high: Column) -> Column:
    return (value > low) & (value < high)


def _band(value: Column, lines: list[Column]) -> Column:
    """Index of the open interval between consecutive lines, NULL for none."""
    chain = F.when(_between(value, lines[0], lines[1]), 0)
    for i in range(1, len(lines) - 1):
        chain = chain.when(_between(value, lines[i], lines[i + 1]), i)
    return chain


def _grid(x: Column, z: Column, edge: float, inner: float, rows: list[str]) -> Column:
    """Cell 1..9 of a 3x3 grid read from the top left, NULL outside. `rows` names
    the four horizontal lines from the bottom up."""
    column = _band(x, [F.lit(e) for e in (-edge, -inner, inner, edge)])
    row = _band(z, [F.col(f"`{line}`") for line in rows])
    return (F.lit(2) - row) * 3 + column + 1


def in_out(x: Column, z: Column) -> Column:
    """Inside the plate rectangle, in the shadow around it, or neither."""

    def within(edge: float, bottom: str, top: str) -> Column:
        return _between(x, F.lit(-edge), F.lit(edge)) & _between(z, F.col(bottom), F.col(top))

    return (
        F.when(within(PLATE_EDGE, "low", "high"), "IN")
        .when(within(SHADOW_EDGE, "zonelow", "zonehigh"), "OUT")
        .otherwise(NOT_SPECIFIED)
    )


def location_zone(x: Column, z: Column, in_out: Column) -> Column:
    """1..9 inside, 11..14 by quadrant in the shadow, else 99."""
    left = F.when(x < 0, 0).when(x > 0, 1)
    lower = F.when(z > QUADRANT_SPLIT, 0).when(z < QUADRANT_SPLIT, 2)
    return F.coalesce(
        _grid(x, z, PLATE_EDGE, PLATE_THIRD, ["low", "1/3", "2/3", "high"]),
        F.when(in_out == "OUT", left + lower + 11),
        F.lit(NO_CELL),
    )


def core_zone(x: Column, z: Column) -> Column:
    """Cell label on the larger grid of core, edges and corners."""
    cell = _grid(x, z, SHADOW_EDGE, CORE_EDGE, ["zonelow", "corelow", "corehigh", "zonehigh"])
    # Not element_at over an array: in ANSI mode it takes a NULL index for non-null.
    labels = {name: [number] for number, name in enumerate(CORE_CELLS, start=1)}
    return F.coalesce(decode(cell, labels), F.lit(NOT_SPECIFIED))


def take_location(zone: Column, swing: Column) -> dict[str, Column]:
    """Side and height of pitches in the zone that were not swung at; no swing
    flag means no swing."""
    taken = ~swing.eqNullSafe(F.lit(1))
    return {
        "l_r": F.when(taken & zone.isin(LEFT_CELLS), "Left_take")
        .when(taken & zone.isin(RIGHT_CELLS), "Right_take")
        .otherwise(NOT_SPECIFIED),
        "h_l": F.when(taken & zone.isin(HIGH_CELLS), "High_take")
        .when(taken & zone.isin(LOW_CELLS), "Low_take")
        .otherwise(NOT_SPECIFIED),
    }
