"""Unit conversions. Feet, miles and inches are rounded on the way in, as the
published metric columns are derived from the rounded values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Conversion factors.
MILES_PER_KM = 0.621371
KM_PER_MILE = 1.609344
FEET_PER_METRE = 3.28084
METRES_PER_FOOT = 0.3048
FEET_PER_CM = 0.032808


def miles_per_hour(kmh: Column) -> Column:
    return F.round(kmh * MILES_PER_KM, 1)


def feet(metres: Column, digits: int) -> Column:
    return F.round(metres * FEET_PER_METRE, digits)


def imperial_columns() -> dict[str, Column]:
    """Tracked measures in the units and precision they are graded in."""
    return {
        "release_speed": miles_per_hour(F.col("relspeed")),
        "release_pos_x": feet(F.col("relside"), 2),
        "release_pos_z": feet(F.col("relheight"), 2),
        "pfx_x": F.col("horzbreak") * FEET_PER_CM,
        "pfx_z": F.col("inducedvertbreak") * FEET_PER_CM,
        "plate_x": F.col("platelocside"),
        "plate_z": F.col("platelocheight"),
        "hit_distance_sc": feet(F.col("distance"), 0),
        "launch_speed": miles_per_hour(F.col("exitspeed")),
        "launch_angle": F.round("angle", 0),
        "HangTime": F.round("hangtime", 3),
        "bearing": F.round("bearing", 3),
        "release_spin_rate": F.round("spinrate", 0),
        "release_spin_axis": F.round("spinaxis", 1),
        "release_extension": feet(F.col("extension"), 2),
        "contactX": F.round("contactpositionx", 2),
        "contactY": F.round("contactpositiony", 2),
        "contactZ": F.round("contactpositionz", 2),
    }


def catcher_view(column: Column) -> Column:
    """Horizontal measures mirrored to the catcher's view."""
    return column * -1.0


def metric_columns() -> dict[str, Column]:
    """Metric columns from the rounded imperial ones; breaks in centimetres."""
    return {
        "rel_height": F.col("release_pos_z") * METRES_PER_FOOT,
        "rel_side": F.col("release_pos_x") * METRES_PER_FOOT,
        "hor_break": F.col("pfx_x") * METRES_PER_FOOT * 100,
        "ver_break": F.col("pfx_z") * METRES_PER_FOOT * 100,
        "rel_speed(km)": F.col("release_speed") * KM_PER_MILE,
        "exit_speed(km)": F.col("launch_speed") * KM_PER_MILE,
        "extension": F.col("release_extension") * METRES_PER_FOOT,
        "hit_distance": F.col("hit_distance_sc") * METRES_PER_FOOT,
    }
