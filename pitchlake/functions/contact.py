"""Batted-ball contact grade and field position."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

from pitchlake.functions.units import KM_PER_MILE


@dataclass(frozen=True)
class Band:
    """A region of the (exit speed v in mph, launch angle a) plane: closed
    intervals, plus lines p*v + q*a kept at or above / at or below a bound."""

    grade: int
    v: tuple[float | None, float | None] = (None, None)
    a: tuple[float | None, float | None] = (None, None)
    at_least: tuple[tuple[float, float, float], ...] = ()
    at_most: tuple[tuple[float, float, float], ...] = ()


# Contact bands, tried in this order. 6 barrel, 5 solid contact,
# 4 flare, 3 under, 2 topped, 1 weak.
BANDS = (
    Band(6, v=(98, None), a=(4, 50), at_least=((1.5, -1, 117), (1, 1, 124))),
    Band(5, v=(95, None), a=(0, 52), at_least=((1.5, -1, 111), (1, 1, 119))),
    Band(1, v=(None, 59)),
    Band(4, v=(59, 72), a=(None, 41), at_least=((2, -1, 87), (1, 1.3, 89)), at_most=((2, 1, 175),)),
    Band(4, v=(72, 86), at_least=((1, 1.55, 92),), at_most=((1, 1.3, 112),)),
    Band(4, v=(86, 95), a=(None, 20), at_least=((1, 2.4, 98),)),
    Band(4, v=(95, None), a=(None, 30), at_least=((1, -1, 76), (1, 2.4, 98))),
    Band(3, at_least=((1, 2, 116),)),
    Band(2, at_most=((1, 2, 116),)),
)


def _inside(band: Band, v: Column, a: Column) -> Column:
    tests = []
    for value, (low, high) in ((v, band.v), (a, band.a)):
        tests += [value >= low] if low is not None else []
        tests += [value <= high] if high is not None else []
    tests += [v * p + a * q >= bound for p, q, bound in band.at_least]
    tests += [v * p + a * q <= bound for p, q, bound in band.at_most]
    return reduce(and_, tests)


def exit_speed_mph(exit_speed: Column) -> Column:
    """Unrounded, unlike the published launch speed."""
    return exit_speed / KM_PER_MILE


def contact_grade(v: Column, angle: Column, in_play: Column) -> Column:
    """Grade 1..6 of a ball in play. `v` should be a named column: it is read by
    every band."""
    first, *rest = BANDS
    chain = F.when(_inside(first, v, angle), first.grade)
    for band in rest:
        chain = chain.when(_inside(band, v, angle), band.grade)
    return F.when(in_play, chain)


def spray_side(bearing: Column) -> Column:
    return F.when(bearing >= 0, "R").when(bearing < 0, "L")


def ground_position(distance: Column, bearing: Column, in_play: Column) -> dict[str, Column]:
    """Landing point on axes along the two foul lines, whole metres."""
    from_line = F.radians(F.lit(45) - bearing)
    return {
        name: F.when(in_play, F.round(distance * leg(from_line), 0).cast("long"))
        for name, leg in (("groundX", F.cos), ("groundY", F.sin))
    }
