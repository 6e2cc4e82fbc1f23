"""Indicator columns, in the two conventions of the published fact: 1 or NULL
(counted with COUNT) and 1 or 0 (never NULL)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pitchlake.functions import strike_zone as sz

# Events and descriptions behind each flag.
PA_EVENTS = [
    "double",
    "double_play",
    "field_error",
    "field_out",
    "fielders_choice_out",
    "force_out",
    "grounded_into_double_play",
    "hit_by_pitch",
    "home_run",
    "sac_bunt",
    "sac_fly",
    "sac_fly_double_play",
    "single",
    "strikeout",
    "strikeout_double_play",
    "triple",
    "walk",
]
NOT_AB_EVENTS = ["hit_by_pitch", "sac_bunt", "sac_fly", "sac_fly_double_play", "walk"]
HIT_EVENTS = ["double", "home_run", "single", "triple"]
FOUL_CALLS = ["foul", "foul_tip"]
CONTACT_CALLS = [*FOUL_CALLS, "hit_into_play", "hit_into_play_no_out", "hit_into_play_score"]
WHIFF_CALLS = ["swinging_strike", "swing_strike_blocked"]
LOOKING_CALLS = ["ball", "called_strike"]
BATTED_BALL_FLAGS = {"ld": "Line_Drive", "fb": "Fly_Ball", "gb": "Ground_Ball", "pu": "Popup"}
# `strkeout` is spelt so in the published fact, as a name and as the event it
# looks for; no event has that spelling, so the flag is 0 throughout.
EVENT_FLAGS = [
    "single",
    "double",
    "triple",
    "home_run",
    "walk",
    "strkeout",
    "hit_by_pitch",
    "sac_fly",
    "sac_bunt",
    "field_out",
]
CONTACT_GRADE_FLAGS = {
    "weak": 1,
    "topped": 2,
    "under": 3,
    "flare": 4,
    "solid_contact": 5,
    "barrel": 6,
}


def one_or_null(condition: Column) -> Column:
    return F.when(condition, 1)


def one_or_zero(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def plate_appearance_flags(events: Column) -> dict[str, Column]:
    at_bats = [e for e in PA_EVENTS if e not in NOT_AB_EVENTS]
    lists = {"pa": PA_EVENTS, "ab": at_bats, "hit": HIT_EVENTS}
    return {name: one_or_null(events.isin(values)) for name, values in lists.items()}


def swing_flags(description: Column) -> dict[str, Column]:
    lists = {
        "swing": CONTACT_CALLS + WHIFF_CALLS,
        "con": CONTACT_CALLS,
        "whiff": WHIFF_CALLS,
        "foul": FOUL_CALLS,
        "looking": LOOKING_CALLS,
    }
    return {name: one_or_null(description.isin(values)) for name, values in lists.items()}


def zone_flags(zone: Column) -> dict[str, Column]:
    """A pitch in no cell (99) counts as out of the zone."""
    return {
        "z_in": one_or_zero(zone < 10),
        "z_out": one_or_null(zone > 10),
        "z_left": one_or_null(zone.isin(sz.LEFT_CELLS)),
        "z_right": one_or_null(zone.isin(sz.RIGHT_CELLS)),
        "z_high": one_or_null(zone.isin(sz.HIGH_CELLS)),
        "z_low": one_or_null(zone.isin(sz.LOW_CELLS)),
    }


def batted_ball_flags(bb_type: Column) -> dict[str, Column]:
    return {name: one_or_zero(bb_type == label) for name, label in BATTED_BALL_FLAGS.items()}


def event_flags(events: Column, type_: Column, description: Column) -> dict[str, Column]:
    return {
        **{name: one_or_zero(events == name) for name in EVENT_FLAGS},
        "inplay": one_or_zero(type_ == "X"),
        "cs": one_or_zero(description == "called_strike"),
        "S": one_or_zero(type_.isin("S", "X")),
    }


def contact_flags(grade: Column) -> dict[str, Column]:
    return {
        **{name: one_or_zero(grade == value) for name, value in CONTACT_GRADE_FLAGS.items()},
        "plus_lsa4": one_or_zero(grade >= 4),
    }


def discipline_flags(zone: Column, count: Column, done: dict[str, Column]) -> dict[str, Column]:
    """Swings, contact and balls in play by zone, first pitches, zone whiffs.
    `done` holds the swing, con, inplay and whiff flags."""
    places = {"z": zone < 10, "o": zone > 10}
    first_pitch = count == "0-0"
    return {
        **{
            f"{place}_{act}": one_or_null(inside & (done[act] == 1))
            for place, inside in places.items()
            for act in ("swing", "con", "inplay")
        },
        "f_swing": one_or_null(first_pitch & (done["swing"] == 1)),
        "f_pitch": one_or_null(first_pitch),
        "z_str_swing": one_or_null((done["whiff"] == 1) & places["z"]),
    }


def take_flags(l_r: Column, h_l: Column) -> dict[str, Column]:
    return {
        "Left_take": one_or_null(l_r == "Left_take"),
        "Right_take": one_or_null(l_r == "Right_take"),
        "High_take": one_or_null(h_l == "High_take"),
        "Low_take": one_or_null(h_l == "Low_take"),
    }
