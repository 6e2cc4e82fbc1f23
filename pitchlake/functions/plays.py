"""What happened on the pitch: call, result, batted ball, outcome."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pitchlake.functions.text import decode, fold

# Source vocabulary (lower case) by published label.
PLAY_RESULT_EVENTS = {
    "field_out": ["out"],
    "fielders_choice_out": ["fielderschoice"],
    "field_error": ["error"],
    "single": ["single"],
    "double": ["double"],
    "triple": ["triple"],
    "home_run": ["homerun"],
}
CALL_DESCRIPTIONS = {
    "foul": ["foulball", "foulballfieldable", "foulballnotfieldable"],
    "ball": ["ballcalled", "ballindirt", "automaticball", "ballautomatic"],
    "called_strike": ["strikecalled", "automaticstrike", "strikeautomatic"],
    "swinging_strike": ["strikeswinging"],
}
CALL_TYPES = {
    "B": ["ballindirt", "ballcalled", "hitbypitch", "ballintentional", "ballautomatic"],
    "S": [
        "strikecalled",
        "foulball",
        "strikeswinging",
        "strikeautomatic",
        "foulballnotfieldable",
        "foulballfieldable",
    ],
    "X": ["inplay"],
}
SAFE_RESULTS = ["double", "single", "homerun", "error", "triple", "fielderschoice"]
RETIRED_RESULTS = ["out", "sacrifice"]
HIT_TYPES = {
    "Ground_Ball": ["groundball"],
    "Line_Drive": ["linedrive"],
    "Fly_Ball": ["flyball"],
    "Popup": ["popup"],
    "Bunt": ["bunt"],
}
HANDS = {"R": ["right"], "L": ["left"]}
OUTCOMES = {
    "strike": ["called_strike"],
    "ball": ["ball"],
    "inplay": ["hit_into_play", "hit_into_play_no_out", "hit_into_play_score"],
    "whiff": ["swinging_strike", "swing_strike_blocked"],
    "foul": ["foul"],
    "hit_by_pitch": ["hit_by_pitch"],
}
SACRIFICE_FLY_METRES = 30


def in_play(call: Column) -> Column:
    return fold(call) == "inplay"


def event(
    result: Column, call: Column, strikeout_or_walk: Column, hit_type: Column, distance: Column
) -> Column:
    """Plate-appearance event. Results are disjoint, so each rule below speaks for
    its own result and the first that speaks wins; a long sacrifice is a fly
    even when tagged a bunt."""
    result, verdict = fold(result), fold(strikeout_or_walk)
    sacrifice = F.when(distance >= SACRIFICE_FLY_METRES, "sac_fly").when(
        (distance < SACRIFICE_FLY_METRES) | (fold(hit_type) == "bunt"), "sac_bunt"
    )
    no_result = result == "undefined"
    return F.coalesce(
        decode(result, PLAY_RESULT_EVENTS),
        F.when(result == "sacrifice", sacrifice),
        F.when((result == "hitbypitch") | (fold(call) == "hitbypitch"), "hit_by_pitch"),
        F.when(no_result & (verdict == "strikeout"), "strikeout"),
        F.when((result == "walk") | (no_result & (verdict == "walk")), "walk"),
    )


def description(call: Column, result: Column, runs: Column) -> Column:
    call, result = fold(call), fold(result)
    scoreless = runs == 0
    into_play = (
        F.when(runs >= 1, "hit_into_play_score")
        .when(scoreless & result.isin(SAFE_RESULTS), "hit_into_play_no_out")
        .when(scoreless & result.isin(RETIRED_RESULTS), "hit_into_play")
    )
    return F.coalesce(
        decode(call, CALL_DESCRIPTIONS),
        F.when(call == "inplay", into_play),
        F.when((call == "hitbypitch") | (result == "hitbypitch"), "hit_by_pitch"),
        F.when(call == "ballintentional", "pitchout"),
    )


def result_type(call: Column) -> Column:
    return decode(fold(call), CALL_TYPES)


def batted_ball_type(call: Column, hit_type: Column) -> Column:
    return F.when(in_play(call), decode(fold(hit_type), HIT_TYPES))


def hand(side: Column) -> Column:
    return decode(fold(side), HANDS)


def outcome(description: Column) -> Column:
    return decode(description, OUTCOMES)
