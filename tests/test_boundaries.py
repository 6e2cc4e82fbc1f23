"""Edges that the fixtures do not reach."""

import pytest
from pyspark.sql import functions as F

from pitchlake import leagues as lg
from pitchlake.functions import dates, flags, pitches, plays, strike_zone, units
from pitchlake.operators import arm_slot, players
from pitchlake.plans import fact


def values(df):
    return [row[0] if len(row) == 1 else tuple(row) for row in df.collect()]


def ordered(spark, data, schema):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(data)], f"i int, {schema}")


def result(df, *columns):
    return values(df.orderBy("i").select(*columns))


@pytest.mark.parametrize(
    "x, z, zone, area",
    [
        (0.0, 0.75, 5, "core"),
        (-0.0903, 0.75, 99, "core"),  # on an inner line
        (-0.0904, 0.75, 4, "core"),
        (0.271, 0.8, 12, "nz6"),  # on the plate edge: already shadow
        (0.2709, 0.8, 6, "nz6"),
        (-0.2709, 1.04, 1, "nz1"),
        (0.0, 1.049, 99, "nz2"),  # on the top line: shadow, but neither left nor right
        (0.1, 1.049, 12, "nz2"),
        (-0.3, 0.75, 99, "nz4"),  # on the quadrant line
        (-0.3, 0.7499, 13, "nz4"),
        (0.3, 0.7499, 14, "nz6"),
        (0.381, 0.75, 99, "Not Specified"),
        (0.161, 0.75, 6, "Not Specified"),  # on the core edge
        (0.0, 0.939, 2, "Not Specified"),  # on the core line
        (None, 0.75, 99, "Not Specified"),
        (0.0, None, 99, "Not Specified"),
    ],
)
def test_zone_edges(spark, x, z, zone, area):
    df = spark.createDataFrame([(x, z, None)], "plate_x double, plate_z double, Height double")
    assert values(fact.with_zones(df).select("zone", "new_zone")) == [(zone, area)]


def test_pitch_in_no_cell_is_out_of_zone(spark):
    df = spark.createDataFrame([(99,), (9,)], "zone int")
    made = flags.zone_flags(F.col("zone"))
    assert values(df.select(made["z_in"], made["z_out"])) == [(0, 1), (1, None)]


def test_height_text(spark):
    texts = ["183", " 183.5 ", "N/A", "", None, "183d", "NaN", "1e2"]
    df = ordered(spark, [(t,) for t in texts], "h string")
    cleaned = result(df, strike_zone.clean_height(F.col("h")))
    assert cleaned == [183.0, 183.5, None, None, None, None, None, 100.0]
    lines = strike_zone.zone_limits(F.lit(None).cast("double"))
    assert values(df.limit(1).select(lines["high"], lines["low"])) == [(1.049, 0.463)]


def test_games_on_a_closing_date_stay_outside(spark):
    games = ["20221011-Suwon-1", "20221012-Suwon-1", "20211031-Suwon-1", "20260327-Suwon-1"]
    df = spark.createDataFrame([(g, lg.KBO.level) for g in games], "gameid string, level string")
    kept = df.where(lg.league_extract(lg.KBO)).select("gameid")
    assert sorted(values(kept)) == ["20211031-Suwon-1", "20221011-Suwon-1", "20260327-Suwon-1"]


def test_league_and_game_match_in_any_case(spark):
    data = [("20241001-SUWON-1", "kbo minors"), ("20241002-Suwon-1", "KBO MINORS"), ("20201002-x-1", "KBO Minors")]
    df = spark.createDataFrame(data, "gameid string, level string")
    assert values(df.where(lg.league_extract(lg.MINOR)).select("gameid")) == ["20241002-Suwon-1"]


def test_events(spark):
    data = [
        ("Sacrifice", "InPlay", None, "Bunt", 30.0, "sac_fly"),
        ("Sacrifice", "InPlay", None, "Bunt", None, "sac_bunt"),
        ("Sacrifice", "InPlay", None, "FlyBall", None, None),
        ("sacrifice", "InPlay", None, "FlyBall", 29.9, "sac_bunt"),
        ("HitByPitch", "BallCalled", None, None, None, "hit_by_pitch"),
        (None, "HitByPitch", None, None, None, "hit_by_pitch"),
        ("Undefined", "StrikeCalled", "STRIKEOUT", None, None, "strikeout"),
        ("Single", "HitByPitch", "Walk", None, None, "single"),
        ("Walk", "BallCalled", None, None, None, "walk"),
        (None, None, None, None, None, None),
    ]
    df = ordered(spark, data, "r string, c string, k string, t string, d double, e string")
    got = result(df, plays.event(*[F.col(c) for c in "rcktd"]))
    assert got == [row[-1] for row in data]


def test_automatic_calls_have_a_description_but_no_type(spark):
    calls = ["AutomaticBall", "AutomaticStrike", "BallAutomatic", "foulballfieldable"]
    df = ordered(spark, [(c,) for c in calls], "c string")
    described = plays.description(F.col("c"), F.lit("Undefined"), F.lit(0))
    assert result(df, described, plays.result_type(F.col("c"))) == [
        ("ball", None),
        ("called_strike", None),
        ("ball", "B"),
        ("foul", "S"),
    ]


def test_in_play_with_unknown_runs_falls_through(spark):
    df = ordered(spark, [("InPlay", "Single", None), ("InPlay", "HitByPitch", 0)], "c string, r string, n int")
    assert result(df, plays.description(*[F.col(c) for c in "crn"])) == [None, "hit_by_pitch"]


def test_unknown_code_hides_the_tracker_label(spark):
    df = ordered(spark, [("99", "Slider"), (None, "slider"), ("131", None), (None, None)], "c string, t string")
    kind = pitches.pitch_kind(F.col("c"), F.col("t"))
    assert result(df, kind, pitches.pitch_family(pitches.pitch_name(kind))) == [
        ("OT", "OT"),
        ("SL", "Breaking"),
        ("ST", "Breaking"),
        ("OT", "OT"),
    ]


def test_runners_and_counts(spark):
    df = ordered(spark, [(0, 0, 0), (5, 0, 9), (1, 2, 3), (0, None, 1)], "a int, b int, c int")
    assert result(df, pitches.runners(*[F.col(c) for c in "abc"])) == ["0", "13", "123", None]
    made = pitches.count_columns(F.col("b"), F.col("c"))
    assert result(df, made["count"], made["count_value"])[-1] == (None, None)


def test_taking_a_pitch_with_no_swing_flag(spark):
    df = ordered(spark, [(1, None), (1, 1), (8, None), (5, None)], "zone int, swing int")
    made = strike_zone.take_location(F.col("zone"), F.col("swing"))
    assert result(df, made["l_r"], made["h_l"]) == [
        ("Left_take", "High_take"),
        ("Not Specified", "Not Specified"),
        ("Not Specified", "Low_take"),
        ("Not Specified", "Not Specified"),
    ]


def test_speed_is_published_from_the_rounded_value(spark):
    df = spark.createDataFrame([(140.04,)], "relspeed double")
    mph = units.miles_per_hour(F.col("relspeed"))
    assert values(df.select(mph * units.KM_PER_MILE)) == [87.0 * 1.609344]


def test_dates_of_mixed_formats(spark):
    texts = ["2024-05-01", "20240501", "2024/5/1", "5/1/2024", "2024-05-01 19:30:00"]
    df = ordered(spark, [(t,) for t in texts], "d string")
    parsed = result(df, dates.game_date(F.col("d"), df.schema["d"].dataType))
    assert {d.date().isoformat() for d in parsed} == {"2024-05-01"}
    bad = spark.createDataFrame([("soon",)], "d string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.select(dates.game_date(F.col("d"), bad.schema["d"].dataType)).collect()


def test_ids_are_numbers_or_an_error(spark):
    df = ordered(spark, [("007",), ("",), (None,)], "t string")
    assert result(df, fact.numeric_id(F.col("t"))) == [7, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("x1",)], "t string").select(fact.numeric_id(F.col("t"))).collect()


def arm_rows(spark):
    # 125 rows of 4.92 and 2 of 5.00 feet: a mean of 625/127 feet is exactly 1.5 m.
    at_limit = [("aaa", 1, 4.92, "R")] * 125 + [("aaa", 1, 5.0, "L")] * 2
    above = [("aaa", 2, 4.93, None), ("aaa", 2, 4.93, "L")]
    unmeasured = [("aaa", 3, None, None)]
    other_league = [("npb", 1, 6.0, "R")]
    unknown = [("aaa", None, 1.0, "R")]
    return spark.createDataFrame(
        at_limit + above + unmeasured + other_league + unknown,
        "league string, pitcher bigint, release_pos_z double, p_throw string",
    ).withColumn("pitchuid", F.lit("p")).withColumns(
        {name: F.lit(1) for name in ("game_seq", "pit_seq", "pitchno")}
    )


def test_arm_slot(spark):
    slotted = arm_slot.add_arm_slot(arm_rows(spark))
    got = set(values(slotted.select("league", "pitcher", "p_type", "p_throws")))
    assert got == {
        ("aaa", 1, "S", "S"),
        ("aaa", 2, "R", "L"),
        ("aaa", 3, "R", None),
        ("npb", 1, "R", "R"),
        ("aaa", None, "R", None),
    }
    assert slotted.count() == arm_rows(spark).count()


def test_player_listed_twice_doubles_the_pitch(spark):
    pitch = spark.createDataFrame([("2024", "7", "7", None)], "game_year string, batterid string, pitcherid string, catcherid string")
    listed = [("2024", "7", "Kim", "180"), ("2024", "7", "Kim", "N/A"), ("2023", "7", "x", "1")]
    dimension = spark.createDataFrame(listed, "game_year string, tm_id string, name string, height string")
    assert players.add_players(pitch, dimension).count() == 4
