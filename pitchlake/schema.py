"""Column contracts: the four sources, by name, and the published pitch fact."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Families of numbered column names.
TRACE_STEPS = range(0, 51, 5)
X_SAMPLES = [f"x{t}" for t in TRACE_STEPS]
Z_SAMPLES = [f"z{t}" for t in TRACE_STEPS]
PITCH_TRAJECTORY = [f"PitchTrajectory{axis}c{k}" for axis in "XYZ" for k in range(3)]
HIT_TRAJECTORY = [f"HitTrajectory{axis}c{k}" for axis in "XYZ" for k in range(9)]
SPIN_AXIS_3D = [
    "SpinAxis3dTransverseAngle",
    "SpinAxis3dLongitudinalAngle",
    "SpinAxis3dActiveSpinRate",
    "SpinAxis3dSpinEfficiency",
]


def _fields(type_name: str, names: str | list[str]) -> dict[str, str]:
    names = names.split() if isinstance(names, str) else names
    return {name.lower(): type_name for name in names}


# One row per tracked pitch. `date` is absent here on purpose: it may arrive as
# a date, a timestamp or text and is passed through as it is.
PITCH_COLUMNS: dict[str, str] = {
    **_fields("bigint", "game_seq"),
    **_fields("int", "pit_seq pitchno"),
    **_fields("string", "gameid level pitcherid batterid catcherid pitcher batter catcher"),
    **_fields("string", "pitcherteam batterteam hometeam awayteam batterside pitcherthrows"),
    **_fields("double", "relspeed relside relheight extension horzbreak inducedvertbreak"),
    **_fields("double", "platelocside platelocheight spinrate spinaxis"),
    **_fields("string", "pitchcall playresult korbb taggedhittype autopitchtype"),
    **_fields("double", "distance exitspeed angle bearing hangtime"),
    **_fields("double", "contactpositionx contactpositiony contactpositionz hitspinrate"),
    **_fields("double", "batspeed verticalattackangle horizontalattackangle"),
    **_fields("int", "runsscored balls strikes outs inning"),
    **_fields("string", "top_bottom"),
    **_fields("int", "pitchofpa paofinning"),
    **_fields("double", "vertrelangle zonetime"),
    **_fields("double", PITCH_TRAJECTORY),
    **_fields("double", HIT_TRAJECTORY),
    **_fields("string", "gameuid pitchuid"),
    **_fields("double", SPIN_AXIS_3D),
}

# One row per pitch in the operator's log, key (game_seq, pit_seq).
PITCH_LOG_COLUMNS: dict[str, str] = {
    **_fields("bigint", "game_seq"),
    **_fields("int", "pit_seq"),
    **_fields("string", "pit_kind_cd"),
    **_fields("int", "before_b1_bat_turn_no before_b2_bat_turn_no before_b3_bat_turn_no"),
    **_fields("int", "home_score_cn away_score_cn"),
    **_fields("string", "field_if"),
}

# One row per pitch with its sampled flight path, key (game_seq, pitch_no).
TRACE_COLUMNS: dict[str, str] = {
    **_fields("bigint", "game_seq"),
    **_fields("int", "pitch_no"),
    **_fields("double", X_SAMPLES),
    **_fields("double", Z_SAMPLES),
}

# Player x season, key (game_year, tm_id), not unique: a player who moves during
# a season has one row per club. Height is dirty text.
PLAYER_COLUMNS: dict[str, str] = _fields("string", "game_year tm_id name height")


def conform(df: DataFrame, columns: dict[str, str], passthrough: tuple[str, ...] = ()) -> DataFrame:
    """Bind a source by column name (never by position) to its declared types."""
    present = {name.lower() for name in df.columns}
    missing = [name for name in (*columns, *passthrough) if name not in present]
    if missing:
        raise ValueError(f"source lacks columns: {', '.join(missing)}")
    typed = [f"cast({name} as {type_name}) as {name}" for name, type_name in columns.items()]
    return df.selectExpr(*typed, *passthrough)


# The published columns, in published order. Names such as
# `rel_speed(km)` and `1/3` are quoted where they are used.
OUTPUT_COLUMNS: list[str] = [
    *"game_year game_date inning hometeam home_score awayteam away_score".split(),
    *"pitch_number balls strikes zone new_zone stand p_throw p_throws p_type type".split(),
    *"bb_type events description hor_break ver_break plate_x plate_z".split(),
    *"pitcherteam pitname pitcher catcher runner batterteam batname batter".split(),
    *"rel_speed(km) release_spin_rate release_spin_axis rel_height rel_side extension".split(),
    *"pitch_name p_kind".split(),
    *"exit_speed(km) launch_angle HangTime bearing launch_direction hit_distance".split(),
    *"hit_spin_rate BatSpeed VerticalAttackAngle HorizontalAttackAngle".split(),
    *"launch_speed_angle contactX contactY contactZ groundX groundY l_r h_l".split(),
    *"pa ab hit swing con whiff foul z_in z_out count count_value".split(),
    *"z_left z_right z_high z_low ld fb gb pu".split(),
    *"single double triple home_run walk strkeout hit_by_pitch sac_fly sac_bunt".split(),
    *"field_out inplay weak topped under flare solid_contact barrel plus_lsa4".split(),
    *"level DH cs Height high low 2/3 1/3 zonehigh corehigh corelow zonelow".split(),
    "field_if",
    *X_SAMPLES,
    *Z_SAMPLES,
    *"gameuid pitchuid".split(),
    *SPIN_AXIS_3D,
    "ZoneTime",
    *PITCH_TRAJECTORY,
    *HIT_TRAJECTORY,
    *"NAME_batter NAME_pitcher NAME_catcher".split(),
    *"ntype z_swing z_con z_inplay o_swing o_con o_inplay f_swing f_pitch".split(),
    *"z_str_swing exit_velocity launch_angleX hit_spin hang_time hit_bearing S".split(),
    *"Left_take Right_take High_take Low_take looking month".split(),
]
