"""One query per operator, over the whole source tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.fixtures import sources as fixture_sources
from pitchlake import leagues as lg, schema
from pitchlake.functions import dates, flags, pitches, plays, strike_zone, units
from pitchlake.operators import arm_slot, joins, pitch_joins, players
from pitchlake.plans import arms, changes, extract as ex, fact
from pitchlake.session import scratch_path
from pitchlake.sources import Sources, bucket_landed, land_sources, read_fact, read_parquet

Query = Callable[[SparkSession, str], DataFrame]

KEY = ["game_seq", "pit_seq"]
PITCH_ID = ["level", "gameid", *KEY]


def _over(build: Callable[[Sources], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(fixture_sources(spark, sf_dir))


def _keyed(df: DataFrame, columns: dict) -> DataFrame:
    return df.select(*KEY, *[column.alias(name) for name, column in columns.items()])


# --- shared inputs, each with no more joins than its queries need -----------


def _logged(s: Sources) -> DataFrame:
    return pitch_joins.join_pitch_log(s.pitches, s.pitch_log, *_hot(s.pitches, s.pitch_log, pitch_joins.LOG_KEY))


def _traced(pitches_: DataFrame, trace: DataFrame) -> DataFrame:
    hot = _hot(pitches_, pitch_joins.trace_by_pitchno(trace), pitch_joins.TRACE_KEY)
    return pitch_joins.join_trace(pitches_, trace, *hot)


def _hot(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple:
    """Hot keys of both sides, as the engine's own path finds them."""
    return joins.hot_keys(left, keys), joins.hot_keys(right, keys)


def _played(s: Sources) -> DataFrame:
    """Pitches with play, contact and measure columns."""
    named = ex.with_contact_inputs(s.pitches)
    columns = {**ex.play_columns(), **ex.contact_columns(), **ex.measure_columns()}
    kept = {name: F.col(name) for name in (*KEY, "gameid", "batterid", "balls", "strikes")}
    kept |= {
        "game_year": pitches.season(F.col("gameid")),
        "hit_spin_rate": F.col("hitspinrate"),
        "game_date": dates.game_date(F.col("date"), s.pitches.schema["date"].dataType),
        # The pitch name needs the log and no flag reads it.
        "pitch_name": F.lit(None).cast("string"),
    }
    return named.select(*[c.alias(name) for name, c in {**kept, **columns}.items()])


def _batted(s: Sources) -> DataFrame:
    batters = players.add_players(_played(s), s.players, roles=(players.BATTER,))
    return batters.withColumns(units.metric_columns())


def _zoned(s: Sources) -> DataFrame:
    return fact.with_zones(_batted(s))


def _flagged(s: Sources) -> DataFrame:
    return fact.with_flags(_zoned(s))


def _role(role: players.Role) -> Query:
    def build(s: Sources) -> DataFrame:
        by_season = s.pitches.select(
            *KEY, role.id_column, pitches.season(F.col("gameid")).alias("game_year")
        )
        added = players.add_players(by_season, s.players, roles=(role,))
        heights = ["Height"] if role.with_height else []
        return added.select(*KEY, role.name_column, *heights)

    return _over(build)


def _filtered(condition) -> Query:
    return _over(lambda s: s.pitches.where(condition()).select(*PITCH_ID))


def _pick(frame: Callable[[Sources], DataFrame], *names: str) -> Query:
    return _over(lambda s: frame(s).select(*KEY, *[f"`{name}`" for name in names]))


def _extracted(s: Sources) -> DataFrame:
    """All leagues with players and numeric ids, before unclassified pitches go."""
    size = joins.measured_bytes(players.player_dimension(s.players))
    hot = fact.pitch_hot_keys(ex.wanted_pitches(s), size)  # before the joins, which would be made once more for them
    return fact.with_numeric_ids(players.add_players(ex.extract(s, hot=hot), s.players, size=size, hot=hot))


def _heights(s: Sources) -> DataFrame:
    return arm_slot.release_heights(arms.weighed_pitches(s))


def _roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "fact")
    fact.publish(fixture_sources(spark, sf_dir), path)
    return read_fact(spark, path)


def _one_league_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish all leagues, one of them again, and read all."""
    path = scratch_path(spark, "fact")
    sources = fixture_sources(spark, sf_dir)
    fact.publish(sources, path)
    fact.publish(sources, path, (lg.KBSA,))
    return read_fact(spark, path)


def _from_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both pitch joins with log and trace read from their buckets."""
    folder = scratch_path(spark, "landed")
    land_sources(fixture_sources(spark, sf_dir), folder)
    bucket_landed(spark, folder)
    rows = ex.unpack(_staged(read_parquet(spark, folder)))
    return rows.select(*KEY, "pitch_name", "runner", *ex.SAMPLES)


def _changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the leagues as they were before one game's log changed, then what
    changed since, and read all."""
    path, sources = scratch_path(spark, "fact"), fixture_sources(spark, sf_dir)
    last = sources.pitch_log.agg(F.max("game_seq")).first()[0]
    unknown = F.when(F.col("game_seq") == last, F.lit(None)).otherwise(F.col("pit_kind_cd"))
    before = replace(sources, pitch_log=sources.pitch_log.withColumn("pit_kind_cd", unknown))
    changes.publish_changes(before, path)
    changes.publish_changes(sources, path)
    return read_fact(spark, path)


def _fact(*leagues: lg.League) -> Query:
    return _over(lambda s: fact.pitch_fact(s, leagues))


# Names only: the queries are listed before there is a session to make columns in.
MEASURES = [
    *"release_speed release_pos_x release_pos_z pfx_x pfx_z plate_x plate_z".split(),
    *"hit_distance_sc launch_speed launch_angle HangTime bearing release_spin_rate".split(),
    *"release_spin_axis release_extension contactX contactY contactZ".split(),
]
METRICS = [
    *"rel_height rel_side hor_break ver_break rel_speed(km) exit_speed(km)".split(),
    *"extension hit_distance".split(),
]
IN_PLAY = "exit_velocity launch_angleX hit_spin hang_time hit_bearing".split()
TRAJECTORIES = ["ZoneTime", *schema.PITCH_TRAJECTORY, *schema.HIT_TRAJECTORY]
PASSED = [
    *"pitname batname pitcherteam batterteam hometeam awayteam inning catcher".split(),
    *"home_score away_score field_if level pitch_number hit_spin_rate BatSpeed".split(),
    *"VerticalAttackAngle HorizontalAttackAngle gameuid pitchuid".split(),
    *schema.SPIN_AXIS_3D,
]


def _staged(s: Sources) -> DataFrame:
    joined = pitch_joins.join_pitch_tables(
        ex.pack_pitches(s.pitches), s.pitch_log, ex.pack_trace(s.trace)
    )
    return ex.stage(joined, s.pitches.schema["date"].dataType)


def queries() -> dict[str, Query]:
    return {
        # sources and sinks
        "scan_pitches": _over(lambda s: s.pitches),
        "scan_pitch_log": _over(lambda s: s.pitch_log),
        "scan_trace": _over(lambda s: s.trace),
        "scan_players": _over(lambda s: s.players),
        "sink_roundtrip": _roundtrip,
        "publish_one_league": _one_league_again,
        "publish_changes": _changed,
        "land_in_buckets": _from_buckets,
        # filters
        "filter_season": _filtered(lambda: lg.season_floor("2024")),
        "filter_league": _filtered(lambda: lg.league_level("KBO Minors")),
        "filter_exclude_game": _filtered(lambda: lg.without_games(lg.KBO.excluded_games)),
        "filter_season_windows": _filtered(lambda: lg.in_windows(lg.KBO.windows)),
        "filter_drop_ot": _over(
            lambda s: fact.classified_only(
                _logged(s)
                .withColumn("pitch_name", pitches.pitch_name(ex.pitch_kind_column()))
                .withColumn("p_kind", pitches.pitch_family(F.col("pitch_name")))
            ).select(*KEY, "pitch_name", "p_kind")
        ),
        "league_all": _filtered(lambda: lg.leagues_extract(lg.LEAGUES)),
        # joins
        "join_pitch_log": _over(
            lambda s: _logged(s).select(*[c for c in schema.PITCH_LOG_COLUMNS])
        ),
        "join_trace": _over(
            lambda s: _traced(s.pitches.select("game_seq", "pitchno"), s.trace)
        ),
        "join_batter": _role(players.BATTER),
        "join_pitcher": _role(players.PITCHER),
        "join_catcher": _role(players.CATCHER),
        # aggregates and order
        "agg_release_height": _over(
            lambda s: _heights(s).select("league", "pitcher", "mean_rel_height")
        ),
        "agg_side_arm_pitchers": _over(lambda s: arm_slot.side_arm_pitchers(arms.weighed_pitches(s))),
        "agg_pitcher_hand": _over(
            lambda s: arm_slot.pitcher_arms(arms.weighed_pitches(s)).drop("side_arm")
        ),
        "pitcher_arm_slot": _over(
            lambda s: arm_slot.add_arm_slot(_extracted(s), counted=arms.weighed_pitches(s)).select(
                *KEY, "level", "pitcher", "p_type", "p_throws"
            )
        ),
        "sort_game_pitch": _over(
            lambda s: s.pitches.select("gameid", "pitchno", *KEY).orderBy("gameid", "pitchno", *KEY)
        ),
        # pitch and play labels
        "parse_game_id": _over(
            lambda s: s.pitches.select(
                *KEY,
                "gameid",
                pitches.season(F.col("gameid")).cast("int").alias("game_year"),
                pitches.doubleheader_game(F.col("gameid")).alias("DH"),
            )
        ),
        "decode_pitch_kind": _over(
            lambda s: _keyed(_logged(s), {"pitch_kind": ex.pitch_kind_column()})
        ),
        "pitch_name": _over(
            lambda s: _logged(s)
            .select(*KEY, ex.pitch_kind_column().alias("pitch_kind"))
            .withColumn("pitch_name", pitches.pitch_name(F.col("pitch_kind")))
        ),
        "pitch_family": _over(
            lambda s: _logged(s)
            .select(*KEY, pitches.pitch_name(ex.pitch_kind_column()).alias("pitch_name"))
            .withColumn("p_kind", pitches.pitch_family(F.col("pitch_name")))
        ),
        "runner_state": _over(
            lambda s: _logged(s)
            .withColumn("pitch_kind", ex.pitch_kind_column())
            .select(*KEY, ex.log_columns()["runner"].alias("runner"))
        ),
        "count_state": _pick(_flagged, "balls", "strikes", "count", "count_value"),
        "classify_event": _pick(_played, "events"),
        "classify_description": _pick(_played, "description"),
        "pitch_result_type": _pick(_played, "type"),
        "batted_ball_type": _pick(_played, "bb_type"),
        "pitch_outcome_type": _pick(_flagged, "description", "ntype"),
        "handedness": _pick(_played, "stand", "p_throw"),
        # measures
        "unit_conversions": _pick(_played, *MEASURES),
        "catcher_view_flip": _pick(_played, "plate_x", "pfx_x"),
        "metric_columns": _pick(_batted, *METRICS),
        "launch_speed_angle": _pick(_played, "launch_speed_angle"),
        "spray_direction": _pick(_played, "launch_direction"),
        "spray_coordinates": _pick(_played, "groundX", "groundY"),
        "inplay_metrics": _pick(_flagged, *IN_PLAY),
        "date_parts": _over(
            lambda s: _played(s)
            .select(*KEY, "game_date")
            .withColumn("month", F.month("game_date"))
        ),
        "numeric_ids": _over(
            lambda s: fact.with_numeric_ids(_staged(s)).select(
                *KEY, "batter", "pitcher", "catcherid", "groundX", "groundY", "game_year"
            )
        ),
        "passthrough": _pick(lambda s: ex.unpack(_staged(s)), *PASSED),
        "trajectory_passthrough": _over(
            lambda s: ex.pack_pitches(s.pitches).select(
                *KEY, *[f"carried.{name}" for name in TRAJECTORIES]
            )
        ),
        "trace_passthrough": _over(
            lambda s: _traced(
                s.pitches.select(*KEY, "pitchno"), ex.pack_trace(s.trace)
            ).select(*KEY, "path.*")
        ),
        # strike zone
        "strike_zone_bounds": _pick(
            _zoned, *"Height high low 1/3 2/3 zonehigh corehigh corelow zonelow".split()
        ),
        "zone_in_out": _pick(_zoned, "in_out"),
        "zone_13": _pick(_zoned, "zone"),
        "zone_core_shadow": _pick(_zoned, "new_zone"),
        "take_location": _pick(
            _flagged, "l_r", "h_l", "Left_take", "Right_take", "High_take", "Low_take"
        ),
        # flags
        "flags_plate_appearance": _pick(_flagged, "pa", "ab", "hit"),
        "flags_swing": _pick(_flagged, "swing", "con", "whiff", "foul", "looking"),
        "flags_zone": _pick(_flagged, *"z_in z_out z_left z_right z_high z_low".split()),
        "flags_batted_ball": _pick(_flagged, *flags.BATTED_BALL_FLAGS),
        "flags_event": _pick(_flagged, *flags.EVENT_FLAGS, "inplay", "cs", "S"),
        "flags_contact_quality": _pick(_flagged, *flags.CONTACT_GRADE_FLAGS, "plus_lsa4"),
        "flags_discipline": _pick(
            _flagged,
            *"z_swing z_con z_inplay o_swing o_con o_inplay f_swing f_pitch z_str_swing".split(),
        ),
        # whole jobs
        "pitch_fact": _fact(*lg.LEAGUES),
        "pitch_fact_aaa": _fact(lg.AAA),
        "pitch_fact_kbo": _fact(lg.KBO),
        "pitch_fact_kbsa": _fact(lg.KBSA),
        "pitch_fact_minor": _fact(lg.MINOR),
        "pitch_fact_npb": _fact(lg.NPB),
    }
