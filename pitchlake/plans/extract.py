"""Extract: league filter, pitch-level joins, decoded and converted columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pitchlake import schema
from pitchlake.functions import contact, dates, pitches, plays, units
from pitchlake.leagues import LEAGUES, League, leagues_extract
from pitchlake.operators.arm_slot import ARM_KEY, add_arm_slot
from pitchlake.operators.joins import DEFAULT_LIMITS, HotKeys, JoinLimits, hot_keys, measured_bytes, split_left_join
from pitchlake.operators.pitch_joins import LOG_KEY, TRACE_KEY, join_pitch_tables, trace_by_pitchno
from pitchlake.operators.players import PITCHER, ROLES, add_players, player_dimension
from pitchlake.session import settle, writing
from pitchlake.sources import Sources, layout


def play_columns() -> dict[str, Column]:
    """What happened on the pitch, from the pitch table alone."""
    result, call = F.col("playresult"), F.col("pitchcall")
    hit_type, distance = F.col("taggedhittype"), F.col("distance")
    return {
        "events": plays.event(result, call, F.col("korbb"), hit_type, distance),
        "description": plays.description(call, result, F.col("runsscored")),
        "type": plays.result_type(call),
        "bb_type": plays.batted_ball_type(call, hit_type),
        "stand": plays.hand(F.col("batterside")),
        "p_throw": plays.hand(F.col("pitcherthrows")),
    }


def contact_columns() -> dict[str, Column]:
    """Contact grade and field position; needs `exit_mph` and `ball_in_play`."""
    in_play, bearing = F.col("ball_in_play"), F.col("raw_bearing")
    return {
        "launch_speed_angle": contact.contact_grade(F.col("exit_mph"), F.col("angle"), in_play),
        "launch_direction": contact.spray_side(bearing),
        **contact.ground_position(F.col("distance"), bearing, in_play),
    }


def log_columns() -> dict[str, Column]:
    """Pitch name and base state, which need the operator's log."""
    return {
        "pitch_name": pitches.pitch_name(F.col("pitch_kind")),
        "runner": pitches.runners(*[F.col(f"before_b{b}_bat_turn_no") for b in (1, 2, 3)]),
    }


def measure_columns() -> dict[str, Column]:
    """Rounded measures, horizontal ones in the catcher's view."""
    imperial = units.imperial_columns()
    mirrored = {name: units.catcher_view(imperial[name]) for name in ("plate_x", "pfx_x")}
    return {**imperial, **mirrored}


def with_contact_inputs(rows: DataFrame) -> DataFrame:
    """Inputs of the contact columns, named once as several columns read them."""
    return rows.withColumns(
        {
            "exit_mph": contact.exit_speed_mph(F.col("exitspeed")),
            "ball_in_play": plays.in_play(F.col("pitchcall")),
            "raw_bearing": F.col("bearing"),
        }
    )


def pitch_kind_column() -> Column:
    return pitches.pitch_kind(F.col("pit_kind_cd"), F.col("autopitchtype"))


# Published name by source name, for columns that nothing on the way reads.
CARRIED = {
    "pitname": "pitcher",
    "batname": "batter",
    "pitch_number": "pitchofpa",
    **{
        name: name.lower()
        for name in (
            *"pitcherteam batterteam hometeam awayteam inning catcher gameuid".split(),
            *"BatSpeed VerticalAttackAngle HorizontalAttackAngle ZoneTime".split(),
            *schema.SPIN_AXIS_3D,
            *schema.PITCH_TRAJECTORY,
            *schema.HIT_TRAJECTORY,
        )
    },
}
SAMPLES = schema.X_SAMPLES + schema.Z_SAMPLES

# Columns that keep their source name.
KEPT = [
    *"gameid pitchno game_seq pit_seq level league game_year batterid pitcherid catcherid".split(),
    *"balls strikes field_if pitchuid carried path".split(),
]
RENAMED = {
    "home_score": "home_score_cn",
    "away_score": "away_score_cn",
    "hit_spin_rate": "hitspinrate",
}


def pack_pitches(pitches_: DataFrame) -> DataFrame:
    """Put the columns that are only carried along into one struct: a join or
    projection then copies them as one value instead of sixty."""
    fields = ", ".join(f"{source} AS `{name}`" for name, source in CARRIED.items())
    sources = set(CARRIED.values())
    return pitches_.select(
        *[name for name in pitches_.columns if name not in sources],
        F.expr(f"struct({fields})").alias("carried"),
    )


def pack_trace(trace: DataFrame) -> DataFrame:
    return trace.select("game_seq", "pitch_no", F.struct(*SAMPLES).alias("path"))


def unpack(rows: DataFrame) -> DataFrame:
    return rows.select("*", "carried.*", "path.*").drop("carried", "path")


def stage(joined: DataFrame, date_type: T.DataType, named: Sequence[str] = ()) -> DataFrame:
    """Project packed and joined pitches to published names; everything
    downstream reads only these. `named` are columns that have theirs already."""
    inputs = with_contact_inputs(joined).withColumns(
        {
            "league": F.lower("level"),
            "game_year": pitches.season(F.col("gameid")),
            "pitch_kind": pitch_kind_column(),
        }
    )
    columns = {
        "game_date": dates.game_date(F.col("date"), date_type),
        **{name: F.col(source) for name, source in RENAMED.items()},
        **play_columns(),
        **contact_columns(),
        **log_columns(),
        **measure_columns(),
    }
    return inputs.select(*KEPT, *named, *[column.alias(name) for name, column in columns.items()])


def numeric_id(text: Column) -> Column:
    """Id as a number; empty text is no id, other text is an error."""
    return F.nullif(F.trim(text), F.lit("")).cast("long")


def wanted_pitches(sources: Sources, leagues: tuple[League, ...] = LEAGUES) -> DataFrame:
    return sources.pitches.where(leagues_extract(leagues))


def of_games(
    pitches_: DataFrame, sides: dict[str, DataFrame], limits: JoinLimits, in_buckets: frozenset[str] = frozenset()
) -> list[DataFrame]:
    """Rows of the sides that belong to a game of the pitches. The games are
    settled, and broadcast where their measured size allows it. Where it does
    not, sides in buckets stay whole: the cut would shuffle them, the join does not."""
    games = settle(pitches_.select("game_seq").where("game_seq is not null").distinct())
    small = measured_bytes(games) <= limits.broadcast_bytes
    if small:
        games = F.broadcast(games)
    return [
        side.join(games, "game_seq", "left_semi") if small or name not in in_buckets else side
        for name, side in sides.items()
    ]


def wanted_sides(
    sources: Sources, leagues: tuple[League, ...] = LEAGUES, limits: JoinLimits = DEFAULT_LIMITS
) -> tuple[DataFrame, DataFrame]:
    """Log and trace. A run of some leagues cuts them down to their games before
    they are shuffled; a run of all leagues wants nearly every game and leaves
    them."""
    if len(leagues) == len(LEAGUES):
        return sources.pitch_log, sources.trace
    sides = {"pitch_log": sources.pitch_log, "trace": sources.trace}
    log, trace = of_games(wanted_pitches(sources, leagues), sides, limits, sources.in_buckets)
    return log, trace


def extract(
    sources: Sources,
    leagues: tuple[League, ...] = LEAGUES,
    limits: JoinLimits = DEFAULT_LIMITS,
    hot: dict[str, HotKeys] | None = None,
    sides: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Staged pitches of the leagues. The filter sits on the pitch table, below
    both joins, so it reaches the scan. `sides` gives log and trace where the
    caller has cut them already."""
    wanted = wanted_pitches(sources, leagues)
    log, trace = sides or wanted_sides(sources, leagues, limits)
    joined = join_pitch_tables(pack_pitches(wanted), log, pack_trace(trace), limits, hot)
    return stage(joined, sources.pitches.schema["date"].dataType)


# All that log, trace and player lookups are found by.
LOOKED_UP_BY = [*TRACE_KEY, "pit_seq", "game_year", *[role.id_column for role in ROLES]]


def extract_with_players(
    sources: Sources,
    leagues: tuple[League, ...],
    limits: JoinLimits,
    hot: dict[str, HotKeys],
    sides: tuple[DataFrame, DataFrame],
    size: int,
) -> DataFrame:
    """Staged pitches of the leagues with players; `size` is that of the player
    dimension.

    Lookups in a dimension beyond the broadcast limit would shuffle the wide
    pitches three times more. There the distinct keys of the pitches meet all
    sides instead, and the wide rows are shuffled once, to take what their keys
    have found; NULLs in a key count as equal for that. Where a side is in
    buckets or a key is hot, the joins are made one by one, as hot keys are
    split by each.
    """
    log, trace = sides
    wanted = wanted_pitches(sources, leagues)
    dimension = player_dimension(sources.players)
    one_by_one = (
        size <= limits.broadcast_bytes
        or sources.in_buckets
        or any(hot.values())
        or hot_keys(log, LOG_KEY, limits)
        or hot_keys(trace_by_pitchno(trace), TRACE_KEY, limits)
        or hot_keys(dimension, ["game_year", "tm_id"], limits)
    )
    if one_by_one:
        extracted = extract(sources, leagues, limits, hot, sides)
        return add_players(extracted, sources.players, limits=limits, size=size, hot=hot)
    wide = pack_pitches(wanted).withColumn("game_year", pitches.season(F.col("gameid")))
    keys = wanted.withColumn("game_year", pitches.season(F.col("gameid"))).select(*LOOKED_UP_BY).distinct()
    named = add_players(keys, sources.players, limits=limits, size=size, hot=hot)
    names = [name for name in named.columns if name not in LOOKED_UP_BY]
    found = join_pitch_tables(named, log, pack_trace(trace), limits, hot)
    key = F.struct(*LOOKED_UP_BY).alias("_key")
    found = found.select(key, *[name for name in found.columns if name not in LOOKED_UP_BY])
    joined = split_left_join(wide.select("*", key), found, ["_key"], grow_together=True).drop("_key")
    return stage(joined, sources.pitches.schema["date"].dataType, names)


def extract_in_files(
    sources: Sources,
    leagues: tuple[League, ...],
    limits: JoinLimits,
    hot: dict[str, HotKeys],
    sides: tuple[DataFrame, DataFrame],
    size: int,
    arms: DataFrame,
    bounds: DataFrame,
    files: int,
    folder: str,
    parts: Sequence[layout.Part],
) -> Iterator[DataFrame]:
    """Staged pitches of the leagues with players and arm slots, one partition for
    each file (see `sources.layout`), not in order yet: one part of the seasons
    after another, so that each can be written before the next is shuffled.

    The wide pitches are shuffled once, to their files. Before that, their
    distinct keys meet log and trace, and players and arms beyond the broadcast
    limit. What they have found is kept in `folder`, so that the shuffles of that
    are gone when the wide rows come, and follows to the same files, where it is
    joined without another shuffle. NULLs in a key count as equal for that. A key that log or trace join
    by must not be hot; hot players and arms are split among the narrow keys.
    """
    log, trace = sides
    many_players, many_arms = size > limits.broadcast_bytes, measured_bytes(arms) > limits.broadcast_bytes
    by_player = ["game_year", *[role.id_column for role in ROLES]] if many_players else []
    by_arm = ["level", PITCHER.id_column] if many_arms else []
    by = list(dict.fromkeys([*TRACE_KEY, "pit_seq", *by_player, *by_arm]))
    season = pitches.season(F.col("gameid"))
    wanted = wanted_pitches(sources, leagues).withColumn("game_year", season)
    order = [*dict.fromkeys([*layout.KEYS, *by])]
    keys = layout.with_file(wanted.select(*order), bounds, files, by).select(layout.FILE, *by).distinct()
    named = add_players(keys, sources.players, limits=limits, size=size, hot=hot) if many_players else keys
    if many_arms:
        league = {"league": F.lower("level"), "pitcher": numeric_id(F.col(PITCHER.id_column))}
        named = add_arm_slot(named.withColumns(league), limits, hot.get("arm"), arms=arms).drop(*ARM_KEY)
    names = [name for name in named.columns if name not in (layout.FILE, *by)]
    found = join_pitch_tables(named, log, pack_trace(trace), limits, hot)
    key = F.struct(*by).alias("_key")
    found = found.select(layout.FILE, key, *[name for name in found.columns if name not in (layout.FILE, *by)])
    found = found.withColumn("_part", layout.part_of(parts))
    with writing(found.sparkSession):
        found.write.partitionBy("_part").option("compression", "zstd").parquet(folder)
    found = found.sparkSession.read.schema(found.schema).parquet(folder)
    for k, part in enumerate(parts):
        rows = wanted.where(layout.of_part(parts, k)) if len(parts) > 1 else wanted
        wide = layout.with_file(pack_pitches(rows), bounds, files, by)
        wide = wide.select(key, *[name for name in wide.columns if name not in by])
        own = found.where(F.col("_part") == k).drop("_part")
        sides = [
            layout.gathered(side.withColumn(layout.FILE, F.col(layout.FILE) - part.first), part.files) for side in (wide, own)
        ]
        together = split_left_join(*sides, [layout.FILE, "_key"], grow_together=True)
        joined = together.select("*", "_key.*").drop("_key", layout.FILE)
        staged = stage(joined, sources.pitches.schema["date"].dataType, names)
        yield staged if many_players else add_players(staged, sources.players, limits=limits, size=size)
