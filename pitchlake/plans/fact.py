"""The pitch fact: players, arm slot, zones and flags on top of the extract."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from pitchlake.functions import flags, pitches, plays, strike_zone, units
from pitchlake.leagues import LEAGUES, League
from pitchlake.operators.arm_slot import ARM_KEY, add_arm_slot, pitcher_arms
from pitchlake.operators.joins import (
    DEFAULT_LIMITS,
    HotKeys,
    JoinLimits,
    hot_keys,
    hot_keys_by,
    measured_bytes,
)
from pitchlake.operators.pitch_joins import LOG_KEY, PITCH_KEYS, TRACE_KEY, trace_by_pitchno
from pitchlake.operators.players import ROLES, player_dimension, players_in_use
from pitchlake.plans.arms import weighed_pitches
from pitchlake.plans.extract import (
    extract_in_files,
    extract_with_players,
    numeric_id,
    unpack,
    wanted_pitches,
    wanted_sides,
)
from pitchlake.session import settle
from pitchlake.sources import Sources
from pitchlake.sources.layout import KEYS, FileLayout, Part, in_files
from pitchlake.sources.sinks import RowsInFiles, published, write_fact


def with_numeric_ids(staged: DataFrame) -> DataFrame:
    return staged.withColumns(
        {
            "batter": numeric_id(F.col("batterid")),
            "pitcher": numeric_id(F.col("pitcherid")),
            "catcherid": numeric_id(F.col("catcherid")),
            "game_year": F.col("game_year").cast("int"),
        }
    )


def with_zones(rows: DataFrame) -> DataFrame:
    """Strike-zone lines of the batter and the cells of the pitch. Needs Height,
    plate_x and plate_z."""
    x, z = F.col("plate_x"), F.col("plate_z")
    return (
        rows.withColumns(strike_zone.zone_limits(F.col("Height")))
        .withColumns(strike_zone.zone_lines(F.col("high"), F.col("low")))
        .withColumns({"in_out": strike_zone.in_out(x, z), "new_zone": strike_zone.core_zone(x, z)})
        .withColumn("zone", strike_zone.location_zone(x, z, F.col("in_out")))
    )


def in_play_copies() -> dict[str, Column]:
    """Batted-ball measures kept for balls in play only."""
    copied = {
        "exit_velocity": "exit_speed(km)",
        "launch_angleX": "launch_angle",
        "hit_spin": "hit_spin_rate",
        "hang_time": "HangTime",
        "hit_bearing": "bearing",
    }
    in_play = F.col("type") == "X"
    return {name: F.when(in_play, F.col(f"`{source}`")) for name, source in copied.items()}


def with_flags(rows: DataFrame) -> DataFrame:
    """Count, outcome and all indicator columns, in one projection: flags built on
    other flags take their expressions, which the generated code shares."""
    description, type_, zone = F.col("description"), F.col("type"), F.col("zone")
    counts = pitches.count_columns(F.col("balls"), F.col("strikes"))
    swings = flags.swing_flags(description)
    plays_ = flags.event_flags(F.col("events"), type_, description)
    taken = strike_zone.take_location(zone, swings["swing"])
    return rows.withColumns(
        {
            "DH": pitches.doubleheader_game(F.col("gameid")),
            "month": F.month("game_date"),
            "p_kind": pitches.pitch_family(F.col("pitch_name")),
            "ntype": plays.outcome(description),
            **counts,
            **flags.plate_appearance_flags(F.col("events")),
            **swings,
            **flags.zone_flags(zone),
            **flags.batted_ball_flags(F.col("bb_type")),
            **plays_,
            **flags.contact_flags(F.col("launch_speed_angle")),
            **flags.discipline_flags(zone, counts["count"], {**swings, **plays_}),
            **taken,
            **flags.take_flags(taken["l_r"], taken["h_l"]),
            **in_play_copies(),
        }
    )


def classified_only(rows: DataFrame) -> DataFrame:
    """Drop pitches of no known family."""
    return rows.where(F.col("p_kind") != pitches.UNCLASSIFIED)


def pitch_hot_keys(
    wanted: DataFrame, player_bytes: int, limits: JoinLimits = DEFAULT_LIMITS
) -> dict[str, HotKeys]:
    """Hot keys of the pitches for all joins of the fact, counted once, before
    any join. Lookups that are broadcast need none. Fan-out of earlier lookups
    is not counted; it changes the layout by that factor and no result."""
    keyed = wanted.select(
        "game_seq",
        "pit_seq",
        "pitchno",
        *[role.id_column for role in ROLES],
        pitches.season(F.col("gameid")).alias("game_year"),
        F.lower("level").alias("league"),
        numeric_id(F.col("pitcherid")).alias("pitcher"),
    )
    looked_up = {role.id_column: role.key for role in ROLES} | {"arm": ARM_KEY}
    shuffled = looked_up if player_bytes > limits.broadcast_bytes else {}
    return hot_keys_by(keyed, PITCH_KEYS | shuffled, limits)


def pitch_rows(
    sources: Sources,
    leagues: tuple[League, ...] = LEAGUES,
    limits: JoinLimits = DEFAULT_LIMITS,
    sides: tuple[DataFrame, DataFrame] | None = None,
    arms: DataFrame | None = None,
) -> DataFrame:
    """Derived rows: the published columns plus the game id and pitch number that
    order them. Arm slots are taken from the pitch table, before any join and
    before unclassified pitches are dropped, as those pitches count in a
    pitcher's mean; the wide tables are joined once. `sides` gives log and trace
    where the caller has cut them, `arms` the arm slots where it has them."""
    sources, size, hot, sides = _prepared(sources, leagues, limits, sides)
    named = extract_with_players(sources, leagues, limits, hot, sides, size)
    counted = weighed_pitches(sources, leagues, limits, sides, hot) if arms is None else None
    return _derived(add_arm_slot(with_numeric_ids(named), limits, hot.get("arm"), counted, arms))


def _prepared(
    sources: Sources, leagues: tuple[League, ...], limits: JoinLimits, sides: tuple[DataFrame, DataFrame] | None
) -> tuple[Sources, int, dict[str, HotKeys], tuple[DataFrame, DataFrame]]:
    """Sources with the players in use, the size of these, the hot keys of the
    pitches, and log and trace."""
    wanted = wanted_pitches(sources, leagues).withColumn("game_year", pitches.season(F.col("gameid")))
    sources = replace(sources, players=players_in_use(sources.players, wanted, limits=limits))
    size = measured_bytes(player_dimension(sources.players))
    hot = pitch_hot_keys(wanted_pitches(sources, leagues), size, limits)
    return sources, size, hot, sides or wanted_sides(sources, leagues, limits)


def _derived(slotted: DataFrame) -> DataFrame:
    measured = slotted.withColumns(units.metric_columns())
    return unpack(classified_only(with_flags(with_zones(measured))))


def rows_in_files(
    sources: Sources,
    leagues: tuple[League, ...] = LEAGUES,
    limits: JoinLimits = DEFAULT_LIMITS,
    sides: tuple[DataFrame, DataFrame] | None = None,
    arms: DataFrame | None = None,
) -> RowsInFiles:
    """The rows of `pitch_rows` for `write_fact`, laid into their files by the
    shuffle that joins them, before any column is derived: the wide rows are
    shuffled once, a part of the seasons after another. With a hot key of log or
    trace the joins are made first, and the derived rows are shuffled to their
    files, all at once."""

    def build(bounds: DataFrame, files: int, folder: str, parts: Sequence[Part]) -> Iterator[DataFrame]:
        used, size, hot, cut = _prepared(sources, leagues, limits, sides)
        log, trace = cut
        slots = arms
        if slots is None:
            slots = settle(pitcher_arms(weighed_pitches(used, leagues, limits, cut, hot)))
        by_trace = trace_by_pitchno(trace)
        if hot["log"] or hot["trace"] or hot_keys(log, LOG_KEY, limits) or hot_keys(by_trace, TRACE_KEY, limits):
            yield in_files(pitch_rows(used, leagues, limits, cut, slots), bounds, files)
            return
        for staged in extract_in_files(used, leagues, limits, hot, cut, size, slots, bounds, files, folder, parts):
            staged = with_numeric_ids(staged)
            slotted = staged if "p_type" in staged.columns else add_arm_slot(staged, limits, arms=slots)
            yield _derived(slotted).sortWithinPartitions(*KEYS)

    return build


def pitch_fact(
    sources: Sources,
    leagues: tuple[League, ...] = LEAGUES,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """The published fact, 198 columns. Building the plan runs its preparatory
    jobs: sizes, hot keys, games of a part of the leagues, arm table."""
    return published(pitch_rows(sources, leagues, limits))


def publish(
    sources: Sources,
    path: str,
    leagues: tuple[League, ...] = LEAGUES,
    limits: JoinLimits = DEFAULT_LIMITS,
    layout: FileLayout = FileLayout(),
) -> None:
    """Publish leagues in place of what is published of them; others stay. The
    files' ranges are sampled from the pitch table, two narrow scans of it."""
    levels = [league.level for league in leagues]
    write_fact(rows_in_files(sources, leagues, limits), path, levels, pitch_keys(sources, leagues), layout)


def pitch_keys(sources: Sources, leagues: tuple[League, ...] = LEAGUES) -> DataFrame:
    """What orders the fact, of every pitch of the leagues."""
    season = pitches.season(F.col("gameid")).alias("game_year")
    return wanted_pitches(sources, leagues).select("level", season, "gameid", "pitchno")
