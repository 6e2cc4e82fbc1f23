"""Player lookups: one player-season dimension in three roles."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from pitchlake.functions.strike_zone import clean_height
from pitchlake.operators.joins import (
    DEFAULT_LIMITS,
    HotKeys,
    JoinLimits,
    hot_keys,
    hot_keys_by,
    lookup,
    measured_bytes,
)
from pitchlake.session import settle


@dataclass(frozen=True)
class Role:
    id_column: str
    name_column: str
    with_height: bool = False

    @property
    def key(self) -> list[str]:
        return ["game_year", self.id_column]


# Roles and the columns they fill.
BATTER = Role("batterid", "NAME_batter", with_height=True)
PITCHER = Role("pitcherid", "NAME_pitcher")
CATCHER = Role("catcherid", "NAME_catcher")
ROLES = (BATTER, PITCHER, CATCHER)


def player_dimension(players: DataFrame) -> DataFrame:
    return players.select(
        "game_year", "tm_id", "name", clean_height(F.col("height")).alias("Height")
    ).where(F.col("game_year").isNotNull() & F.col("tm_id").isNotNull())


def players_in_use(
    players: DataFrame,
    pitches: DataFrame,
    roles: tuple[Role, ...] = ROLES,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """The player table, cut to the seasons and ids that a role of the pitches
    names where it is too large for a broadcast whole; of an archive of all
    players, a run of a league mostly wants few. Needs `game_year` as text.

    The ids of all roles come from one narrow scan and are made distinct within
    each task before their shuffle. The cut table settles, as it is measured and
    then read by every lookup.
    """
    if measured_bytes(player_dimension(players)) <= limits.broadcast_bytes:
        return players
    ids = F.array(*[F.col(role.id_column) for role in roles])
    named = pitches.select("game_year", F.explode(ids).alias("tm_id")).where("tm_id is not null").distinct()
    return settle(players.join(named, ["game_year", "tm_id"], "left_semi"))


def add_players(
    pitches: DataFrame,
    players: DataFrame,
    roles: tuple[Role, ...] = ROLES,
    limits: JoinLimits = DEFAULT_LIMITS,
    size: int | None = None,
    hot: dict[str, HotKeys] | None = None,
) -> DataFrame:
    """Left lookups on (season, id). A player listed twice in a season doubles
    the pitch, once per role; nothing is deduplicated. Needs `game_year` as text.
    `size` (of the dimension) and `hot` (keys of the pitches, by id column) are
    measured here unless given.
    """
    dimension = player_dimension(players)
    size = measured_bytes(dimension) if size is None else size
    side_keys = None
    if size > limits.broadcast_bytes:
        hot = hot or hot_keys_by(pitches, {role.id_column: role.key for role in roles}, limits)
        side_keys = hot_keys(dimension, ["game_year", "tm_id"], limits)
    for role in roles:
        side = dimension.select(
            "game_year",
            F.col("tm_id").alias(role.id_column),
            F.col("name").alias(role.name_column),
            *(["Height"] if role.with_height else []),
        )
        if side_keys is None:
            pitches = lookup(pitches, side, role.key, size, limits)
        else:
            own = side_keys.table and side_keys.table.withColumnRenamed("tm_id", role.id_column)
            pitches = lookup(
                pitches, side, role.key, size, limits, hot[role.id_column], replace(side_keys, table=own)
            )
    return pitches
