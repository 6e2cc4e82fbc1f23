"""The league jobs as parameters: one extract rule, five sets of values."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class League:
    code: str
    level: str
    first_season: str
    excluded_games: tuple[str, ...] = ()
    # (first, last) bounds compared with the game id as text; last may be open.
    windows: tuple[tuple[str, str | None], ...] = ()


# Level names, season floors, excluded games, season windows.
AAA = League("AAA", "AAA", "2024")
KBO = League(
    "KBO",
    "KoreaBaseballOrganization",
    "2021",
    excluded_games=("20241001-Suwon-1",),
    windows=(
        ("20180401", "20181018"),
        ("20190323", "20191001"),
        ("20200504", "20201100"),
        ("20210402", "20211100"),
        ("20220401", "20221012"),
        ("20230401", "20231018"),
        ("20240323", "20241002"),
        ("20250321", "20251005"),
        ("20260327", None),
    ),
)
KBSA = League("KBSA", "KBSA", "2024")
MINOR = League("MINOR", "KBO Minors", "2021", excluded_games=("20241001-Suwon-1",))
NPB = League("NPB", "NPB", "2021")

LEAGUES: tuple[League, ...] = (AAA, KBO, KBSA, MINOR, NPB)


def season_floor(first_season: str) -> Column:
    """Seasons from `first_season` on.

    The season is the first four characters of the game id, so comparing the
    whole id with the floor selects the same games; written this way the bound
    is a plain column comparison that reaches the Parquet row-group statistics.
    """
    return F.col("gameid") >= first_season


def league_level(level: str) -> Column:
    """League match under a case-insensitive collation."""
    return F.lower("level") == level.lower()


def without_games(games: tuple[str, ...]) -> Column:
    return ~F.lower("gameid").isin([game.lower() for game in games])


def in_windows(windows: tuple[tuple[str, str | None], ...]) -> Column:
    """Regular-season windows. The id carries a suffix after the date, so games
    played on a closing date sort after that date and stay outside."""
    game = F.col("gameid")
    return reduce(
        or_,
        [(game >= first) & (game <= last) if last else game >= first for first, last in windows],
    )


def league_extract(league: League) -> Column:
    wanted = season_floor(league.first_season) & league_level(league.level)
    if league.excluded_games:
        wanted = wanted & without_games(league.excluded_games)
    if league.windows:
        wanted = wanted & in_windows(league.windows)
    return wanted


def leagues_extract(leagues: tuple[League, ...]) -> Column:
    """One predicate for several leagues. The lowest floor is repeated as a
    conjunct of its own, as an OR over leagues alone cannot be pushed to a scan."""
    any_league = reduce(or_, [league_extract(league) for league in leagues])
    return season_floor(min(league.first_season for league in leagues)) & any_league
