"""The four source tables, derived from the driver's tables.

Expressions are plain SQL with one meaning in Spark and DuckDB, so each is
written once: Spark selects them, the oracle inlines them as CTEs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pitchlake import schema
from pitchlake.schema import HIT_TRAJECTORY, PITCH_TRAJECTORY, TRACE_STEPS
from checks.session import name_shared_folder
from pitchlake.session import scratch_path
from pitchlake.sources import Sources, land_sources, read_parquet

# Multipliers of the number lanes, modulus 2147483647.
LANES = {
    "a": 16807,
    "b": 48271,
    "c": 69621,
    "d": 39373,
    "e": 41358,
    "f": 44530,
    "g": 62089911,
    "i": 742938285,
    "j": 950706376,
    "k": 1226874159,
    "m": 1343714438,
    "n": 630360016,
    "p": 397204094,
    "q": 764261123,
}

HASH = "(l_orderkey*7919 + l_linenumber*104729 + pk*31 + sk*17) % 2147483647"
BASE = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "pk": "pk",
    "sk": "sk",
    "ck": "ck",
    # The hash is reduced first, which leaves every lane as it is and keeps the
    # products inside a long at any scale.
    **{f"u{lane}": f"({HASH}) * {m} % 2147483647" for lane, m in LANES.items()},
    "season": "2020 + l_orderkey % 7",
    "mm": "lpad(cast(month(od) as string),2,'0')",
    "dd": "lpad(cast(least(day(od),28) as string),2,'0')",
    "inplay": f"(({HASH}) * {LANES['f']} % 2147483647) % 14 >= 11",
}

CALLS = [
    "FoulBall",
    "FoulballFieldable",
    "FoulBallNotFieldable",
    "BallCalled",
    "BallinDirt",
    "AutomaticBall",
    "StrikeCalled",
    "StrikeAutomatic",
    "StrikeSwinging",
    "HitByPitch",
    "BallIntentional",
    "inplay",
]
RESULTS = ["Out", "FieldersChoice", "Error", "Single", "Double", "Triple", "HomeRun"]
HIT_TYPES = ["GroundBall", "LineDrive", "FlyBall", "Popup"]
AUTO_TYPES = [
    "Fastball",
    "Four-Seam",
    "Sinker",
    "Curveball",
    "Slider",
    "Changeup",
    "Splitter",
    "Cutter",
    "Sweeper",
]
LEVELS = ["AAA", "KoreaBaseballOrganization", "KBO Minors", "KBSA"]
PITCH_CODES = ["31", "32", "33", "34", "35", "36", "37", "38", "131", "99"]


def _pick(expression: str, labels: list[str], otherwise: str | None) -> str:
    arms = " ".join(f"when {i} then '{label}'" for i, label in enumerate(labels))
    last = f" else '{otherwise}'" if otherwise else ""
    return f"case {expression} {arms}{last} end"


def _in_play(expression: str, also: str = "") -> str:
    return f"case when inplay{also} then {expression} end"


def _coefficients(names: list[str], wrap) -> dict[str, str]:
    def one(name: str) -> str:
        axis, k = name[-3].lower(), name[-1]
        return wrap(f"(ua%({1009 + 'xyz'.index(axis) * 10 + int(k)}))/100e0")

    return {name.lower(): one(name) for name in names}


# Not the number in the log, so that a join on the wrong one shows.
PITCH_NO = "cast(l_linenumber + l_orderkey%4 as int)"
PITCH = {
    "game_seq": "l_orderkey",
    "pit_seq": "l_linenumber",
    "pitchno": PITCH_NO,
    "gameid": "cast(season as string)||mm||dd||'-'||"
    + _pick("l_orderkey%3", ["Suwon", "Jamsil"], "Gwangju")
    + "||'-'||cast(1+l_orderkey%2 as string)",
    "game_date_text": "cast(season as string)||'-'||mm||'-'||dd",
    "level": _pick("ck%5", LEVELS, "NPB"),
    "pitcherid": "cast(sk as string)",
    "batterid": "cast(pk as string)",
    "catcherid": "case when ua%50=0 then null else cast(ck as string) end",
    "pitcher": "'P'||cast(sk as string)",
    "batter": "'B'||cast(pk as string)",
    "catcher": "'C'||cast(ck as string)",
    "pitcherteam": "'T'||cast(sk%10 as string)",
    "batterteam": "'T'||cast(pk%10 as string)",
    "hometeam": "'T'||cast(l_orderkey%10 as string)",
    "awayteam": "'T'||cast((l_orderkey+3)%10 as string)",
    "batterside": "case when pk%53=0 then 'Undefined' when pk%2=0 then 'Right' else 'LEFT' end",
    "pitcherthrows": "case when sk%4=0 then 'Left' else 'Right' end",
    "relspeed": "case when ub%40=0 then null else (11001+ub%5000)/100e0 end",
    "relside": "(un%3000*10-14997)/10000e0",
    "relheight": "case when sk%9=0 then (9001+uc%5000)/10000e0 else (14001+uc%6000)/10000e0 end",
    "extension": "(15003+un%600*10)/10000e0",
    "horzbreak": "(up%80001-40000)/1000e0",
    "inducedvertbreak": "(uq%90001-30000)/1000e0",
    "platelocside": "(ud%14001-7000)/10000e0",
    "platelocheight": "case when ue%60=0 then null else (ue%16001)/10000e0 end",
    "spinrate": "(uj%20000*10+10003)/10e0",
    "spinaxis": "(uk%36000*10+3)/1000e0",
    "pitchcall": _pick("uf%14", CALLS, "InPlay"),
    "playresult": "case when inplay then "
    + _pick("ug%9", RESULTS, "Sacrifice")
    + " when uf%14=3 and ug%4=0 then 'Walk' else 'Undefined' end",
    "korbb": "case when uf%14 in (6,8) and ug%3=0 then 'Strikeout'"
    " when uf%14 in (4,5) and ug%3=0 then 'Walk' else 'Undefined' end",
    "taggedhittype": "case when inplay then "
    + _pick("ui%5", HIT_TYPES, "Bunt")
    + " else 'Undefined' end",
    "autopitchtype": _pick("uq%10", AUTO_TYPES, "Other"),
    "distance": _in_play("(10003+uj%140000*10)/10000e0", " and ui%7<>0"),
    "exitspeed": _in_play("(600003+uk%130000*10)/10000e0"),
    "angle": _in_play("(um%120000*10-399997)/10000e0"),
    "bearing": _in_play("(ua%90000*10-449997)/10000e0"),
    "hangtime": _in_play("(uk%6000*10+3)/10000e0"),
    "contactpositionx": _in_play("(up%3000*10-14997)/10000e0"),
    "contactpositiony": _in_play("(uq%3000*10-14997)/10000e0"),
    "contactpositionz": _in_play("(un%2000*10+3)/10000e0"),
    "hitspinrate": _in_play("(ug%40000)/10e0"),
    "batspeed": _in_play("(900+up%500)/10e0", " and ui%3=0"),
    "verticalattackangle": _in_play("(uq%400-100)/10e0", " and ui%3=0"),
    "horizontalattackangle": _in_play("(un%600-300)/10e0", " and ui%3=0"),
    "runsscored": "case when inplay and ub%4=0 then 1 else 0 end",
    "balls": "cast(uc%4 as int)",
    "strikes": "cast(ud%3 as int)",
    "outs": "cast(ue%3 as int)",
    "inning": "cast(1+ug%9 as int)",
    "top_bottom": "case when ui%2=0 then 'Top' else 'Bottom' end",
    "pitchofpa": "cast(1+un%8 as int)",
    "paofinning": "cast(1+up%6 as int)",
    "vertrelangle": "(uq%600-400)/100e0",
    "zonetime": "(350+ua%150)/1000e0",
    "gameuid": "'g'||cast(l_orderkey as string)",
    "pitchuid": "'p'||cast(l_orderkey as string)||'-'||cast(l_linenumber as string)",
    "spinaxis3dtransverseangle": "(ua%3600)/10e0",
    "spinaxis3dlongitudinalangle": "(ub%3600)/10e0",
    "spinaxis3dactivespinrate": "(uc%25000)/10e0",
    "spinaxis3dspinefficiency": "(ud%1001)/1000e0",
    **_coefficients(PITCH_TRAJECTORY, lambda expression: expression),
    **_coefficients(HIT_TRAJECTORY, _in_play),
}

PITCH_LOG = {
    "game_seq": "l_orderkey",
    "pit_seq": "l_linenumber",
    "pit_kind_cd": _pick("(l_orderkey+l_linenumber*5)%12", PITCH_CODES, None),
    "before_b1_bat_turn_no": "cast(l_orderkey%3 as int)",
    "before_b2_bat_turn_no": "cast(l_orderkey%4 as int)",
    "before_b3_bat_turn_no": "case when l_orderkey%101=0 then null else l_linenumber%2 end",
    "home_score_cn": "cast(l_orderkey%11 + rep-1 as int)",
    "away_score_cn": "cast(l_orderkey%9 as int)",
    "field_if": "case when l_orderkey%6=0 then 'Shift' else 'Standard' end",
}

_X0 = "(l_orderkey%200-100 + rep-1)/100e0"
_Z0 = "(l_orderkey%100+100 + rep-1)/100e0"
TRACE = {
    "game_seq": "l_orderkey",
    "pitch_no": PITCH_NO,
    "x0": _X0,
    "z0": _Z0,
    **{f"x{t}": f"{_X0} - {t}*l_linenumber/1000e0" for t in TRACE_STEPS if t},
    **{f"z{t}": f"{_Z0} - {t}*l_linenumber/500e0" for t in TRACE_STEPS if t},
}

PLAYER = {
    "game_year": "cast(y as string)",
    "tm_id": "cast(p_partkey as string)",
    "name": "p_name",
    "height": "case p_partkey%10 when 0 then null when 1 then 'N/A'"
    " else cast(165+p_partkey%35 as string) end",
}

LOGGED = "l_linenumber <= 6"
TRACED = "l_linenumber <= 5"
# Keys that the log and the trace hold twice, so that a lost fan-out shows.
LOGGED_TWICE = "l_orderkey % 89 = 5"
TRACED_TWICE = "l_orderkey % 97 = 11"


def _items(columns: dict[str, str]) -> list[str]:
    return [f"{expression} as {name}" for name, expression in columns.items()]


# --- Spark side -------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        _table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.min("l_partkey").alias("pk"), F.min("l_suppkey").alias("sk"))
    )
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("ck"),
        F.col("o_orderdate").alias("od"),
    )
    return lines.join(orders, "l_orderkey")


def pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated_lines(spark, sf_dir).selectExpr(*_items(BASE)).selectExpr(*_items(PITCH))


def _pairs(spark: SparkSession, sf_dir: str, where: str, twice: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").where(where)
    pairs = lines.select("l_orderkey", "l_linenumber").distinct()
    copies = F.when(F.expr(twice), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return pairs.withColumn("rep", F.explode(copies))


def pitch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, LOGGED, LOGGED_TWICE).selectExpr(*_items(PITCH_LOG))


def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, TRACED, TRACED_TWICE).selectExpr(*_items(TRACE))


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.explode(F.sequence(F.lit(2020), F.lit(2026))).alias("y")
    )
    clubs = F.when(F.col("p_partkey") % 100 == 7, F.array(F.lit(1), F.lit(2)))
    copies = F.explode(F.coalesce(clubs, F.array(F.lit(1))))
    return listed.withColumn("club", copies).selectExpr(*_items(PLAYER))


def derived_sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources.of(
        pitches(spark, sf_dir).withColumn("date", F.col("game_date_text")),
        pitch_log(spark, sf_dir),
        trace(spark, sf_dir),
        players(spark, sf_dir),
    )


def narrow_sources(spark: SparkSession, sf_dir: str) -> tuple[Sources, dict[str, Callable[[DataFrame], DataFrame]]]:
    """The rows that the pitch tables are made of, with the columns they are laid
    out by, and what makes the tables of `derived_sources` of them."""
    dated = _dated_lines(spark, sf_dir)
    based = dated.selectExpr(*dated.columns, *_items({name: BASE[name] for name in ("season", "mm", "dd")}))
    laid_by = ["level", "gameid"]
    placed = _items({name: PITCH[name] for name in laid_by})
    log, path = (
        _pairs(spark, sf_dir, *which).withColumn("game_seq", F.col("l_orderkey"))
        for which in ((LOGGED, LOGGED_TWICE), (TRACED, TRACED_TWICE))
    )
    narrow = Sources(based.selectExpr(*dated.columns, *placed), log, path, derived_sources(spark, sf_dir).players)

    def pitches_(rows: DataFrame) -> DataFrame:
        # What rows lie in order of is taken as it is, so that the writer sees their order.
        made = rows.selectExpr(*_items(BASE), *laid_by).selectExpr(*_items(PITCH | {name: name for name in laid_by}))
        made = made.withColumn("date", F.col("game_date_text"))
        return schema.conform(made, schema.PITCH_COLUMNS, passthrough=("date",))

    def log_(rows: DataFrame) -> DataFrame:
        return schema.conform(rows.selectExpr(*_items(PITCH_LOG)), schema.PITCH_LOG_COLUMNS)

    def path_(rows: DataFrame) -> DataFrame:
        return schema.conform(rows.selectExpr(*_items(TRACE)), schema.TRACE_COLUMNS)

    return narrow, {"pitches": pitches_, "pitch_log": log_, "trace": path_}


_landed: dict[tuple[str, str], Sources] = {}


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The four tables, landed once per session in the cluster's shared folder.
    Read back from Parquet, so that filters and column choices meet a real scan
    and not the expressions the columns were made with."""
    name_shared_folder(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        folder = scratch_path(spark, "sources")
        # Plain projections: the widest derivation outgrows one generated method.
        whole_stage = spark.conf.get("spark.sql.codegen.wholeStage")
        spark.conf.set("spark.sql.codegen.wholeStage", "false")
        try:
            narrow, derive = narrow_sources(spark, sf_dir)
            land_sources(narrow, folder, derive=derive)
        finally:
            spark.conf.set("spark.sql.codegen.wholeStage", whole_stage)
        _landed[key] = read_parquet(spark, folder)
    return _landed[key]


# --- oracle side ------------------------------------------------------------


def _select(columns: dict[str, str]) -> str:
    return "select " + ",\n  ".join(_items(columns))


def _repeated(where: str, twice: str) -> str:
    return (
        f"(select distinct l_orderkey, l_linenumber from lineitem where {where}) d,"
        f" (values (1),(2)) c(rep) where rep = 1 or {twice}"
    )


CTES = {
    "lines": "select l_orderkey, l_linenumber, min(l_partkey) as pk, min(l_suppkey) as sk"
    " from lineitem group by l_orderkey, l_linenumber",
    "dated": "select lines.*, o_custkey as ck, o_orderdate as od"
    " from lines join orders on l_orderkey = o_orderkey",
    "base": f"{_select(BASE)}\n from dated",
    "pitch": f"{_select(PITCH)}\n from base",
    "pitch_log": f"{_select(PITCH_LOG)}\n from {_repeated(LOGGED, LOGGED_TWICE)}",
    "pitch_trace": f"{_select(TRACE)}\n from {_repeated(TRACED, TRACED_TWICE)}",
    "player_info": f"{_select(PLAYER)}\n from part,"
    " (values (2020),(2021),(2022),(2023),(2024),(2025),(2026)) s(y),"
    " (values (1),(2)) c(club) where club = 1 or p_partkey % 100 = 7",
}
