"""The rules restated as SQL, independent of the Spark code.

Codes are looked up in VALUES tables and location cells are joined by their
bins, where the Spark side uses conditional expressions, so that a slip in one
is not repeated in the other. Every statement runs over whole tables.
"""

from __future__ import annotations

from checks.fixtures import CTES as TABLES
from pitchlake.schema import (
    HIT_TRAJECTORY,
    OUTPUT_COLUMNS,
    PITCH_TRAJECTORY,
    SPIN_AXIS_3D,
    X_SAMPLES,
    Z_SAMPLES,
)

# Source vocabulary and its labels.
VOCABULARY = {
    "codes(code, kind)": "('31','FF'),('32','CU'),('33','SL'),('34','CH'),('35','FS'),('36','SI'),"
    "('37','FT'),('38','FC'),('131','ST')",
    "guesses(guess, kind)": "('fastball','FF'),('four-seam','FF'),('sinker','SI'),"
    "('curveball','CU'),('slider','SL'),('changeup','CH'),('splitter','FS'),('cutter','FC'),"
    "('sweeper','ST')",
    "kinds(kind, name, family)": "('FF','4-Seam Fastball','Fastball'),('CH','Changeup','Off_Speed'),"
    "('SL','Slider','Breaking'),('CU','Curveball','Breaking'),('ST','Sweeper','Breaking'),"
    "('FS','Split-Finger','Off_Speed'),('FT','2-Seam Fastball','Fastball'),"
    "('SI','2-Seam Fastball','Fastball'),('FC','Cutter','Fastball')",
    "calls(call, label, type)": "('foulball','foul','S'),('foulballfieldable','foul','S'),"
    "('foulballnotfieldable','foul','S'),('ballcalled','ball','B'),('ballindirt','ball','B'),"
    "('automaticball','ball',null),('ballautomatic','ball','B'),"
    "('strikecalled','called_strike','S'),('automaticstrike','called_strike',null),"
    "('strikeautomatic','called_strike','S'),('strikeswinging','swinging_strike','S'),"
    "('inplay',null,'X'),('hitbypitch',null,'B'),('ballintentional',null,'B')",
    "results(result, event, batter)": "('out','field_out','out'),"
    "('fielderschoice','fielders_choice_out','safe'),('error','field_error','safe'),"
    "('single','single','safe'),('double','double','safe'),('triple','triple','safe'),"
    "('homerun','home_run','safe'),('sacrifice',null,'out')",
    "hits(tag, bb_type)": "('groundball','Ground_Ball'),('linedrive','Line_Drive'),"
    "('flyball','Fly_Ball'),('popup','Popup'),('bunt','Bunt')",
    "leverage(state, side)": "('0-0','Neutral'),('3-2','Neutral'),('0-1','Pitcher'),('0-2','Pitcher'),"
    "('1-1','Pitcher'),('1-2','Pitcher'),('2-2','Pitcher'),('1-0','Hitter'),('2-0','Hitter'),"
    "('2-1','Hitter'),('3-0','Hitter'),('3-1','Hitter')",
    "acts(description, ntype, swing, con, whiff, foul)": "('called_strike','strike',0,0,0,0),"
    "('ball','ball',0,0,0,0),('hit_into_play','inplay',1,1,0,0),"
    "('hit_into_play_no_out','inplay',1,1,0,0),('hit_into_play_score','inplay',1,1,0,0),"
    "('swinging_strike','whiff',1,0,1,0),('swing_strike_blocked','whiff',1,0,1,0),"
    "('foul','foul',1,1,0,1),('foul_tip',null,1,1,0,1),('hit_by_pitch','hit_by_pitch',0,0,0,0)",
    "outcomes(event, pa, ab, hit)": "('single',1,1,1),('double',1,1,1),('triple',1,1,1),"
    "('home_run',1,1,1),('field_out',1,1,0),('fielders_choice_out',1,1,0),('field_error',1,1,0),"
    "('force_out',1,1,0),('double_play',1,1,0),('grounded_into_double_play',1,1,0),"
    "('strikeout',1,1,0),('strikeout_double_play',1,1,0),('hit_by_pitch',1,0,0),('walk',1,0,0),"
    "('sac_fly',1,0,0),('sac_fly_double_play',1,0,0),('sac_bunt',1,0,0)",
    "cells(up, across, zone, hand_side, level_side)": "(3,1,1,'Left','High'),(3,2,2,null,'High'),"
    "(3,3,3,'Right','High'),(2,1,4,'Left',null),(2,2,5,null,null),(2,3,6,'Right',null),"
    "(1,1,7,'Left','Low'),(1,2,8,null,'Low'),(1,3,9,'Right','Low')",
    "areas(up, across, area)": "(3,1,'nz1'),(3,2,'nz2'),(3,3,'nz3'),(2,1,'nz4'),(2,2,'core'),"
    "(2,3,'nz6'),(1,1,'nz7'),(1,2,'nz8'),(1,3,'nz9')",
    "rules(code, lvl, floor, skipped)": "('AAA','aaa','2024',null),"
    "('KBO','koreabaseballorganization','2021','20241001-suwon-1'),('KBSA','kbsa','2024',null),"
    "('MINOR','kbo minors','2021','20241001-suwon-1'),('NPB','npb','2021',null)",
    "openings(code, opens, closes)": "('KBO','20180401','20181018'),('KBO','20190323','20191001'),"
    "('KBO','20200504','20201100'),('KBO','20210402','20211100'),('KBO','20220401','20221012'),"
    "('KBO','20230401','20231018'),('KBO','20240323','20241002'),('KBO','20250321','20251005'),"
    "('KBO','20260327','~')",
}


def _bin(value: str, *edges: str) -> str:
    """Number of the open interval between neighbouring edges, 0 for none."""
    steps = [
        f"when {value} > {low} and {value} < {high} then {i}"
        for i, (low, high) in enumerate(zip(edges, edges[1:]), start=1)
    ]
    return f"case {' '.join(steps)} else 0 end"


def _flag(condition: str) -> str:
    """1 or 0, never NULL."""
    return f"cast(coalesce({condition}, false) as int)"


def _mark(condition: str) -> str:
    """1 or NULL."""
    return f"nullif({_flag(condition)}, 0)"


def _mark_of(column: str) -> str:
    return f"nullif({column}, 0)"


# Rounding towards zero from below gives -0.0 in one engine only.
def _round(expression: str, digits: int) -> str:
    rounded = f"round({expression}, {digits})"
    return f"(case when {rounded} = 0 then 0e0 else {rounded} end)"


def _items(columns: dict[str, str]) -> str:
    return ",\n  ".join(f'{expression} as "{name}"' for name, expression in columns.items())


MEASURES = {
    "release_speed": _round("relspeed * 0.621371e0", 1),
    "release_pos_x": _round("relside * 3.28084e0", 2),
    "release_pos_z": _round("relheight * 3.28084e0", 2),
    "pfx_x": "horzbreak * 0.032808e0 * -1e0",
    "pfx_z": "inducedvertbreak * 0.032808e0",
    "plate_x": "platelocside * -1e0",
    "plate_z": "platelocheight",
    "hit_distance_sc": _round("distance * 3.28084e0", 0),
    "launch_speed": _round("exitspeed * 0.621371e0", 1),
    "launch_angle": _round("angle", 0),
    "HangTime": _round("hangtime", 3),
    "bearing": _round("p.bearing", 3),
    "release_spin_rate": _round("spinrate", 0),
    "release_spin_axis": _round("spinaxis", 1),
    "release_extension": _round("extension * 3.28084e0", 2),
    "contactX": _round("contactpositionx", 2),
    "contactY": _round("contactpositiony", 2),
    "contactZ": _round("contactpositionz", 2),
}

IDENTITY = {
    "game_seq": "p.game_seq",
    "pit_seq": "p.pit_seq",
    "pitchno": "p.pitchno",
    "gameid": "p.gameid",
    "level": "p.level",
    "season_text": "left(gameid, 4)",
    "game_year": "cast(left(gameid, 4) as int)",
    "game_date": "cast(game_date_text as timestamp)",
    "month": "cast(month(cast(game_date_text as timestamp)) as int)",
    "DH": "right(gameid, 1)",
    "batter_text": "batterid",
    "pitcher_text": "pitcherid",
    "catcher_text": "catcherid",
    "batter": "cast(batterid as bigint)",
    "pitcher": "cast(pitcherid as bigint)",
    "catcherid": "cast(catcherid as bigint)",
    "pitname": "p.pitcher",
    "batname": "p.batter",
    **{
        name: name
        for name in "catcher pitcherteam batterteam hometeam awayteam inning field_if".split()
    },
    "pitch_number": "pitchofpa",
    "home_score": "home_score_cn",
    "away_score": "away_score_cn",
    "hit_spin_rate": "hitspinrate",
    **{
        name: name.lower()
        for name in "BatSpeed VerticalAttackAngle HorizontalAttackAngle ZoneTime".split()
    },
    "balls": "cast(p.balls as varchar)",
    "strikes": "cast(p.strikes as varchar)",
    "count": "p.balls || '-' || p.strikes",
    **{name: name.lower() for name in ["gameuid", "pitchuid", *SPIN_AXIS_3D]},
    **{name: name.lower() for name in PITCH_TRAJECTORY + HIT_TRAJECTORY},
    **{name: name for name in X_SAMPLES + Z_SAMPLES},
}

# Exit speed in mph is v, launch angle is a.
GRADE = """case
    when v >= 98 and a between 4 and 50 and v * 1.5e0 - a >= 117 and v + a >= 124 then 6
    when v >= 95 and a between 0 and 52 and v * 1.5e0 - a >= 111 and v + a >= 119 then 5
    when v <= 59 then 1
    when v between 59 and 72 and a <= 41 and v * 2 - a >= 87 and v * 2 + a <= 175
      and v + a * 1.3e0 >= 89 then 4
    when v between 72 and 86 and v + a * 1.3e0 <= 112 and v + a * 1.55e0 >= 92 then 4
    when v between 86 and 95 and a <= 20 and v + a * 2.4e0 >= 98 then 4
    when v >= 95 and a <= 30 and v - a >= 76 and v + a * 2.4e0 >= 98 then 4
    when v + a * 2 >= 116 then 3
    when v + a * 2 <= 116 then 2 end"""


def _ground(leg: str) -> str:
    return f"cast(round(distance * {leg}(radians(45 - p.bearing)), 0) as bigint)"


PLAYS = {
    "pitch_kind": "coalesce(codes.kind, guesses.kind, 'OT')",
    "pitch_name": "coalesce(kinds.name, codes.kind, guesses.kind, 'OT')",
    "p_kind": "coalesce(kinds.family, 'OT')",
    "runner": """case when before_b1_bat_turn_no is null or before_b2_bat_turn_no is null
      or before_b3_bat_turn_no is null then null
    else coalesce(nullif(replace(cast(
      if(before_b1_bat_turn_no <> 0, 100, 0) + if(before_b2_bat_turn_no <> 0, 20, 0)
      + if(before_b3_bat_turn_no <> 0, 3, 0) as varchar), '0', ''), ''), '0') end""",
    "events": """case
    when results.event is not null then results.event
    when lower(playresult) = 'sacrifice' and distance >= 30 then 'sac_fly'
    when lower(playresult) = 'sacrifice' and (distance is not null or lower(taggedhittype) = 'bunt')
      then 'sac_bunt'
    when 'hitbypitch' in (lower(playresult), lower(pitchcall)) then 'hit_by_pitch'
    when lower(playresult) = 'walk' then 'walk'
    when lower(playresult) = 'undefined' and lower(korbb) in ('strikeout', 'walk')
      then lower(korbb) end""",
    "description": """case
    when calls.label is not null then calls.label
    when calls.type = 'X' and runsscored >= 1 then 'hit_into_play_score'
    when calls.type = 'X' and runsscored = 0 and results.batter = 'safe' then 'hit_into_play_no_out'
    when calls.type = 'X' and runsscored = 0 and results.batter = 'out' then 'hit_into_play'
    when 'hitbypitch' in (lower(playresult), lower(pitchcall)) then 'hit_by_pitch'
    when lower(pitchcall) = 'ballintentional' then 'pitchout' end""",
    "type": "calls.type",
    "bb_type": "case when calls.type = 'X' then hits.bb_type end",
    "stand": "case when lower(batterside) in ('right', 'left') then upper(left(batterside, 1)) end",
    "p_throw": "case when lower(pitcherthrows) in ('right', 'left')"
    " then upper(left(pitcherthrows, 1)) end",
    "launch_speed_angle": f"case when calls.type = 'X' then {GRADE} end",
    "launch_direction": "case sign(p.bearing) when -1 then 'L' when 0 then 'R' when 1 then 'R' end",
    "groundX": f"case when calls.type = 'X' then {_ground('cos')} end",
    "groundY": f"case when calls.type = 'X' then {_ground('sin')} end",
}

METRICS = {
    "rel_height": "release_pos_z * 0.3048e0",
    "rel_side": "release_pos_x * 0.3048e0",
    "hor_break": "pfx_x * 0.3048e0 * 100",
    "ver_break": "pfx_z * 0.3048e0 * 100",
    "rel_speed(km)": "release_speed * 1.609344e0",
    "exit_speed(km)": "launch_speed * 1.609344e0",
    "extension": "release_extension * 0.3048e0",
    "hit_distance": "hit_distance_sc * 0.3048e0",
}

LIMITS = {
    "high": 'coalesce(("Height" * 0.5575e0 + 3.5e0) / 100, 1.049e0)',
    "low": 'coalesce(("Height" * 0.2704e0 - 3.5e0) / 100, 0.463e0)',
}
LINES = {
    "1/3": "low + (high - low) / 3",
    "2/3": "high - (high - low) / 3",
    "zonehigh": "high + 0.11e0",
    "corehigh": "high - 0.11e0",
    "corelow": "low + 0.11e0",
    "zonelow": "low - 0.11e0",
}
BINS = {
    "across": _bin("plate_x", "-0.271e0", "-0.0903e0", "0.0903e0", "0.271e0"),
    "up": _bin("plate_z", "low", '"1/3"', '"2/3"', "high"),
    "wide_across": _bin("plate_x", "-0.381e0", "-0.161e0", "0.161e0", "0.381e0"),
    "wide_up": _bin("plate_z", "zonelow", "corelow", "corehigh", "zonehigh"),
    "in_out": "case when abs(plate_x) < 0.271e0 and plate_z > low and plate_z < high then 'IN'"
    " when abs(plate_x) < 0.381e0 and plate_z > zonelow and plate_z < zonehigh then 'OUT'"
    " else 'Not Specified' end",
}
QUADRANT = (
    "case when in_out = 'OUT' and plate_x <> 0 and plate_z <> 0.75e0"
    " then 11 + if(plate_x > 0, 1, 0) + if(plate_z < 0.75e0, 2, 0) end"
)

EVENT_NAMES = [
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
GRADES = ["weak", "topped", "under", "flare", "solid_contact", "barrel"]

FLAGS = {
    "count_value": "leverage.side",
    "ntype": "acts.ntype",
    **{name: _mark_of(f"outcomes.{name}") for name in ("pa", "ab", "hit")},
    **{name: _mark_of(f"acts.{name}") for name in ("swing", "con", "whiff", "foul")},
    "looking": _mark("z.description = 'ball' or z.description = 'called_strike'"),
    "z_in": _flag("zone < 10"),
    "z_out": _mark("zone > 10"),
    "z_left": _mark("hand_side = 'Left'"),
    "z_right": _mark("hand_side = 'Right'"),
    "z_high": _mark("level_side = 'High'"),
    "z_low": _mark("level_side = 'Low'"),
    "l_r": "case when hand_side is not null and coalesce(acts.swing, 0) = 0 then hand_side || '_take'"
    " else 'Not Specified' end",
    "h_l": "case when level_side is not null and coalesce(acts.swing, 0) = 0 then level_side || '_take'"
    " else 'Not Specified' end",
    "Left_take": _mark("hand_side = 'Left' and coalesce(acts.swing, 0) = 0"),
    "Right_take": _mark("hand_side = 'Right' and coalesce(acts.swing, 0) = 0"),
    "High_take": _mark("level_side = 'High' and coalesce(acts.swing, 0) = 0"),
    "Low_take": _mark("level_side = 'Low' and coalesce(acts.swing, 0) = 0"),
    "ld": _flag("bb_type = 'Line_Drive'"),
    "fb": _flag("bb_type = 'Fly_Ball'"),
    "gb": _flag("bb_type = 'Ground_Ball'"),
    "pu": _flag("bb_type = 'Popup'"),
    **{name: _flag(f"z.events = '{name}'") for name in EVENT_NAMES},
    "inplay": _flag("type = 'X'"),
    "cs": _flag("z.description = 'called_strike'"),
    "S": _flag("type in ('S', 'X')"),
    **{name: _flag(f"launch_speed_angle = {i}") for i, name in enumerate(GRADES, start=1)},
    "plus_lsa4": _flag("launch_speed_angle between 4 and 6"),
    "z_swing": _mark("zone between 1 and 9 and acts.swing = 1"),
    "z_con": _mark("zone between 1 and 9 and acts.con = 1"),
    "z_inplay": _mark("zone between 1 and 9 and type = 'X'"),
    "o_swing": _mark("zone between 11 and 99 and acts.swing = 1"),
    "o_con": _mark("zone between 11 and 99 and acts.con = 1"),
    "o_inplay": _mark("zone between 11 and 99 and type = 'X'"),
    "f_swing": _mark("z.count = '0-0' and acts.swing = 1"),
    "f_pitch": _mark("z.count = '0-0'"),
    "z_str_swing": _mark("zone between 1 and 9 and acts.whiff = 1"),
    "exit_velocity": "case when type = 'X' then \"exit_speed(km)\" end",
    "launch_angleX": "case when type = 'X' then launch_angle end",
    "hit_spin": "case when type = 'X' then hit_spin_rate end",
    "hang_time": 'case when type = \'X\' then "HangTime" end',
    "hit_bearing": "case when type = 'X' then bearing end",
}

IN_LEAGUE = """rules.lvl = lower({t}.level) and left({t}.gameid, 4) >= rules.floor
  and (rules.skipped is null or lower({t}.gameid) <> rules.skipped)
  and (rules.code not in (select code from openings) or exists (
    select 1 from openings where openings.code = rules.code
    and {t}.gameid >= openings.opens and {t}.gameid <= openings.closes))"""

VALUES = {f"{head}": f"values {rows}" for head, rows in VOCABULARY.items()}

STEPS = {
    "joined": """select p.*, l.* exclude (game_seq, pit_seq), t.* exclude (game_seq, pitch_no),
  p.exitspeed / 1.609344e0 as v, p.angle as a
 from pitch p
 left join log_read l on l.game_seq = p.game_seq and l.pit_seq = p.pit_seq
 left join trace_read t on t.game_seq = p.game_seq and t.pitch_no = p.pitchno""",
    "coded": f"""select {_items({**IDENTITY, **MEASURES, **PLAYS})}
 from joined p
 left join codes on codes.code = pit_kind_cd
 left join guesses on pit_kind_cd is null and guesses.guess = lower(autopitchtype)
 left join kinds on kinds.kind = coalesce(codes.kind, guesses.kind)
 left join calls on calls.call = lower(pitchcall)
 left join results on results.result = lower(playresult)
 left join hits on hits.tag = lower(taggedhittype)""",
    "people": "select game_year as year_text, tm_id, name, try_cast(height as double) as cm"
    " from player_info",
    "batted": f"""select c.*, people.name as "NAME_batter", people.cm as "Height",
  {_items(METRICS)}
 from coded c left join people on people.year_text = c.season_text and people.tm_id = c.batter_text""",
    "limited": f"select *, {_items(LIMITS)} from batted",
    "lined": f"select *, {_items(LINES)} from limited",
    "binned": f"select *, {_items(BINS)} from lined",
    "zoned": f"""select b.*, coalesce(cells.zone, {QUADRANT}, 99) as zone, hand_side, level_side,
  coalesce(areas.area, 'Not Specified') as new_zone
 from binned b
 left join cells on cells.up = b.up and cells.across = b.across
 left join areas on areas.up = b.wide_up and areas.across = b.wide_across""",
    "flagged": f"""select z.*, {_items(FLAGS)}
 from zoned z
 left join leverage on leverage.state = z.count
 left join acts on acts.description = z.description
 left join outcomes on outcomes.event = z.events""",
    "named": """select f.*, pitching.name as "NAME_pitcher", catching.name as "NAME_catcher"
 from flagged f
 left join people pitching on pitching.year_text = f.season_text and pitching.tm_id = f.pitcher_text
 left join people catching on catching.year_text = f.season_text and catching.tm_id = f.catcher_text""",
    "extracted": f"select n.* from named n join rules on {IN_LEAGUE.format(t='n')}",
    "wanted": f"select n.* from pitch n join rules on {IN_LEAGUE.format(t='n')}",
    # The mean as an exact sum of hundredths of a foot: a sum of fractions would
    # depend on the order of the rows.
    "arms": """select lower(level) as league, pitcher,
  cast(sum(cast(round(release_pos_z * 100) as bigint)) as double) / 100 / count(release_pos_z)
    * 0.3048e0 as mean_height,
  coalesce(avg(rel_height) <= 1.5e0, false) as side_arm, min(p_throw) as hand
 from extracted where pitcher is not null group by lower(level), pitcher""",
    "slotted": """select e.*, if(side_arm, 'S', 'R') as p_type, if(side_arm, 'S', hand) as p_throws
 from extracted e left join arms on arms.league = lower(e.level) and arms.pitcher = e.pitcher""",
}

# Log and trace hold some keys twice, so a query has as many rows as the joins
# it makes give it. Queries that are not listed read neither table.
BOTH = ("pitch_log", "pitch_trace")
READS = {
    **dict.fromkeys(
        "filter_drop_ot join_pitch_log decode_pitch_kind pitch_name pitch_family runner_state".split(),
        ("pitch_log",),
    ),
    **dict.fromkeys("join_trace trace_passthrough".split(), ("pitch_trace",)),
    **dict.fromkeys(
        "agg_release_height agg_side_arm_pitchers agg_pitcher_hand pitcher_arm_slot numeric_ids"
        " passthrough sort_game_pitch sink_roundtrip publish_one_league land_in_buckets publish_changes".split(),
        BOTH,
    ),
    **dict.fromkeys(["pitch_fact", *(f"pitch_fact_{c}" for c in "aaa kbo kbsa minor npb".split())], BOTH),
}


def _prefix(reads: tuple[str, ...]) -> str:
    read = {
        name: f"select * from {table}" + ("" if table in reads else " where false")
        for name, table in (("log_read", "pitch_log"), ("trace_read", "pitch_trace"))
    }
    ctes = {**TABLES, **read, **VALUES, **STEPS}
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in ctes.items())


def statement(columns: str, tail: str) -> str:
    return f"select {columns}\nfrom {tail}"


def of(step: str, *names: str, keys: str = "game_seq pit_seq") -> str:
    return statement(", ".join(f'"{name}"' for name in (*keys.split(), *names)), step)


def fact(where: str = "") -> str:
    columns = ", ".join(f'"{name}"' for name in OUTPUT_COLUMNS)
    return statement(columns, f"slotted where p_kind <> 'OT'{where}")


TRAJECTORIES = ["ZoneTime", *PITCH_TRAJECTORY, *HIT_TRAJECTORY]
LINE_NAMES = ["Height", *LIMITS, *LINES]
PITCH_ID = "level, gameid, game_seq, pit_seq"


def _pitches_where(condition: str) -> str:
    return statement(PITCH_ID, f"pitch where {condition}")


def statements() -> dict[str, str]:
    return {name: f"{_prefix(READS.get(name, ()))}\n{text}" for name, text in _selects().items()}


def _selects() -> dict[str, str]:
    return {
        # sources and sinks
        "scan_pitches": statement("* exclude (game_date_text), game_date_text as date", "pitch"),
        "scan_pitch_log": statement("*", "pitch_log"),
        "scan_trace": statement("*", "pitch_trace"),
        "scan_players": statement("*", "player_info"),
        "sink_roundtrip": fact(),
        "publish_one_league": fact(),
        "publish_changes": fact(),
        "land_in_buckets": of("coded", "pitch_name", "runner", *X_SAMPLES, *Z_SAMPLES),
        # filters
        "filter_season": _pitches_where("left(gameid, 4) >= '2024'"),
        "filter_league": _pitches_where("level = 'KBO Minors'"),
        "filter_exclude_game": _pitches_where("gameid <> '20241001-Suwon-1'"),
        "filter_season_windows": _pitches_where(
            "exists (select 1 from openings where gameid >= opens and gameid <= closes)"
        ),
        "filter_drop_ot": of("coded where pitch_kind <> 'OT'", "pitch_name", "p_kind"),
        "league_all": statement(PITCH_ID, "wanted"),
        # joins
        "join_pitch_log": statement(
            "p.game_seq, p.pit_seq, pit_kind_cd, before_b1_bat_turn_no, before_b2_bat_turn_no,"
            " before_b3_bat_turn_no, home_score_cn, away_score_cn, field_if",
            "joined p",
        ),
        "join_trace": of("joined", *X_SAMPLES, *Z_SAMPLES, keys="game_seq pitchno"),
        "join_batter": of("batted", "NAME_batter", "Height"),
        "join_pitcher": statement(
            'game_seq, pit_seq, people.name as "NAME_pitcher"',
            "coded left join people on year_text = season_text and tm_id = pitcher_text",
        ),
        "join_catcher": statement(
            'game_seq, pit_seq, people.name as "NAME_catcher"',
            "coded left join people on year_text = season_text and tm_id = catcher_text",
        ),
        # aggregates and order
        "agg_release_height": statement(
            "league, pitcher, mean_height as mean_rel_height", "arms"
        ),
        "agg_side_arm_pitchers": statement("league, pitcher", "arms where side_arm"),
        "agg_pitcher_hand": statement(
            "league, pitcher, if(side_arm, 'S', hand) as p_throws", "arms"
        ),
        "pitcher_arm_slot": of("slotted", "level", "pitcher", "p_type", "p_throws"),
        "sort_game_pitch": statement(
            "gameid, pitchno, game_seq, pit_seq", "pitch order by gameid, pitchno, game_seq, pit_seq"
        ),
        # pitch and play labels
        "parse_game_id": of("coded", "gameid", "game_year", "DH"),
        "decode_pitch_kind": of("coded", "pitch_kind"),
        "pitch_name": of("coded", "pitch_kind", "pitch_name"),
        "pitch_family": of("coded", "pitch_name", "p_kind"),
        "runner_state": of("coded", "runner"),
        "count_state": of("flagged", "balls", "strikes", "count", "count_value"),
        "classify_event": of("coded", "events"),
        "classify_description": of("coded", "description"),
        "pitch_result_type": of("coded", "type"),
        "batted_ball_type": of("coded", "bb_type"),
        "pitch_outcome_type": of("flagged", "description", "ntype"),
        "handedness": of("coded", "stand", "p_throw"),
        # measures
        "unit_conversions": of("coded", *MEASURES),
        "catcher_view_flip": of("coded", "plate_x", "pfx_x"),
        "metric_columns": of("batted", *METRICS),
        "launch_speed_angle": of("coded", "launch_speed_angle"),
        "spray_direction": of("coded", "launch_direction"),
        "spray_coordinates": of("coded", "groundX", "groundY"),
        "inplay_metrics": of(
            "flagged", "exit_velocity", "launch_angleX", "hit_spin", "hang_time", "hit_bearing"
        ),
        "date_parts": of("coded", "game_date", "month"),
        "numeric_ids": of(
            "coded", "batter", "pitcher", "catcherid", "groundX", "groundY", "game_year"
        ),
        "passthrough": of(
            "coded",
            *"pitname batname pitcherteam batterteam hometeam awayteam inning catcher".split(),
            *"home_score away_score field_if level pitch_number hit_spin_rate BatSpeed".split(),
            *"VerticalAttackAngle HorizontalAttackAngle gameuid pitchuid".split(),
            *SPIN_AXIS_3D,
        ),
        "trajectory_passthrough": of("coded", *TRAJECTORIES),
        "trace_passthrough": of("coded", *X_SAMPLES, *Z_SAMPLES),
        # strike zone
        "strike_zone_bounds": of("lined", *LINE_NAMES),
        "zone_in_out": of("zoned", "in_out"),
        "zone_13": of("zoned", "zone"),
        "zone_core_shadow": of("zoned", "new_zone"),
        "take_location": of(
            "flagged", "l_r", "h_l", "Left_take", "Right_take", "High_take", "Low_take"
        ),
        # flags
        "flags_plate_appearance": of("flagged", "pa", "ab", "hit"),
        "flags_swing": of("flagged", "swing", "con", "whiff", "foul", "looking"),
        "flags_zone": of("flagged", "z_in", "z_out", "z_left", "z_right", "z_high", "z_low"),
        "flags_batted_ball": of("flagged", "ld", "fb", "gb", "pu"),
        "flags_event": of("flagged", *EVENT_NAMES, "inplay", "cs", "S"),
        "flags_contact_quality": of("flagged", *GRADES, "plus_lsa4"),
        "flags_discipline": of(
            "flagged",
            *"z_swing z_con z_inplay o_swing o_con o_inplay f_swing f_pitch z_str_swing".split(),
        ),
        # whole jobs
        "pitch_fact": fact(),
        "pitch_fact_aaa": fact(" and level = 'AAA'"),
        "pitch_fact_kbo": fact(" and level = 'KoreaBaseballOrganization'"),
        "pitch_fact_kbsa": fact(" and level = 'KBSA'"),
        "pitch_fact_minor": fact(" and level = 'KBO Minors'"),
        "pitch_fact_npb": fact(" and level = 'NPB'"),
    }
