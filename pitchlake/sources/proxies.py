"""Cricket-shaped fixture feeds derived from the ``events`` table.

The test tables hold no cricket data, so deliveries, line-ups and match
metadata are derived from ``events`` by integer arithmetic over ``event_id``
and ``user_id`` and a few fixed word lists. Every feed grows with ``events``
(240 deliveries per match, 22 line-up rows and one metadata row per match),
so the registered queries do work proportional to the input table.

Shared terms (``div`` is integer division):
``m = event_id div 240`` (match), ``k = event_id % 240`` (ball of the match),
``i = k div 120`` (innings), ``q = k % 120``, ``ov = q div 6``,
``t0 = m % 8``, ``t1 = (m + 3) % 8``, ``s = m div 4``,
super over when ``m % 5 = 0 and q >= 114``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake import schemas

# Fixture word lists (fixed values of the fixture definition).
FIRST_NAMES = ("Rohit", "Amit", "Sam", "Joe", "Kane", "Chris", "Babar", "Tim", "Nathan", "Dale", "Ben", "Lasith")
LAST_NAMES = ("Sharma", "Patel", "Curran", "Root", "Young", "Gayle", "Azam", "Southee", "Lyon", "Steyn",
              "Stokes", "Perera", "Khan")
TEAM_CODES = ("IND", "AUS", "ENG", "PAK", "NZ", "WI", "SL", "HK")
TEAM_NAMES = ("India", "Australia", "England", "Pakistan", "New Zealand", "West Indies", "Sri Lanka", "Hong Kong")
OUTCOMES = (
    "no run", "no run", "no run", "no run", "no run", "no run", "no run",
    "1 run", "1 run", "1 run", "1 run", "1 run",
    "2 runs", "2 runs", "3 runs", "FOUR runs", "SIX runs",
    "1 wide", "(no ball) 1 run", "1 leg bye", "2 byes", "OUT", "5 wides", "(no ball) SIX runs",
)
GROUNDS = ("Mumbai", "Melbourne", "Lords", "Lahore", "Auckland", "Nowhere Oval")
ZONES = (
    ("Mumbai", "Asia/Kolkata"),
    ("Melbourne", "Australia/Melbourne"),
    ("Lords", "Europe/London"),
    ("Lahore", "Asia/Karachi"),
    ("Auckland", "Pacific/Auckland"),
)
PLAYER_TYPES = ("batter", "keeper", "allrounder", "bowler")
HOURS_MORNING = "9.30 start, First Session 9.30-11.00, Second Session 11.20-12.50"
HOURS_EVENING = "19.30 start, First Session 19.30-21.00, Second Session 21.20-22.50"
NOT_OUT_COMMENTARY = "Played to the off side"

BALLS_PER_MATCH = 240


def _pick(values: tuple[str, ...], index: Column) -> Column:
    """values[index] for a 0-based index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def _player(team: Column, slot: Column, s: Column) -> tuple[Column, Column]:
    """(first, last) of a team slot; slot 5 rotates between teams every 4 matches."""
    x = F.when(slot == 5, (team + s) % 8).otherwise(team)
    return _pick(FIRST_NAMES, (x * 5 + slot) % 12), _pick(LAST_NAMES, (x * 3 + slot) % 13)


def _initial(c: Column) -> Column:
    return F.substring(c, 1, 1)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _match_terms(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "t0": F.col("m") % 8,
        "t1": (F.col("m") + 3) % 8,
        "s": F.expr("m div 4"),
    })


def deliveries(events: DataFrame) -> DataFrame:
    """Ball-by-ball feed (bronze events columns, without provenance)."""
    base = _match_terms(
        events.select("event_id", "user_id").withColumns({
            "m": F.expr(f"event_id div {BALLS_PER_MATCH}"),
            "k": F.col("event_id") % BALLS_PER_MATCH,
        })
    ).withColumns({
        "i": F.expr("k div 120"),
        "q": F.col("k") % 120,
    }).withColumns({
        "ov": F.expr("q div 6"),
        "so": ((F.col("m") % 5) == 0) & (F.col("q") >= 114),
        "tb": F.when(F.col("i") == 0, F.col("t0")).otherwise(F.col("t1")),
        "tw": F.when(F.col("i") == 0, F.col("t1")).otherwise(F.col("t0")),
    })
    eid = F.col("event_id")
    # in every fourth match one batsman gets a hundred in the first and fifty in the second innings
    star = F.expr("m % 4 = 2 and (i = 0 and q % 4 = 0 or i = 1 and q % 12 = 0)")
    bat_first, bat_last = _player(F.col("tb"), F.when(star, F.lit(3)).otherwise((F.expr("q div 7") + eid) % 11), F.col("s"))
    bowl_first, bowl_last = _player(F.col("tw"), F.col("ov") % 5 + 6, F.col("s"))
    named = base.withColumns({
        "outcome": F.when((F.col("m") * 7 + F.col("ov") + F.col("i")) % 11 == 0, F.lit("no run"))
        .when(star, F.lit("SIX runs"))
        # and in every fourth match one bowler takes a wicket with every other ball
        .when(F.expr("m % 4 = 3 and i = 0 and ov % 5 = 2 and q % 2 = 1"), F.lit("OUT"))
        .otherwise(_pick(OUTCOMES, (eid * 31 + F.col("user_id")) % 24)),
        "bf": bat_first, "bl": bat_last, "wf": bowl_first, "wl": bowl_last,
    })
    form = eid % 4
    bat_short = (
        F.when(form == 0, F.concat_ws(" ", "bf", "bl"))
        .when(form == 1, F.col("bl"))
        .when(form == 2, F.concat(_initial(F.col("bf")), _initial(F.col("bl"))))
        .otherwise(F.col("bf"))
    )
    bowl_short = (
        F.when(form == 0, F.col("wl"))
        .when(form == 1, F.concat_ws(" ", "wf", "wl"))
        .when(form == 2, F.col("wf"))
        .otherwise(F.concat(_initial(F.col("wf")), _initial(F.col("wl"))))
    )
    b, w = F.col("bl"), F.col("wl")
    kind = F.expr("event_id div 24") % 8
    wicket_text = (
        F.when(kind == 0, F.concat(b, F.lit(" c Root b "), w, F.lit(" 12 (9b)")))
        .when(kind == 1, F.concat(b, F.lit(" b "), w, F.lit(" 7 (5b)")))
        .when(kind == 2, F.concat(b, F.lit(" lbw b "), w, F.lit(" 3 (4b)")))
        .when(kind == 3, F.concat(b, F.lit(" st †Azam b "), w, F.lit(" 20 (18b)")))
        .when(kind == 4, F.concat(b, F.lit(" run out (Curran/†Azam) 8 (6b)")))
        .when(kind == 5, F.concat(b, F.lit(" c & b "), w, F.lit(" 31 (22b)")))
        .when(kind == 6, F.concat(b, F.lit(" hit wicket b "), w, F.lit(" 2 (3b)")))
        .otherwise(F.concat(b, F.lit(" retired out 40 (30b)")))
    )
    event = (
        F.when(eid % 193 == 1, F.lit(None).cast("string"))
        .when(eid % 97 == 0, F.lit("Drinks break"))
        .otherwise(F.concat(bowl_short, F.lit(" to "), bat_short, F.lit(", "), F.col("outcome")))
    )
    return named.select(
        (F.col("k") + 1).cast("long").alias("match_ball_number"),
        F.concat(
            F.when(F.col("so"), F.lit("0")).otherwise(F.col("ov").cast("string")),
            F.lit("."),
            (F.col("q") % 6 + 1).cast("string"),
        ).alias("ball"),
        event.alias("event"),
        F.when(F.col("outcome") == "OUT", wicket_text).otherwise(F.lit(NOT_OUT_COMMENTARY)).alias("commentary"),
        bowl_short.alias("bowler"),
        bat_short.alias("batsman"),
        F.concat(_pick(TEAM_CODES, F.col("tb")),
                 F.when(F.col("so"), F.lit(" Super Over")).otherwise(F.lit(""))).alias("innings"),
        (F.col("m") + 1000).cast("long").alias("matchid"),
        F.col("so").alias("is_super_over"),
    )


def _matches(events: DataFrame) -> DataFrame:
    """Distinct match numbers present in ``events`` (one partial-aggregated shuffle)."""
    return events.select(F.expr(f"event_id div {BALLS_PER_MATCH}").alias("m")).distinct()


def players(events: DataFrame) -> DataFrame:
    """Line-ups: 11 players for each of the two sides of every match."""
    slots = _match_terms(_matches(events)).select(
        "m", "t0", "t1", "s",
        F.explode(F.array(F.lit(0), F.lit(1))).alias("side"),
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(10))).alias("p"))
    t = F.when(F.col("side") == 0, F.col("t0")).otherwise(F.col("t1"))
    first, last = _player(t, F.col("p"), F.col("s"))
    return slots.select(
        (F.col("m") + 1000).cast("long").alias("matchid"),
        _pick(TEAM_CODES, t).alias("innings"),
        _pick(TEAM_NAMES, t).alias("team"),
        F.concat_ws(" ", first, last).alias("player_name"),
        (F.col("p") < 8).alias("batted"),
        (F.col("p") + 1).cast("int").alias("batting_position"),
        _pick(PLAYER_TYPES, F.col("p") % 4).alias("player_type"),
        F.lit("False").alias("retired"),
        F.lit("False").alias("not_out"),
        F.when(F.col("p") >= 6, F.lit("True")).otherwise(F.lit("False")).alias("bowled"),
    )


def metadata(events: DataFrame) -> DataFrame:
    """One metadata record per match, except every 13th match (missing metadata)."""
    m = F.col("m")
    base = _match_terms(_matches(events).where(m % 13 != 12))
    t0n, t1n = _pick(TEAM_NAMES, F.col("t0")), _pick(TEAM_NAMES, F.col("t1"))
    day = F.date_add(F.to_date(F.lit("2020-01-05")), (m * 9).cast("int"))
    r = m % 8
    result = (
        F.when(r == 0, F.concat(t0n, F.lit(" won by 20 runs")))
        .when(r == 1, F.concat(t1n, F.lit(" won by 5 wickets")))
        .when(r == 2, F.concat(F.lit("Match tied ("), t0n, F.lit(" won the Super Over)")))
        .when(r == 3, F.lit("No result"))
        .when(r == 4, F.lit("Match tied"))
        .when(r == 5, F.lit("Brunei won by 5 wickets"))
        .when(r == 6, F.lit(None).cast("string"))
        .otherwise(F.lit("Abandoned"))
    )
    cols = {
        "ground": _pick(GROUNDS, m % 6),
        "toss": F.when(m % 9 == 4, t0n).otherwise(F.concat(t0n, F.lit(", elected to field first"))),
        "series": F.concat(F.lit("Series "), F.expr("m div 6").cast("string")),
        "season": (F.expr("m div 12") + 2020).cast("string"),
        "player_of_the_match": F.concat(F.lit("Player "), (m % 17).cast("string")),
        "player_of_the_series": F.concat(F.lit("Player "), (F.expr("m div 6") % 17).cast("string")),
        "hours_of_play_local_time": F.when(m % 7 == 6, F.lit(None).cast("string"))
        .when(m % 3 == 1, F.lit(HOURS_MORNING)).otherwise(F.lit(HOURS_EVENING)),
        "match_days": F.when(m % 11 == 10, F.lit(None).cast("string"))
        .when(m % 11 == 9, F.lit("date unknown"))
        .otherwise(F.concat(F.date_format(day, "d MMMM yyyy"), F.lit(" - night (20-over match)"))),
        "t20_debut": F.lit("None"),
        "t20i_debut": F.lit("None"),
        "umpires": F.concat(F.lit("Umpire "), (m % 5).cast("string"), F.lit(", Umpire "), ((m + 1) % 5).cast("string")),
        "tv_umpire": F.concat(F.lit("Umpire "), ((m + 2) % 5).cast("string")),
        "reserve_umpire": F.concat(F.lit("Umpire "), ((m + 3) % 5).cast("string")),
        "match_referee": F.concat(F.lit("Referee "), (m % 3).cast("string")),
        "points": F.concat(t0n, F.lit(" 2, "), t1n, F.lit(" 0")),
        "match_number": F.concat(F.lit("T20I no. "), (m + 1000).cast("string")),
        "matchid": (m + 1000).cast("long"),
        "player_replacements": F.lit(None).cast("string"),
        "first_innings": _pick(TEAM_CODES, F.col("t0")),
        "second_innings": _pick(TEAM_CODES, F.col("t1")),
        "has_super_over": m % 5 == 0,
        "super_over_count": F.when(m % 5 == 0, F.lit(1)).otherwise(F.lit(0)).cast("int"),
        "series_result": result,
    }
    return base.select(*[c.alias(name) for name, c in cols.items()])


def zones(spark: SparkSession) -> DataFrame:
    """Ground -> IANA zone dimension (bounded: one row per known ground)."""
    return spark.createDataFrame(list(ZONES), schemas.ZONES_SCHEMA)


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All fixture feeds over one scale-factor directory."""
    events = read_table(spark, sf_dir, "events")
    return {
        "deliveries": deliveries(events),
        "players": players(events),
        "metadata": metadata(events),
        "zones": zones(spark),
    }
