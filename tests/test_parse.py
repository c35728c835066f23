"""Delivery text parsing: every branch and the kept quirks, on hand-written rows."""

from pyspark.sql import functions as F

from conftest import evaluate
from pitchlake.functions import parse
from pitchlake.operators import silver

EV = "event string"


def _parsed(spark, events, commentary=None):
    rows = [(e, "1.1", commentary[i] if commentary else "Played to the off side") for i, e in enumerate(events)]
    df = spark.createDataFrame(rows, "event string, ball string, commentary string")
    df = df.withColumn("_i", F.monotonically_increasing_id())
    return silver.parse_deliveries(df).orderBy("_i").collect()


def test_event_groups(spark):
    events = [
        None,
        "Drinks break",
        "Joe O'Root to Rohit Sharma, 1 run",
        "Jean-Paul Duminy to AB de Villiers, FOUR runs",
        "Fabián Allen to Rilee Rossouw, 1 run",       # accented bowler: partial capture
        "Joe Root to Sam Curran,1 run",                # no space after the comma: no match
        "Joe Root2 to Sam Curran, 1 run",              # digit in a name: bowler group empty
    ]
    rows = _parsed(spark, events)
    got = [(r.bowler_short, r.batsman_short, r.runs_text) for r in rows]
    assert got == [
        (None, None, None),
        ("", "", ""),
        ("Joe O'Root", "Rohit Sharma", "1 run"),
        ("Jean-Paul Duminy", "AB de Villiers", "FOUR runs"),
        ("n Allen", "Rilee Rossouw", "1 run"),
        ("", "", ""),
        ("", "Sam Curran", "1 run"),
    ]


def test_runs_and_extras(spark):
    outcomes = ["no run", "1 run", "2 runs", "FOUR runs", "SIX runs", "1 wide", "5 wides", "1 leg bye",
                "2 byes", "(no ball) 1 run", "(no ball) FOUR runs", "(no ball) 2 leg byes", "OUT",
                "OUT, 1 run", "SIX"]
    rows = _parsed(spark, [f"A to B, {o}" for o in outcomes] + [None, "Drinks break"])
    got = [(r.Extras, r.runs) for r in rows]
    assert got == [
        ("normal", 0), ("normal", 1), ("normal", 2), ("normal", 4), ("normal", 6),
        ("wide", 1), ("wide", 5), ("legbyes", 1), ("byes", 2),
        ("noball", 2), ("noball", 5), ("noball", 3),      # penalty run added; no-ball beats leg byes
        ("normal", 0), ("normal", 0), ("normal", 0),      # "OUT, 1 run" and bare "SIX" score 0
        ("normal", 0), ("normal", 0),                     # NULL / unparsed event
    ]


def test_over_and_ball(spark):
    got = evaluate(spark, lambda: F.struct(parse.over_number(F.col("b")), parse.ball_in_over(F.col("b"))),
                   [("19.6",), ("0.10",), ("7",), ("",), (None,), ("x.y",)], "b string")
    assert [tuple(g) for g in got] == [(20, 6), (1, 10), (8, None), (None, None), (None, None), (None, None)]


DISMISSALS = [
    ("Root c Smith b Khan 12 (9b)", "Caught", "Smith"),
    ("Root b Khan 7 (5b)", "Bowled", "Khan"),
    ("Root lbw b Khan 3 (4b)", "LBW", "Khan"),
    ("Root st †Azam b Khan 20 (18b)", "Stumped", "Azam"),
    ("Root run out (Curran/†Azam) 8 (6b)", "Run Out", "Curran"),
    ("Root c & b Khan 31 (22b)", "Caught & Bowled", "Khan"),
    ("Root b Mohammad Amir 12 (9b)", "Not Out", None),          # two-word bowler is not "Bowled"
    ("Root hit wicket b Khan 2 (3b)", "Bowled", "Khan"),         # hit wicket reads as bowled
    ("Root retired out 40 (30b)", "Not Out", None),              # unmatched OUT text
    ("Root lbw b Khan", "LBW", ""),                              # LBW without score: empty fielder
    ("Amidst the chaos, Root st †Kumar b Khan 3 (4b)", "Stumped", "the chaos, Root st Kumar"),
]


def test_dismissals(spark):
    rows = _parsed(spark, ["A to B, OUT"] * len(DISMISSALS), [c for c, _, _ in DISMISSALS])
    assert [(r.dismissal_method, r.dismissed_by) for r in rows] == [(m, b) for _, m, b in DISMISSALS]


def test_dismissal_needs_out_but_null_event_falls_through(spark):
    rows = _parsed(spark, ["A to B, 1 run", None], ["Root b Khan 7 (5b)", "Root b Khan 7 (5b)"])
    assert [(r.dismissal_method, r.dismissed_by) for r in rows] == [("Not Out", None), ("Bowled", "Khan")]


def test_super_over_toss_and_result(spark):
    got = evaluate(spark, lambda: parse.super_over_label(F.col("t")),
                   [("IND Super Over",), ("India",), (None,)], "t string")
    assert got == ["IND Super Over", "normal", "normal"]
    got = evaluate(spark, lambda: F.struct(parse.toss_winner(F.col("t")), parse.toss_decision(F.col("t"))),
                   [("India, elected to bat first",), ("India",), (None,)], "t string")
    assert [tuple(g) for g in got] == [("India", "elected to bat first"), ("India", None), (None, None)]
    texts = ["India won by 20 runs", "Pakistan won by 5 wickets", "Match tied (India won the Super Over)",
             "No result", "Match tied", "Brunei won by 5 wickets", None, "Abandoned"]
    got = evaluate(spark, lambda: F.struct(parse.result_winner(F.col("t")), parse.result_margin(F.col("t")),
                                           parse.result_type(F.col("t"))), [(t,) for t in texts], "t string")
    assert [tuple(g) for g in got] == [
        ("India", "20 runs", "by runs"), ("Pakistan", "5 wickets", "by wickets"),
        ("", "", "super over"), ("", "", "no result"), ("", "", "tie"),
        ("Brunei", "5 wickets", "by runs"),        # "run" is tested first ("Brunei")
        (None, None, "other"), ("", "", "other"),
    ]
