"""Property test: Spark parsing (Java regex) and the SQL oracle's parsing (DuckDB, RE2) agree.

Generated delivery texts mix names with apostrophes, hyphens, digits and accents, odd
separators and unusual outcomes. Commentary uses ASCII names: Java's word boundary
treats accented letters as word characters and RE2's does not (an engine difference).
"""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitchlake.operators import silver
from pitchlake.plans import oracle

WORDS = ["Joe", "Root", "O'Brien", "Curran-Jones", "de", "Villiers", "Fabián", "J2", "Khan", "Amir", "st", "b"]
ASCII = [w for w in WORDS if w.isascii()]
OUTCOMES = ["no run", "1 run", "2 runs", "FOUR runs", "SIX runs", "1 wide", "5 wides", "(no ball) 1 run",
            "(no ball) FOUR runs", "(no ball) 2 leg byes", "1 leg bye", "2 byes", "OUT", "OUT, 1 run", "SIX",
            "12 runs", "", "3 (no ball)", "wide", "no ball", "99999999999 runs"]
COLS = ["bowler_short", "batsman_short", "runs_text", "Extras", "over", "over_ball_number", "runs",
        "dismissal_method", "dismissed_by"]

name = st.lists(st.sampled_from(WORDS), min_size=1, max_size=3).map(" ".join)
ascii_name = st.lists(st.sampled_from(ASCII), min_size=1, max_size=2).map(" ".join)


@st.composite
def event(draw):
    kind = draw(st.integers(0, 9))
    if kind == 0:
        return None
    if kind == 1:
        return "Drinks break"
    sep = draw(st.sampled_from([", ", ",", ",   ", " , "]))
    return f"{draw(name)} to {draw(name)}{sep}{draw(st.sampled_from(OUTCOMES))}"


@st.composite
def commentary(draw):
    b, w, f = draw(ascii_name), draw(ascii_name), draw(ascii_name)
    n = draw(st.integers(0, 99))
    return draw(st.sampled_from([
        f"{b} c {f} b {w} {n} ({n}b)", f"{b} b {w} {n} ({n}b)", f"{b} lbw b {w} {n} ({n}b)",
        f"{b} lbw b {w}", f"{b} st †{f} b {w} {n} ({n}b)", f"{b} run out ({f}/†{w}) {n} ({n}b)",
        f"{b} c & b {w} {n} ({n}b)", f"{b} hit wicket b {w} {n} ({n}b)", f"{b} retired out {n} ({n}b)",
        f"first slip {b} st {f} b {w} {n} (", "Played to the off side", "",
    ]))


row = st.tuples(event(), st.sampled_from(["0.1", "19.6", "7", "", "0.10", "a.b", "1.2.3", None]), commentary())


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=200, max_size=200))
def test_spark_and_sql_parsing_agree(spark, rows):
    data = [(i, e, b, c) for i, (e, b, c) in enumerate(rows)]
    df = spark.createDataFrame(data, "i long, event string, ball string, commentary string")
    got = {r.i: tuple(r[c] for c in COLS) for r in silver.parse_deliveries(df).select("i", *COLS).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE src (i BIGINT, event VARCHAR, ball VARCHAR, commentary VARCHAR)")
    con.executemany("INSERT INTO src VALUES (?, ?, ?, ?)", data)
    sql = "WITH " + oracle._parse_cte("src", "p").strip() + f" SELECT i, {', '.join(COLS)} FROM p"
    want = {r[0]: tuple(r[1:]) for r in con.sql(sql).fetchall()}
    diff = [(data[i], got[i], want[i]) for i in got if got[i] != want[i]]
    assert not diff, diff[:3]
