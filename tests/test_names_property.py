"""Property test: the native resolver agrees with the SQL resolver of the oracle."""

import os
import sys

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pitchlake.functions import names as N  # noqa: E402
from pitchlake.plans import oracle  # noqa: E402

WORDS = ["Joe", "Root", "Ben", "Stokes", "de", "van", "Villiers", "AB", "Mohammad", "Amir", "Sam",
         "Curran", "Tom", "Curran-Jones", "O'Brien", "India", "South", "Africa", "New", "Zealand", "J"]

name = st.lists(st.sampled_from(WORDS), min_size=1, max_size=4).map(" ".join)


@st.composite
def case(draw):
    names = draw(st.lists(name, min_size=0, max_size=8, unique=True))
    form = draw(st.sampled_from(["initials", "last", "first", "prefix", "tail", "code", "word", "blank"]))
    base = draw(st.sampled_from(names)) if names else draw(name)
    parts = base.split()
    if form == "initials":
        short = "".join(p[0] for p in parts)
    elif form == "last":
        short = parts[-1]
    elif form == "first":
        short = parts[0]
    elif form == "prefix":
        short = parts[0][: draw(st.integers(1, max(1, len(parts[0]))))]
    elif form == "tail":
        short = " ".join(parts[-draw(st.integers(1, len(parts))):])
    elif form == "code":
        short = draw(st.sampled_from(["IND", "SA", "RSA", "NZ", "nz", "ENG", "XYZ"]))
    elif form == "word":
        short = draw(st.sampled_from(WORDS))
    else:
        short = draw(st.sampled_from(["", "  ", " Root ", "Root  Joe"]))
    if draw(st.booleans()):
        short = short.lower() if draw(st.booleans()) else short.upper()
    return short, names


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(case(), min_size=150, max_size=150))
def test_native_matches_sql_rules(spark, cases):
    con = duckdb.connect()
    con.execute("CREATE TABLE c (i INT, s VARCHAR, n VARCHAR[])")
    con.executemany("INSERT INTO c VALUES (?, ?, ?)", [[i, s, sorted(lst)] for i, (s, lst) in enumerate(cases)])
    expected = [r[0] for r in con.execute(f"SELECT {oracle._resolve('s', 'n')} FROM c ORDER BY i").fetchall()]
    df = spark.createDataFrame([(i, s, lst) for i, (s, lst) in enumerate(cases)],
                               "i int, short string, names array<string>")
    got = [r.r for r in df.select("i", N.resolve_in_list(F.col("short"), F.col("names")).alias("r"))
           .orderBy("i").collect()]
    mismatches = [(c, e, g) for c, e, g in zip(cases, expected, got) if e != g]
    assert not mismatches, mismatches[:5]
