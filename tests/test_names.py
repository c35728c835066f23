"""Name resolver rules, order and fall-throughs."""

from pyspark.sql import functions as F

from pitchlake.functions import names as N

CASES = [
    # (short, list, expected)
    ("Joe Root", ["Joe Root", "Ben Stokes"], "Joe Root"),                 # exact member
    ("IND", ["India", "Pakistan"], "India"),                              # known abbreviation
    ("ind", ["India", "Pakistan"], "India"),                              # case-insensitive code
    ("IND", ["Pakistan", "Sri Lanka"], "IND"),                            # code not in list: unchanged
    ("SA", ["South Africa", "Sri Lanka"], "South Africa"),
    ("RSA", ["Sri Lanka", "South Africa"], "South Africa"),
    ("RS", ["Rohit Sharma", "Ben Stokes"], "Rohit Sharma"),               # all initials
    ("AV", ["AB de Villiers"], "AB de Villiers"),                         # upper-case initials only
    ("Rohit", ["Ben Stokes", "Rohit Sharma"], "Rohit Sharma"),            # prefix
    ("Root", ["Root Smith", "Joe Root"], "Joe Root"),                     # sorted list: last name of the 1st
    ("de Villiers", ["AB de Villiers"], "AB de Villiers"),                # last N words of a longer name
    ("J", ["Joe Root"], "J"),                                             # one letter: no prefix rule
    ("IND Super Over", ["India"], "IND Super Over"),
    ("Root", None, "Root"),
    ("Root", [], "Root"),
    ("Root", ["", "Joe Root"], "Joe Root"),                               # blank element never matches a word
    (None, ["Joe Root"], None),
    ("", ["Joe Root"], ""),
    ("  Root ", ["Joe Root"], "Joe Root"),                                # surrounding whitespace ignored
    ("Nobody", ["Joe Root"], "Nobody"),
]


def test_resolver_cases(spark):
    rows = [(i, s, lst) for i, (s, lst, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, short string, names array<string>")
    got = df.select("i", N.resolve_in_list(F.col("short"), F.col("names")).alias("r")).orderBy("i").collect()
    assert [r.r for r in got] == [e for _, _, e in CASES]


def test_resolver_is_native(spark):
    df = spark.createDataFrame([("RS", ["Rohit Sharma"])], "short string, names array<string>")
    plan = df.select(N.resolve_in_list(F.col("short"), F.col("names")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_entries_are_sorted(spark):
    df = spark.createDataFrame([(1, "Joe Root"), (1, "Ben Stokes"), (1, "Joe Root"), (1, None)], "m int, n string")
    out = df.groupBy("m").agg(N.collect_name_index(F.col("n")).alias("e")).select(N.index_names(F.col("e"))).first()[0]
    assert out == ["Ben Stokes", "Joe Root"]
