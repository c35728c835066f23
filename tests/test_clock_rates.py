"""Match dates, local session times to UTC, zone lookup and rate formulas."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import evaluate
from pitchlake.functions import clock, rates
from pitchlake.operators import lookups, silver
from pitchlake.sources import proxies


def test_match_date(spark):
    got = evaluate(spark, lambda: clock.match_date(F.col("d")),
                   [("21 February 2026 - night (20-over match)",), ("date unknown",), (None,),
                    ("31 February 2026",), ("5 January 2020",)], "d string")
    assert got == [dt.date(2026, 2, 21), None, None, None, dt.date(2020, 1, 5)]


def _sessions(spark, rows):
    df = spark.createDataFrame(rows, "ground string, hours_of_play_local_time string, match_days string, toss string")
    return silver.enrich_metadata(df, proxies.zones(spark)).orderBy("match_days").collect()


def test_session_times_to_utc(spark):
    rows = _sessions(spark, [
        ("Mumbai", "9.30 start, First Session 9.30-11.00, Second Session 11.20-12.50", "5 January 2020", "India"),
        ("Nowhere", "19.30 start, First Session 19.30-21.00, Second Session 21.20-22.50", "6 January 2020", "x, y"),
        ("Lords", "25.99 start, First Session 25.99-26.00", "7 January 2020", None),
        ("Mumbai", "23.30 start, First Session 23.30-01.00", "8 January 2020", None),
        (None, None, None, None),
    ])
    r = {x.match_days: x for x in rows}
    a = r["5 January 2020"]
    assert a.local_timezone == "Asia/Kolkata"
    assert a.match_start_utc == dt.datetime(2020, 1, 5, 4, 0)
    assert a.first_innings_end_utc == dt.datetime(2020, 1, 5, 5, 30)
    assert a.second_innings_start_utc == dt.datetime(2020, 1, 5, 5, 50)
    b = r["6 January 2020"]
    assert b.local_timezone == "UTC" and b.match_start_utc == dt.datetime(2020, 1, 6, 19, 30)
    assert (b.toss, b.decision) == ("x", "y")
    c = r["7 January 2020"]
    assert c.match_start_utc is None and c.first_innings_start_utc is None     # invalid hour -> NULL
    d = r["8 January 2020"]
    # sessions past midnight keep the match date (no roll-over)
    assert d.first_innings_end_utc < d.first_innings_start_utc
    assert r[None].local_timezone == "UTC" and r[None].match_start_utc is None


def test_zone_dimension_is_validated(spark):
    good = proxies.zones(spark)
    assert lookups.zone_dimension(good).count() == len(proxies.ZONES)
    bad = spark.createDataFrame([("Somewhere", "Mars/Olympus")], "ground string, local_timezone string")
    try:
        lookups.zone_dimension(bad)
    except ValueError as e:
        assert "Mars/Olympus" in str(e)
    else:
        raise AssertionError("invalid zone accepted")


def test_zone_dimension_has_no_cap(spark):
    many = spark.range(150_000).select(F.concat(F.lit("Ground "), "id").alias("ground"), F.lit("Asia/Kolkata").alias("local_timezone"))
    assert lookups.zone_dimension(many).count() == 150_000


def test_utc_times_do_not_depend_on_the_session_zone(spark):
    rows = [("Mumbai", "5 January 2024 - night", "19.30 start, First Session 19.30-21.00, Second Session 21.20-22.50")]
    before = spark.conf.get("spark.sql.session.timeZone")
    got = set()
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame(rows, "ground string, match_days string, hours_of_play_local_time string")
            df = df.withColumn("toss", F.lit(None).cast("string"))
            r = silver.enrich_metadata(df, proxies.zones(spark)).select(
                *[F.unix_timestamp(c) for c in ("match_start_utc", "first_innings_end_utc", "second_innings_end_utc")]).first()
            got.add(tuple(r))
            assert spark.conf.get("spark.sql.session.timeZone") == zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {(1704463200, 1704468600, 1704475200)}


def test_rates(spark):
    got = evaluate(spark, lambda: F.struct(
        rates.strike_rate(F.col("r"), F.col("b")), rates.batting_average(F.col("r"), F.col("w")),
        rates.overs_notation(F.col("b")), rates.economy_rate(F.col("r"), F.col("b")),
        rates.bowling_average(F.col("r"), F.col("w")), rates.bowling_strike_rate(F.col("b"), F.col("w"))),
        [(0, 0, 0), (23, 23, 0), (37, 23, 2), (10, 3, 3)], "r long, b long, w long")
    assert [tuple(g) for g in got] == [
        (0.0, 0.0, 0.0, 0.0, None, None),
        (100.0, 23.0, 3.5, 6.0, None, None),        # never dismissed: average = runs
        (160.87, 18.5, 3.5, 9.65, 18.5, 11.5),
        (333.33, 3.33, 0.3, 20.0, 3.33, 1.0),
    ]


def test_scratch_folder_is_required_on_a_cluster():
    import pytest

    from pitchlake import session

    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Context:
        master = "yarn"
        getConf = staticmethod(lambda: Conf)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError):
        session.scratch_root(Session)


def test_zone_dimension_one_row_per_ground(spark):
    zones = spark.createDataFrame([("Lords", "Europe/London"), ("Lords", "Europe/Dublin"), ("Mumbai", "Asia/Kolkata")],
                                  "ground string, local_timezone string")
    got = sorted(tuple(r) for r in lookups.zone_dimension(zones).collect())
    assert got == [("Lords", "Europe/Dublin"), ("Mumbai", "Asia/Kolkata")]


def test_settings_require_paths(spark):
    import pytest

    from pitchlake import settings
    with pytest.raises(ValueError):
        settings.from_conf(spark)
    s = settings.from_conf(spark, source_path="/in", lake_root="/lake")
    assert (s.source_path, s.lake_root, s.run_id) == ("/in", "/lake", "default")
