"""Gold datasets: invariants on the fixture, SCD2 cases, hot-key running sums."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pitchlake.operators import batting, bowling, innings, silver, spans
from pitchlake.plans import catalog
from pitchlake.sources import proxies


def _silver(spark):
    f = proxies.feeds(spark, SF_SMALL)
    players = silver.silver_players(silver.as_bronze(f["players"]))
    meta = silver.silver_metadata(silver.as_bronze(f["metadata"]), players, f["zones"])
    events = silver.silver_events(silver.as_bronze(f["deliveries"]), players)
    return players, meta, events


def test_batting_invariants(spark):
    _, meta, events = _silver(spark)
    per_match = batting.batting_per_match(events, meta)
    balls = per_match.agg(F.sum("balls_faced")).first()[0]
    assert balls == events.where("Extras != 'wide'").count()
    runs = per_match.agg(F.sum("total_runs")).first()[0]
    assert runs == events.where("Extras NOT IN ('wide', 'byes', 'legbyes')").agg(F.sum("runs")).first()[0]
    per_series = batting.batting_per_series(per_match)
    overall = batting.batting_overall(per_series)
    assert overall.agg(F.sum("total_runs")).first()[0] == runs
    assert overall.agg(F.sum("total_balls_faced")).first()[0] == balls


def test_bowling_invariants(spark):
    _, meta, events = _silver(spark)
    per_match = bowling.bowling_per_match(events, meta)
    with_bowler = events.where(F.col("bowler").isNotNull())
    assert per_match.agg(F.sum("total_deliveries")).first()[0] == with_bowler.count()
    legal = with_bowler.where("Extras NOT IN ('wide', 'noball')").count()
    assert per_match.agg(F.sum("legal_balls_bowled")).first()[0] == legal
    # maidens from the two-level aggregate equal a direct over-level count
    direct = (with_bowler.groupBy("matchid", "bowler", "over")
              .agg(F.sum(F.when(F.col("Extras").isin("wide", "noball"), 0).otherwise(1)).alias("l"),
                   F.sum(F.when(F.col("Extras").isin("legbyes", "byes"), 0).otherwise(F.col("runs"))).alias("r"))
              .where("l = 6 AND r = 0").count())
    assert per_match.agg(F.sum("maiden_overs")).first()[0] == direct > 0
    overall = bowling.bowling_overall(bowling.bowling_per_series(per_match))
    assert overall.agg(F.sum("total_deliveries")).first()[0] == with_bowler.count()


def test_innings_final_score_is_sum(spark):
    _, _, events = _silver(spark)
    prog = innings.innings_progress(events)
    keys = ["matchid", "team", "super_over_team"]
    last = prog.groupBy(*keys).agg(F.max_by("innings_score", F.struct("over", "match_ball_number")).alias("last"),
                                   F.sum("runs").alias("total"))
    assert last.where("last != total").count() == 0


def test_hot_key_chunks_equal_plain_window(spark):
    _, _, events = _silver(spark)
    # one artificial hot key: every delivery in the same innings key
    hot = events.withColumns({
        "match_ball_number": (F.col("matchid") - 1000) * 240 + F.col("match_ball_number"),  # keep order total
        "matchid": F.lit(None).cast("long"),
        "team": F.lit(None).cast("string"),
    })
    cols = ["match_ball_number", "over", "over_ball_number", "event", "innings_score", "wickets_lost"]
    for df in (events, hot):
        a = innings.innings_progress(df).select(*cols)
        b = innings.innings_progress(df, chunk_rows=64).select(*cols)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_chunks_are_bounded_by_rows(spark):
    # one key holds all rows, all with equal order values: the ranges stay small as the rows grow tenfold
    for n in (2_000, 20_000):
        hot = spark.range(n).select(
            *[F.lit(None).cast(t).alias(c) for c, t in (("matchid", "long"), ("team", "string"), ("super_over_team", "string"),
                                                        ("over", "int"), ("match_ball_number", "long"),
                                                        ("over_ball_number", "int"), ("event", "string"))],
            F.lit(1).alias("runs"), F.lit("Not Out").alias("dismissal_method"))
        sizes = [r["count"] for r in innings.chunks(hot, 500).groupBy("_chunk").count().collect()]
        assert sum(sizes) == n and max(sizes) <= 1_000
        assert innings.innings_progress(hot, chunk_rows=500).agg(F.max("innings_score"), F.count_distinct("innings_score")).first() == (n, n)


def _scd2(spark, rows):
    app = spark.createDataFrame(rows, "matchid long, player_name string, team string")
    dates = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 2, 1)), (3, dt.date(2020, 3, 1)),
                                   (4, None)], "matchid long, match_date date")
    out = spans.player_team_scd2(spans.player_team_spans(app, dates))
    return sorted(tuple(r) for r in out.collect())


def test_scd2_cases(spark):
    d1, d2, d3 = dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2020, 3, 1)
    # one team
    assert _scd2(spark, [(1, "A", "X"), (2, "A", "X")]) == [("A", "X", d1, None, True, 2)]
    # two teams
    assert _scd2(spark, [(1, "A", "X"), (2, "A", "Y")]) == [("A", "X", d1, d2, False, 1), ("A", "Y", d2, None, True, 1)]
    # equal first dates: ordered by team name
    assert _scd2(spark, [(1, "A", "Y"), (1, "A", "X")]) == [("A", "X", d1, d1, False, 1), ("A", "Y", d1, None, True, 1)]
    # return to a former team collapses into one span
    assert _scd2(spark, [(1, "A", "X"), (2, "A", "Y"), (3, "A", "X")]) == [
        ("A", "X", d1, d2, False, 2), ("A", "Y", d2, None, True, 1)]
    # undated matches are left out
    assert _scd2(spark, [(4, "B", "Z")]) == []


def test_scd2_one_active_per_player(spark):
    players, meta, events = _silver(spark)
    out = spans.player_team_scd2(spans.player_team_spans(spans.appearances(events, players), meta))
    active = out.groupBy("player_name").agg(F.count_if("is_active").alias("n"))
    assert active.where("n != 1").count() == 0
    # end_date equals the next span's start_date
    from pyspark.sql import Window
    w = Window.partitionBy("player_name").orderBy("start_date", "team")
    chk = out.withColumn("nxt", F.lead("start_date").over(w))
    assert chk.where(~F.col("end_date").eqNullSafe(F.col("nxt"))).count() == 0


def test_null_key_bypass_gives_same_rows(spark):
    f = proxies.feeds(spark, SF_SMALL)
    players = silver.silver_players(silver.as_bronze(f["players"]))
    d = f["deliveries"].withColumn(
        "matchid", F.when(F.col("match_ball_number") % 3 == 0, F.lit(None).cast("long")).otherwise(F.col("matchid")))
    bronze = silver.as_bronze(d)
    cols = ["matchid", "match_ball_number", "bowler", "batsman", "team", "super_over_team", "runs", "Extras"]
    a = silver.silver_events(bronze, players).select(*cols)
    b = silver.silver_events(bronze, players, null_keys_bypass=True).select(*cols)
    assert a.count() == b.count() == d.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # rows without a matchid keep their short names (nothing to resolve against)
    assert b.where("matchid IS NULL AND team NOT IN ('IND', 'AUS', 'ENG', 'PAK', 'NZ', 'WI', 'SL', 'HK') "
                   "AND team NOT LIKE '% Super Over'").count() == 0


def test_events_partitioned_by_match_are_read_by_few_tasks(spark, tmp_path):
    spark.range(2400).selectExpr("id as event_id", "id % 7 as user_id").write.parquet(str(tmp_path / "events.parquet"))  # 10 matches
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4194304")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for query in (catalog.gold_match_events, catalog.ingest_events_table):
            found = query(spark, str(tmp_path))
            assert len(found.inputFiles()) >= 10
            assert "Coalesce 2" in found._jdf.queryExecution().executedPlan().toString()
            assert found.select("matchid").distinct().count() == 10
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
