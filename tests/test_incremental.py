"""Incremental gold refresh equals a full recomputation after each run."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pitchlake.operators import batting, bowling, innings, silver, spans, summary
from pitchlake.sources import files, proxies
from pitchlake.sources.layout import Lake
from pitchlake.streaming import incremental, medallion
from pitchlake.streaming.incremental import BUCKET, bucket_of, refresh_gold

FMT = {"deliveries": "csv", "metadata": "json", "players": "csv"}
TABLE = {"deliveries": "match_events", "metadata": "match_metadata", "players": "match_players"}


def _same(a, b):
    drop = ("gold_load_timestamp", BUCKET, "silver_load_timestamp", "load_timestamp")
    a = a.drop(*[c for c in drop if c in a.columns])
    b = b.drop(*[c for c in drop if c in b.columns]).select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _expected(spark, lake):
    ev = lake.read(spark, "silver", "match_events")
    meta = lake.read(spark, "silver", "match_metadata")
    pl = lake.read(spark, "silver", "match_players")
    per_match = batting.batting_per_match(ev, meta)
    bowl = bowling.bowling_per_match(ev, meta)
    return {
        "match_events": innings.gold_events(ev),
        "batting_stats_per_match": per_match,
        "batting_stats_per_series": batting.batting_per_series(per_match),
        "batting_stats_overall": batting.batting_overall(batting.batting_per_series(per_match)),
        "bowling_stats_per_match": bowl,
        "bowling_stats_overall": bowling.bowling_overall(bowling.bowling_per_series(bowl)),
        "match_summary": summary.match_summary(meta),
        "player_team_scd2": spans.player_team_scd2(spans.player_team_spans(spans.appearances(ev, pl), meta)),
    }


def test_refresh_matches_full_build(spark, tmp_path):
    f = proxies.feeds(spark, SF_SMALL)
    roots = {TABLE[k]: str(tmp_path / k) for k in FMT}
    lake = Lake(str(tmp_path / "lake"))
    first = {
        "deliveries": F.col("matchid") <= 1002,
        "players": F.col("matchid") <= 1002,
        "metadata": F.col("matchid") <= 1001,          # metadata of 1002 arrives late
    }
    names = dict.fromkeys(medallion.BRONZE_TABLES, "part-*")
    touched_runs = []
    for run in range(2):
        for feed, cond in first.items():
            part = f[feed].where(cond if run == 0 else ~cond)
            files.write_feed(part, roots[TABLE[feed]], FMT[feed], mode="overwrite" if run == 0 else "append")
        medallion.run_bronze(spark, roots, lake, run_id=f"r{run}", file_names=names)
        medallion.run_silver(spark, lake, f["zones"], buckets=16)
        touched_runs.append(refresh_gold(spark, lake, buckets=16))
        for name, expected in _expected(spark, lake).items():
            assert _same(lake.read(spark, "gold", name), expected), (run, name)
    # the second run only rewrote the buckets of matches that received rows
    changed = {r[0] for r in f["deliveries"].where(~first["deliveries"]).select(
        bucket_of(F.col("matchid"), 16)).distinct().collect()}
    changed |= {r[0] for r in spark.createDataFrame([(1002,)], "matchid long").select(
        bucket_of(F.col("matchid"), 16)).collect()}
    assert set().union(*map(set, touched_runs[1])) == changed


def test_only_touched_groups_are_rebuilt(spark, tmp_path):
    """Rows of other groups keep their load time; a group that loses its matches disappears; a retry repairs a failed refresh."""
    f = proxies.feeds(spark, SF_SMALL)
    lake = Lake(str(tmp_path / "lake"))
    ev = silver.silver_events(silver.as_bronze(f["deliveries"]), f["players"])
    meta = silver.silver_metadata(silver.as_bronze(f["metadata"]), f["players"], f["zones"])
    late = meta.where("matchid <> 1002")  # one match without metadata: series and season are NULL
    for name, df in (("match_events", ev), ("match_players", silver.silver_players(silver.as_bronze(f["players"]))), ("match_metadata", late)):
        lake.overwrite(df, "silver", name)
    buckets = [r[0] for r in ev.select(bucket_of(F.col("matchid"), 16)).distinct().collect()]
    incremental.refresh_buckets(spark, lake, buckets, 16)
    before = lake.read(spark, "gold", "batting_stats_per_series")
    times = {(r.series, r.season, r.batsman): r.gold_load_timestamp for r in before.collect()}
    assert any(series is None for series, _, _ in times)

    lake.overwrite(meta, "silver", "match_metadata")
    one = [r[0] for r in spark.createDataFrame([(1002,)], "matchid long").select(bucket_of(F.col("matchid"), 16)).collect()]
    # the first attempt fails after the per-match tables were rewritten
    real = incremental._refresh_groups
    try:
        incremental._refresh_groups = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
        with pytest.raises(RuntimeError):
            incremental.refresh_buckets(spark, lake, one, 16, batch="b1")
    finally:
        incremental._refresh_groups = real
    incremental.refresh_buckets(spark, lake, one, 16, batch="b1")
    for name, expected in _expected(spark, lake).items():
        assert _same(lake.read(spark, "gold", name), expected), name
    after = {(r.series, r.season, r.batsman): r.gold_load_timestamp for r in lake.read(spark, "gold", "batting_stats_per_series").collect()}
    assert not any(series is None for series, _, _ in after)
    touched = {(r.series, r.season, r.batsman) for r in lake.read(spark, "gold", "batting_stats_per_match").where("matchid = 1002").collect()}
    assert touched and all((after[k] > times[k]) == (k in touched) for k in after if k in times)
    assert any(k not in touched for k in after)


def test_refresh_joins_are_sized_by_rows_not_files(spark, tmp_path, monkeypatch):
    """A side whose files are far smaller than its rows, as repeated names make them, is not broadcast by its files' size."""
    key, path = "spark.sql.autoBroadcastJoinThreshold", str(tmp_path / "t")
    spark.range(4000).select("id", F.repeat(F.lit("ab"), 500).alias("name")).write.parquet(path)  # 4 MB of rows
    before, plans = spark.conf.get(key), []

    def refresh(*_):
        for side in (spark.read.parquet(path), spark.read.parquet(path).where("id < 5")):
            joined = spark.read.parquet(path).withColumnRenamed("name", "other").join(side, "id")
            assert len(joined.collect()) in (4000, 5)
            plans.append(joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])

    monkeypatch.setattr(incremental, "_groups_of", refresh)
    monkeypatch.setattr(incremental, "_only", lambda df, *_: df)
    lake = Lake(str(tmp_path / "lake"))
    for name in incremental.SILVER_TABLES:
        lake.overwrite(spark.createDataFrame([(1,)], "matchid long"), "silver", name)
    spark.conf.set(key, "2m")
    try:
        with pytest.raises(AttributeError):  # there is nothing to refresh
            incremental.refresh_buckets(spark, lake, [0], 16)
        assert spark.conf.get(key) == "2m" and spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None
    finally:
        spark.conf.set(key, before)
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]
    assert "BroadcastHashJoin" in plans[1]  # small ones still are
