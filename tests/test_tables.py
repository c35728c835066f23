"""Catalog tables: description, partitions, publishing, buckets; names that came late; the violation log."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pitchlake.operators import batting, bowling, innings, silver
from pitchlake.sources import files, proxies, tables
from pitchlake.sources.layout import Lake
from pitchlake.streaming import medallion, quality_log, repair
from pitchlake.streaming.runner import append


@pytest.fixture(scope="module")
def feeds(spark):
    return proxies.feeds(spark, SF_SMALL)


@pytest.fixture()
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE db_tables LOCATION '{tmp_path}/db'")
    yield "db_tables"
    spark.sql("DROP DATABASE db_tables CASCADE")


def test_stream_into_a_described_partitioned_table(spark, feeds, database, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "t")
    files.write_feed(feeds["players"], src, "csv")
    stream = files.players(spark, src, file_name="part-*")
    name = tables.create_layer_table(spark, "bronze", "match_players", stream.schema, out, database=database, partition_by=("matchid",))
    for rows in (1, 2):
        append(stream, None, str(tmp_path / "ck"), partition_by=("matchid",), table=name)
        assert spark.table(name).count() == rows * feeds["players"].count()
        files.write_feed(feeds["players"], src, "csv", mode="append")
    about = tables.describe(spark, name)
    assert about["partition_by"] == ["matchid"] and about["properties"]["quality"] == "bronze"
    assert about["comment"] == tables.COMMENTS["bronze_match_players"]
    plan = spark.table(name).where("matchid = 1001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(matchid" in plan
    assert spark.conf.get("spark.sql.hive.manageFilesourcePartitions") == "true"


@pytest.mark.parametrize("partition_by", [(), ("matchid",)])
def test_readers_see_old_or_new_rows(spark, feeds, database, tmp_path, partition_by):
    name, root = f"{database}.published", str(tmp_path / "v")
    all_ = feeds["players"]
    some = all_.where("matchid % 2 = 0")
    assert tables.publish(some, name, root, partition_by=partition_by, comment="it's \"quoted\" \\", properties={"a.b": "c'd"}) is None
    holding, n = spark.table(name), some.count()
    # a rebuild that fails leaves the table as it was
    with pytest.raises(Exception):
        tables.publish(all_.withColumn("bad", F.raise_error(F.lit("no"))), name, root, partition_by=partition_by)
    assert spark.table(name).count() == n
    old = tables.publish(all_, name, root, partition_by=partition_by)
    assert holding.count() == n and spark.table(name).count() == all_.count()
    about = tables.describe(spark, name)
    assert about["comment"] == "it's \"quoted\" \\" and about["properties"]["a.b"] == "c'd" and about["location"] != old
    tables.retire(spark, old)
    assert spark.table(name).count() == all_.count()
    with pytest.raises(Exception):
        spark.read.parquet(old).count()


def test_bucketed_snapshots_need_no_exchange_of_deliveries(spark, feeds, database, tmp_path):
    events = silver.silver_events(silver.as_bronze(feeds["deliveries"]), feeds["players"])
    meta = silver.silver_metadata(silver.as_bronze(feeds["metadata"]), feeds["players"], feeds["zones"])
    e, m = (tables.write_bucketed(df, f"{database}.{n}", str(tmp_path / n), 4) for n, df in (("e", events), ("m", meta)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (batting.batting_per_match(e, m), bowling.bowling_per_match(e, m), innings.innings_progress(e)):
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert "Exchange" not in plan, plan
            assert "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _names(df):
    return {(r.matchid, r.match_ball_number): (r.team, r.batsman, r.bowler) for r in df.collect()}


def test_late_lineups_are_repaired_in_their_buckets(spark, feeds, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    zones = proxies.zones(spark)
    roots = {t: str(tmp_path / t) for t in medallion.BRONZE_TABLES}
    files.write_feed(feeds["deliveries"], roots["match_events"], "csv")
    files.write_feed(feeds["metadata"], roots["match_metadata"], "json")
    bronze = lambda: medallion.run_bronze(spark, roots, lake, file_names=dict.fromkeys(roots, "part-*"))
    read = lambda name: repair.current(spark, lake, "silver", name)
    want = _names(silver.silver_events(silver.as_bronze(feeds["deliveries"]), feeds["players"]))

    files.write_feed(feeds["players"].where("matchid in (1000, 1001)"), roots["match_players"], "csv")
    bronze()
    medallion.run_silver(spark, lake, zones)
    assert repair.repair(spark, lake, zones, buckets=8) == []  # nothing was late
    before = _names(read("match_events"))
    assert all(before[k] == want[k] for k in want if k[0] <= 1001) and any(before[k] != want[k] for k in want)

    files.write_feed(feeds["players"].where("matchid in (1002, 1003)"), roots["match_players"], "csv", mode="append")
    bronze()
    medallion.run_silver(spark, lake, zones)
    touched = repair.repair(spark, lake, zones, buckets=8)
    assert touched and repair.repair(spark, lake, zones, buckets=8) == []  # once
    after = _names(read("match_events"))
    assert all(after[k] == (want if k[0] <= 1003 else before)[k] for k in want) and len(after) == len(want)

    # the last match, and one more player of a match repaired before
    files.write_feed(feeds["players"].where("matchid = 1004"), roots["match_players"], "csv", mode="append")
    files.write_feed(feeds["players"].where("matchid = 1003").limit(1).withColumn("player_name", F.lit("New Name")),
                     roots["match_players"], "csv", mode="append")
    bronze()
    medallion.run_silver(spark, lake, zones)
    assert repair.repair(spark, lake, zones, buckets=8)
    assert _names(read("match_events")) == want
    meta = {r.matchid: (r.first_innings, r.second_innings) for r in read("match_metadata").collect()}
    assert meta == {r.matchid: (r.first_innings, r.second_innings) for r in
                    silver.silver_metadata(silver.as_bronze(feeds["metadata"]), feeds["players"], feeds["zones"]).collect()}
    medallion.build_gold(spark, lake, tables=("match_summary",), repaired=True)
    assert lake.read(spark, "gold", "match_summary").count() == feeds["metadata"].count()


def test_violation_log_keeps_runs(spark, tmp_path):
    lake = Lake(str(tmp_path))
    rows = [("r1", "d", 0, "rule", 10, 2), ("r1", "d", 1, "rule", 5, 0), ("r2", "d", 0, "rule", 7, 7)]
    quality_log.record(spark, lake, rows[:2])
    quality_log.record(spark, lake, rows)  # r1 again, as after a failure
    quality_log.record(spark, lake, [])
    got = {(r.run_id, r.micro_batches, r.total_rows, r.failed_rows) for r in quality_log.history(spark, lake).collect()}
    assert got == {("r1", 2, 15, 2), ("r2", 1, 7, 7)}
