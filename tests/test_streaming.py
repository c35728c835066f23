"""Incremental file ingest, stateful de-duplication across runs, stream == batch."""

import csv
import gc
import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter, StreamingQuery

from conftest import SF_SMALL
from pitchlake import schemas, session
from pitchlake.operators import lookups, quality, silver
from pitchlake.plans import catalog
from pitchlake.sources import files, proxies
from pitchlake.sources.layout import Lake
from pitchlake.streaming import medallion, quality_log
from pitchlake.streaming.runner import append, observed_metrics

EVENT_HEADER = ["match_ball_number", "ball", "event", "commentary", "bowler", "batsman", "innings", "is_super_over"]


def _write_events(root, matchid, n, name="match_events_data.csv"):
    d = os.path.join(root, f"matchid={matchid}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(EVENT_HEADER)
        for i in range(n):
            w.writerow([i + 1, f"0.{i + 1}", "A to B, 1 run", "Played to the off side", "A", "B", "IND", "false"])


def test_ingest_reads_each_file_once(spark, tmp_path):
    src, lake = str(tmp_path / "src"), Lake(str(tmp_path / "lake"))
    _write_events(src, 1, 3)
    _write_events(src, 2, 4)
    _write_events(src, 2, 5, name="notes.csv")  # other file names are ignored
    out, ckpt = lake.table("bronze", "match_events"), lake.checkpoint("bronze", "match_events")
    append(files.events(spark, src, run_id="r1"), out, ckpt)
    first = spark.read.parquet(out)
    assert first.count() == 7
    assert {r.matchid for r in first.select("matchid").distinct().collect()} == {1, 2}
    assert first.where(~F.col("source_file").endswith("match_events_data.csv")).count() == 0
    _write_events(src, 3, 2)
    append(files.events(spark, src, run_id="r2"), out, ckpt)
    again = spark.read.parquet(out)
    assert again.count() == 9
    assert again.where("Batchid = 'r2'").select("matchid").distinct().first()[0] == 3
    append(files.events(spark, src, run_id="r3"), out, ckpt)   # nothing new
    assert spark.read.parquet(out).count() == 9


def test_dedup_state_survives_runs(spark, tmp_path):
    f = proxies.feeds(spark, SF_SMALL)
    players = f["players"]
    root, lake = str(tmp_path / "players"), Lake(str(tmp_path / "lake"))
    out, ckpt = lake.table("silver", "p"), lake.checkpoint("silver", "p")
    files.write_feed(players, root, "csv")
    append(silver.deduplicate(files.players(spark, root, file_name="part-*"), silver.PLAYER_KEYS), out, ckpt)
    n = spark.read.parquet(out).count()
    files.write_feed(players, root, "csv", mode="append")            # exact copies in new files
    append(silver.deduplicate(files.players(spark, root, file_name="part-*"), silver.PLAYER_KEYS), out, ckpt)
    df = spark.read.parquet(out)
    assert n == players.count() == df.count()
    assert df.groupBy(*silver.PLAYER_KEYS).count().where("count > 1").count() == 0


def test_stream_equals_batch_and_observes_rules(spark, tmp_path):
    f = proxies.feeds(spark, SF_SMALL)
    roots = {}
    for feed, table, fmt in (("deliveries", "match_events", "csv"), ("metadata", "match_metadata", "json"),
                             ("players", "match_players", "csv")):
        roots[table] = str(tmp_path / feed)
        files.write_feed(f[feed], roots[table], fmt)
    lake = Lake(str(tmp_path / "lake"))
    medallion.run_bronze(spark, roots, lake, run_id="fixture",
                         file_names=dict.fromkeys(medallion.BRONZE_TABLES, "part-*"))
    medallion.run_silver(spark, lake, f["zones"])
    streamed = lake.read(spark, "silver", "match_events")
    bronze = lake.read(spark, "bronze", "match_events")
    batch = silver.silver_events(bronze, lake.read(spark, "silver", "match_players"))
    cols = [c for c in schemas.SILVER_EVENTS_COLUMNS if c not in ("load_timestamp",)]
    a, b = streamed.select(*cols), batch.select(*cols)
    assert a.count() == f["deliveries"].count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    # quality counts observed on every micro-batch of a stream
    stream = quality.observe_rules(silver.silver_events(
        spark.readStream.schema(bronze.schema).parquet(lake.table("bronze", "match_events")),
        lake.read(spark, "silver", "match_players")), "silver_events")
    q = append(stream, str(tmp_path / "dq_out"), str(tmp_path / "dq_ckpt"))
    metrics = observed_metrics(q)
    assert sum(m["dq_silver_events"]["total_rows"] for m in metrics) == f["deliveries"].count()

    medallion.build_gold(spark, lake, chunk_rows=200, events_partition_by=("matchid",))
    assert dict(lake.read(spark, "gold", "match_events").dtypes)["matchid"] == "bigint"
    gold = lake.read(spark, "gold", "batting_stats_overall")
    assert gold.agg(F.sum("total_balls_faced")).first()[0] == streamed.where("Extras != 'wide'").count()


def test_run_all_from_conf(spark, tmp_path):
    from pitchlake import settings

    src = str(tmp_path / "src")
    _write_events(src, 7, 6)
    os.makedirs(os.path.join(src, "matchid=7"), exist_ok=True)
    with open(os.path.join(src, "matchid=7", "match_players_data.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["innings", "team", "player_name", "batted", "batting_position", "player_type", "retired",
                    "not_out", "bowled"])
        w.writerow(["IND", "India", "Ben Root", "true", 1, "batter", "False", "False", "False"])
        w.writerow(["IND", "India", "Amit Patel", "true", 2, "bowler", "False", "False", "True"])
    with open(os.path.join(src, "matchid=7", "metadata_data.json"), "w") as fh:
        fh.write('{"ground": "Mumbai", "toss": "India, elected to bat first", "series": "S", "season": "2024",'
                 ' "match_days": "5 January 2024 - night", "hours_of_play_local_time": "19.30 start",'
                 ' "first_innings": "IND", "second_innings": "PAK", "has_super_over": false,'
                 ' "super_over_count": 0, "series_result": "India won by 3 runs"}\n')
    spark.conf.set("pitchlake.source_path", src)
    spark.conf.set("pitchlake.lake_root", str(tmp_path / "lake"))
    spark.conf.set("pitchlake.run_id", "conf-run")
    try:
        s = settings.from_conf(spark)
        paths = medallion.run_all(spark, s, proxies.zones(spark))
    finally:
        for k in ("pitchlake.source_path", "pitchlake.lake_root", "pitchlake.run_id"):
            spark.conf.unset(k)
    dq = paths["quality"]
    log = quality_log.history(spark, Lake(str(tmp_path / "lake"))).collect()
    assert {r.run_id for r in log} == {"conf-run"} and len({r.dataset for r in log}) == 7
    assert all(dq[r.dataset][r.rule] == r.failed_rows and dq[r.dataset]["total_rows"] == r.total_rows for r in log)
    assert dq["gold_events"] == {"total_rows": 6, "innings_score_non_negative": 0, "wickets_range": 0}
    assert dq["bronze_events"]["total_rows"] == 6 and dq["bronze_events"]["matchid_not_null"] == 0
    assert dq["silver_events"]["total_rows"] == 6 and dq["silver_metadata"]["match_date_present"] == 0
    bat = spark.read.parquet(paths["batting_stats_per_match"])
    assert bat.select("matchid", "series").distinct().collect()[0].asDict() == {"matchid": 7, "series": "S"}
    summary = spark.read.parquet(paths["match_summary"]).first()
    assert (summary.team_1, summary.winner, summary.result_type) == ("India", "India", "by runs")
    assert spark.read.parquet(os.path.join(str(tmp_path / "lake"), "bronze", "match_events")).where(
        "Batchid = 'conf-run'").count() == 6


def test_late_lineup_leaves_earlier_names_short(spark, tmp_path):
    src, lake = str(tmp_path / "src"), Lake(str(tmp_path / "lake"))
    d = os.path.join(src, "matchid=9")
    os.makedirs(d)

    def events_file(name, ball):
        with open(os.path.join(d, name), "w", newline="") as fh:
            w = csv.writer(fh)
            w.writerow(EVENT_HEADER)
            w.writerow([ball, f"0.{ball}", "Root to Stokes, 1 run", "Played to the off side", "", "", "ENG", "false"])

    events_file("match_events_data.csv", 1)
    names = {"match_events": "match_events_data*.csv", "match_players": "match_players_data.csv",
             "match_metadata": "metadata_data.json"}
    with open(os.path.join(d, "metadata_data.json"), "w") as fh:
        fh.write('{"series": "S", "first_innings": "ENG", "second_innings": "AUS"}\n')
    # run 1: no line-up yet (an empty line-up file keeps the table schema)
    with open(os.path.join(d, "match_players_data.csv"), "w", newline="") as fh:
        csv.writer(fh).writerow(["innings", "team", "player_name", "batted", "batting_position", "player_type",
                                 "retired", "not_out", "bowled"])
    zones = proxies.zones(spark)
    medallion.run_bronze(spark, src, lake, file_names=names)
    medallion.run_silver(spark, lake, zones)
    # run 2: the line-up arrives, with one more delivery
    with open(os.path.join(d, "match_players_data_2.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["innings", "team", "player_name", "batted", "batting_position", "player_type", "retired",
                    "not_out", "bowled"])
        w.writerow(["ENG", "England", "Joe Root", "true", 1, "batter", "False", "False", "False"])
        w.writerow(["ENG", "England", "Ben Stokes", "true", 2, "bowler", "False", "False", "True"])
    events_file("match_events_data_2.csv", 2)
    medallion.run_bronze(spark, src, lake, file_names={**names, "match_players": "match_players_data*.csv"})
    medallion.run_silver(spark, lake, zones)
    rows = {r.match_ball_number: (r.bowler, r.batsman, r.team)
            for r in lake.read(spark, "silver", "match_events").collect()}
    assert rows == {1: ("Root", "Stokes", "ENG"), 2: ("Joe Root", "Ben Stokes", "England")}


def test_quality_totals_cover_every_micro_batch(spark, tmp_path):
    src, lake = str(tmp_path / "src"), Lake(str(tmp_path / "lake"))
    for m in range(1, 6):
        _write_events(src, m, 2)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")   # a session keeping 2 batches
    try:
        df = quality.observe_rules(files.events(spark, src, max_files=1), "bronze_events")
        q = append(df, lake.table("bronze", "e"), lake.checkpoint("bronze", "e"))
        assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == "2"
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(observed_metrics(q)) >= 5
    totals = medallion.quality_summary({"match_events": q}, "bronze")["bronze_events"]
    assert totals["total_rows"] == 10 and totals["source_file_present"] == 0


def test_dedup_within_watermark(spark, tmp_path):
    players = proxies.feeds(spark, SF_SMALL)["players"]
    root, lake = str(tmp_path / "players"), Lake(str(tmp_path / "lake"))
    out, ckpt = lake.table("silver", "p"), lake.checkpoint("silver", "p")
    for run in range(2):
        files.write_feed(players, root, "csv", mode="overwrite" if run == 0 else "append")
        stream = files.players(spark, root, file_name="part-*")
        append(silver.silver_players(stream, watermark="1 hour"), out, ckpt)
    df = spark.read.parquet(out)
    assert df.count() == players.count()
    assert df.groupBy(*silver.PLAYER_KEYS).count().where("count > 1").count() == 0


def test_pretty_printed_metadata_and_backlog_batches(spark, tmp_path):
    src, lake = str(tmp_path / "src"), Lake(str(tmp_path / "lake"))
    for m in (1, 2, 3):
        d = os.path.join(src, f"matchid={m}")
        os.makedirs(d)
        with open(os.path.join(d, "metadata_data.json"), "w") as fh:
            fh.write('{\n  "series": "S%d",\n  "ground": "Lords",\n  "super_over_count": 0\n}\n' % m)
    df = files.metadata(spark, src, multi_line=True, max_files=1)
    q = append(df, lake.table("bronze", "m"), lake.checkpoint("bronze", "m"))
    rows = sorted((r.matchid, r.series) for r in spark.read.parquet(lake.table("bronze", "m")).collect())
    assert rows == [(1, "S1"), (2, "S2"), (3, "S3")]
    assert len([p for p in q.recentProgress if p.numInputRows]) == 3


def test_json_arrays_kept_as_text(spark, tmp_path):
    d = tmp_path / "src" / "matchid=5"
    d.mkdir(parents=True)
    (d / "metadata_data.json").write_text('{"series": "S", "umpires": ["A B", "C D"], "points": {"IND": 2}}\n')
    r = files.metadata(spark, str(tmp_path / "src"), streaming=False).first()
    assert (r.umpires, r.points, r.matchid) == ('["A B", "C D"]', '{"IND": 2}', 5)


def test_partitioned_tables_keep_contract_types(spark, tmp_path):
    roots, lake = {}, Lake(str(tmp_path / "lake"))
    f = proxies.feeds(spark, SF_SMALL)
    for table, feed, fmt in (("match_events", "deliveries", "csv"), ("match_metadata", "metadata", "json"), ("match_players", "players", "csv")):
        roots[table] = str(tmp_path / feed)
        files.write_feed(f[feed], roots[table], fmt)
    medallion.run_bronze(spark, roots, lake, file_names=dict.fromkeys(medallion.BRONZE_TABLES, "part-*"), partition_by=("matchid",))
    medallion.run_silver(spark, lake, f["zones"], partition_by=("matchid",))
    medallion.build_gold(spark, lake)
    for layer, table in (("bronze", "match_events"), ("silver", "match_events"), ("silver", "match_metadata"),
                         ("gold", "match_events"), ("gold", "batting_stats_per_match"), ("gold", "match_summary")):
        assert dict(lake.read(spark, layer, table).dtypes)["matchid"] == "bigint", (layer, table)


def test_csv_is_bound_by_header(spark, tmp_path):
    d = tmp_path / "src" / "matchid=3"
    d.mkdir(parents=True)
    (d / "match_events_data.csv").write_text(
        "\ufeffball, Match_Ball_Number,event,weather,commentary,batsman,Weather\r\n"
        '0.10,7,"Root to Stokes, 1 run",dry,"He said ""well played"", twice",,wet\r\n'
        '0.2,not a number,"Root to \\"Ben\\" Stokes, no run",,C:\\dir\\,Ben\r\n\r\n'
        "0.3,\r\n", encoding="utf-8")
    df = files.events(spark, str(tmp_path / "src"), streaming=False, rescued=True)
    first, second, third = sorted(df.collect(), key=lambda x: (x.ball != "0.10", x.ball))
    assert (first.ball, first.match_ball_number, first.event, first.batsman, first.bowler, first.matchid) == (
        "0.10", 7, "Root to Stokes, 1 run", None, None, 3)
    assert first.commentary == 'He said "well played", twice' and first.rescued == {"weather": "dry"}
    assert (second.match_ball_number, second.event, second.commentary, second.batsman) == (
        None, 'Root to "Ben" Stokes, no run', "C:\\dir\\", "Ben")
    assert second.rescued == {"match_ball_number": "not a number"}
    assert (third.ball, third.match_ball_number, third.event, third.innings, third.rescued) == ("0.3", None, None, None, None)
    # the contract's columns alone by default
    assert "rescued" not in files.events(spark, str(tmp_path / "src"), streaming=False).columns


def test_csv_with_long_and_quoted_texts(spark, tmp_path):
    """A quoted text of 1 MB, quotes escaped either way, and a file given one escape for all lines."""
    long = "He said, " * 120_000
    texts = {1: long, 2: 'doubled "q", ' * 50_000, 3: "plain", 4: ""}
    for n, text in texts.items():
        d = tmp_path / "src" / f"matchid={n}"
        d.mkdir(parents=True)
        with open(d / "match_events_data.csv", "w", newline="") as fh:
            csv.writer(fh).writerows([["ball", "commentary"], ["0.1", text]])
    got = {r.matchid: r.commentary for r in files.events(spark, str(tmp_path / "src"), streaming=False).collect()}
    assert got == texts | {4: None}
    spark_made = [("back\\slash, \"both\" " * 30_000, 5), ("ends in \\", 6)]
    df = spark.createDataFrame(spark_made, "commentary string, matchid long").withColumn("ball", F.lit("0.1"))
    files.write_feed(df, str(tmp_path / "spark"), "csv")
    back = files.events(spark, str(tmp_path / "spark"), streaming=False, file_name="part-*").collect()
    assert {(r.commentary, r.matchid) for r in back} == {(t.strip(), m) for t, m in spark_made}
    d = tmp_path / "mixed" / "matchid=1"
    d.mkdir(parents=True)
    (d / "match_events_data.csv").write_text('ball,commentary\n0.1,"C:\\x ""y"", z"\n')
    mixed = files.events(spark, str(tmp_path / "mixed"), streaming=False, escape='"').first()
    assert mixed.commentary == 'C:\\x "y", z'


def test_csv_wider_than_the_parser_fails(spark, tmp_path):
    d = tmp_path / "matchid=1"
    d.mkdir()
    for n in (files.MAX_COLUMNS, files.MAX_COLUMNS + 1):
        (d / "match_events_data.csv").write_text(",".join(f"x{i}" for i in range(n - 1)) + ",ball\n" + "," * (n - 1) + "0.1\n")
        df = files.events(spark, str(tmp_path), streaming=False)
        if n == files.MAX_COLUMNS:
            assert df.first().ball == "0.1"
        else:
            with pytest.raises(Exception, match="more than 64 columns"):
                df.collect()


def test_header_history(spark, tmp_path):
    """A layout is recorded once, with the run that saw it first."""
    root, lake = tmp_path / "src", Lake(str(tmp_path / "lake"))

    def put(match, head):
        (root / f"matchid={match}").mkdir(parents=True)
        (root / f"matchid={match}" / "match_events_data.csv").write_text(head + "\n")

    put(1, "ball,event")
    put(2, "Ball, EVENT")
    medallion.run_headers(spark, str(root), lake, run_id="r1")
    put(3, "ball,event")
    put(4, "ball,event,Weather")
    medallion.run_headers(spark, str(root), lake, run_id="r2")
    got = {(r.Batchid, r.feed, r.columns) for r in lake.read(spark, "bronze", "header_history").collect()}
    assert got == {("r1", "match_events", "ball,event"), ("r2", "match_events", "ball,event,weather")}


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    from pitchlake.session import _LISTING_KEY, LISTING_TASKS

    src, lake, before = str(tmp_path / "src"), Lake(str(tmp_path / "lake")), spark.conf.get(_LISTING_KEY)
    n = LISTING_TASKS + 40
    for m in range(n):
        _write_events(src, m, 1)
    q = append(files.events(spark, src), lake.table("bronze", "e"), lake.checkpoint("bronze", "e"))
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(str(q.runId)) for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= LISTING_TASKS
    assert lake.read(spark, "bronze", "e").select("matchid").distinct().count() == n
    assert spark.conf.get(_LISTING_KEY) == before


def test_feed_files_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(400).selectExpr("id % 40 as matchid", "id as match_ball_number")
    files.write_feed(rows, str(tmp_path / "feed"), "csv")
    parts = [p.name for p in (tmp_path / "feed").glob("matchid=*/part-*")]
    assert len(parts) == 40                                   # one file a match
    assert len({p.split("-")[1] for p in parts}) > 4          # from most of the session's 8 shuffle partitions
    assert spark.read.option("header", True).csv(str(tmp_path / "feed")).count() == 400


def test_csv_lines_reach_the_parser_whole(spark):
    """A line under eight names has as many columns as the parser expects, so that it raises nothing inside."""
    head = [f"n{i}" for i in range(8)] + [""] * (files.MAX_COLUMNS - 8)
    df = spark.createDataFrame([(head, '1,"a, ""b""",,x,"c",\\,y,')], "head array<string>, line string")
    whole = files._whole(F.col("line"), files._lacks(F.col("head"), F.col("line")))
    schema = ", ".join(f"c{i} string" for i in range(files.MAX_COLUMNS))
    row = df.select(F.from_csv(whole, F.lit(schema), {"mode": "FAILFAST", "escape": '"'}).alias("r")).select("r.*").first()
    assert row[-8:] == ("1", 'a, "b"', None, "x", "c", "\\", "y", None) and not any(row[:-8])


@pytest.mark.parametrize("lines, expected", [
    (["batsman,ball", "A", "B,1.2,extra", "C,1.3"], {"A": None, "B": "1.2", "C": "1.3"}),  # too short, too long
    (["batsman,ball,,", "A,1.1,x,y", '"B, ""C""",1.2,,'], {"A": "1.1", 'B, "C"': "1.2"}),  # columns without a name
    (["ball,batsman", '1.1,"A', "1.2, B "], {"A": "1.1", " B ": "1.2"}),  # a quote left open
    (["ball,batsman", '"1.1",A"B', ',"C\\"D"', '1.3,""'], {'A"B': "1.1", 'C"D': None, None: "1.3"}),
])
def test_csv_lines_of_another_length_than_the_header(spark, tmp_path, lines, expected):
    (tmp_path / "matchid=1").mkdir()
    (tmp_path / "matchid=1" / "match_events_data.csv").write_text("\n".join(lines))
    rows = files.events(spark, str(tmp_path), streaming=False).collect()
    assert {r.batsman: r.ball for r in rows} == expected


def test_written_stages_are_compiled(spark, tmp_path, monkeypatch):
    """Methods of generated code are kept small enough for the JVM's compiler while tables are written."""
    key, seen = session._METHOD_KEY, []
    before = spark.conf.get(key)
    lake = Lake(f"{tmp_path}/lake")
    jvm_write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(key)), jvm_write(self, *a, **k))[1])
    lake.overwrite(spark.range(3), "bronze", "t")
    assert [int(x) for x in seen] == [session.METHOD_BYTES] and spark.conf.get(key) == before
    assert lake.read(spark, "bronze", "t").count() == 3


def test_many_small_files_are_read_by_few_tasks(spark, tmp_path):
    """A feed, a stream's table and a table partitioned by match are read by no more tasks than a shuffle has."""
    key, tasks = "spark.sql.files.maxPartitionBytes", int(spark.conf.get("spark.sql.shuffle.partitions"))
    src, before, lake = str(tmp_path / "src"), spark.conf.get(key), Lake(str(tmp_path / "lake"))
    n = 3 * tasks
    for m in range(n):
        _write_events(src, m, 2)
        with open(os.path.join(src, f"matchid={m}", "match_metadata.json"), "w") as fh:
            fh.write('{"ground": "Lords"}')
    spark.conf.set(key, "4194304")  # a task a file: the opening of a file counts as much
    try:
        assert spark.read.text(src, recursiveFileLookup=True, wholetext=True).rdd.getNumPartitions() > tasks
        for reader, name, rows in ((files.events, "match_events_data.csv", 2 * n), (files.metadata, "match_metadata.json", n)):
            feed = reader(spark, src, streaming=False, file_name=name)
            assert feed.rdd.getNumPartitions() <= tasks and feed.count() == rows
            append(reader(spark, src, file_name=name), lake.table("bronze", name), lake.checkpoint("bronze", name))
            table = lake.read(spark, "bronze", name)
            assert len(table.inputFiles()) <= tasks and table.count() == rows
            assert {r.matchid for r in table.select("matchid").distinct().collect()} == set(range(n))
    finally:
        spark.conf.set(key, before)


def test_feed_files_come_without_checksum_files(spark, tmp_path):
    rows = spark.range(40).selectExpr("id % 10 as matchid", "id as match_ball_number")
    for fmt in ("csv", "json"):
        root = tmp_path / fmt
        files.write_feed(rows, str(root), fmt)
        files.write_feed(rows, str(root), fmt, mode="append")
        assert len(list(root.glob("matchid=*/part-*"))) == 20 and not list(root.glob("matchid=*/.*"))
        assert spark.read.format(fmt).option("header", True).load(str(root)).count() == 80


def test_rerun_feed_is_written_once(spark, tmp_path, monkeypatch):
    """The files of a run are staged where the stream finds them, not staged elsewhere, read back and written again."""
    written, write = [], files.write_feed
    monkeypatch.setattr(files, "write_feed", lambda df, root, *a, **k: (written.append(root), write(df, root, *a, **k))[1])
    events = str(tmp_path / "events.parquet")
    spark.range(1500).selectExpr("id as event_id", "id % 7 as user_id").write.parquet(events)
    rows = catalog.ingest_rerun_settings(spark, str(tmp_path)).groupBy("Batchid").count().collect()
    assert {r[0]: r[1] for r in rows} == {"run-first": 5 * 22, "run-second": 2 * 22}
    assert len(written) == 2 and len(set(written)) == 1


def _contents(root) -> dict:
    return {p.parent.name: sorted(p.read_bytes().split(b"\n")) for p in root.glob("matchid=*/part-*")}


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_feed_files_hold_what_spark_writes_but_are_created_as_plain_files(spark, tmp_path, monkeypatch, fmt):
    rows = spark.createDataFrame(
        [(1, 'a,"b"\\ c\n2', None, 1.5, ""), (None, None, None, None, None), (2, " x ", "\u00e9 ", -0.0, '"'), (1, "", "z", None, "\\"), (3,) + (None,) * 4],
        'matchid int, `a b` string, `c,"d` string, e double, f string')
    writer = rows.repartition(2, "matchid").write.partitionBy("matchid")
    writer.option("header", True).csv(str(tmp_path / "spark")) if fmt == "csv" else writer.json(str(tmp_path / "spark"))
    for write in ("csv", "json"):  # Hadoop creates no file of the feed
        monkeypatch.setattr(DataFrameWriter, write, lambda self, *a, **k: pytest.fail("a file system process a file"))
    files.write_feed(rows, str(tmp_path / "feed"), fmt)
    assert _contents(tmp_path / "feed") == _contents(tmp_path / "spark") and len(_contents(tmp_path / "feed")) == 4
    files.write_feed(rows.where("matchid = 2"), str(tmp_path / "feed"), fmt)  # overwrites
    assert _contents(tmp_path / "feed").keys() == {"matchid=2"}
    files.write_feed(rows.limit(0), str(tmp_path / "feed"), fmt)
    assert (tmp_path / "feed").is_dir() and not _contents(tmp_path / "feed")


def test_tables_partitioned_by_match_come_without_checksum_files(spark, tmp_path):
    rows, lake = spark.range(40).selectExpr("id % 5 as matchid", "id as match_ball_number"), Lake(str(tmp_path / "lake"))
    for _ in range(2):
        lake.overwrite(rows, "gold", "e", partition_by=("matchid",))
        table = tmp_path / "lake" / "gold" / "e"
        assert len(list(table.glob("matchid=*/part-*"))) == 5 and not list(table.glob("matchid=*/.*"))
        assert lake.read(spark, "gold", "e").count() == 40


def test_written_name_lists_are_merged_not_broadcast(spark, tmp_path):
    """Their files are small however many matches they hold: in the driver a match takes some 5 KB."""
    players = spark.createDataFrame([(m, "India", f"Player {p}") for m in range(3) for p in range(4)], "matchid long, team string, player_name string")
    lake = Lake(str(tmp_path / "lake"))
    lake.overwrite(lookups.match_name_lists(players), "silver", "match_name_lists")
    lists = lake.read(spark, "silver", "match_name_lists")
    deliveries = spark.createDataFrame([(1, "IND", "P3", None), (None, "IND", "P3", None)],
                                       "matchid long, innings string, batsman_short string, bowler_short string")
    matches = spark.createDataFrame([(2, "IND", None)], "matchid long, first_innings string, second_innings string")
    for df in (silver.resolve_delivery_names(deliveries, lists=lists), silver.resolve_innings_teams(matches, lists=lists)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    names = {r.matchid: (r.team, r.batsman_resolved) for r in silver.resolve_delivery_names(deliveries, lists=lists).collect()}
    assert names == {1: ("India", "Player 3"), None: ("IND", "P3")}
    assert silver.resolve_innings_teams(matches, lists=lists).first().first_innings == "India"


def test_finished_stream_is_let_go(spark, tmp_path):
    """A finished query holds the listing of its files and its last plan in the driver; its run keeps the progress alone."""
    src, lake = str(tmp_path / "src"), Lake(str(tmp_path / "lake"))
    _write_events(src, 1, 3)
    gc.collect()
    gc.disable()
    try:
        run = append(files.events(spark, src), lake.table("bronze", "e"), lake.checkpoint("bronze", "e"), query_name="e")
        held = [o for o in gc.get_objects() if isinstance(o, (StreamingQuery, DataStreamWriter))]
    finally:
        gc.enable()
    assert held == []
    assert run.name == "e" and run.lastProgress.numInputRows == 1 and len(run.recentProgress) == 1


def test_listings_go_with_their_reader(spark, tmp_path, monkeypatch):
    """No listing is kept in the driver's shared cache, where no other reader would find it."""
    key = "spark.sql.hive.filesourcePartitionFileCacheSize"
    src, lake, before, seen = str(tmp_path / "src"), Lake(str(tmp_path / "lake")), spark.conf.get(key), []
    _write_events(src, 1, 3)
    start = DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self, *a, **k: (seen.append(spark.conf.get(key)), start(self, *a, **k))[1])
    load = DataStreamReader.load
    monkeypatch.setattr(DataStreamReader, "load", lambda self, *a, **k: (seen.append(spark.conf.get(key)), load(self, *a, **k))[1])
    append(files.events(spark, src), lake.table("bronze", "e"), lake.checkpoint("bronze", "e"))
    assert seen == ["0", "0"] and spark.conf.get(key) == before
