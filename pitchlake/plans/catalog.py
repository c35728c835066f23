"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the ``events`` table of ``sf_dir`` through the fixture feeds
(``sources.proxies``), so its work grows with the input. Output columns carry
no load timestamps, so each result is a function of the input alone; arrays
are emitted as '|'-joined strings.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake import schemas, settings
from pitchlake.functions import names as N
from pitchlake.functions import parse
from pitchlake.operators import batting, bowling, innings, lookups, quality, silver, spans, summary
from pitchlake.session import fresh_dir, in_few_tasks
from pitchlake.sources import dirty, files, proxies, tables
from pitchlake.sources.layout import Lake
from pitchlake.streaming import incremental, medallion, quality_log, repair, state
from pitchlake.streaming.runner import append

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# --------------------------------------------------------------------------- inputs

def _feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return proxies.feeds(spark, sf_dir)


def _players(f: dict[str, DataFrame]) -> DataFrame:
    return silver.silver_players(silver.as_bronze(f["players"]))


def _metadata(f: dict[str, DataFrame]) -> DataFrame:
    return silver.silver_metadata(silver.as_bronze(f["metadata"]), _players(f), f["zones"])


def _events(f: dict[str, DataFrame]) -> DataFrame:
    return silver.silver_events(silver.as_bronze(f["deliveries"]), _players(f))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.parse_deliveries(_feeds(spark, sf_dir)["deliveries"])


# --------------------------------------------------------------------------- parsing

@query
def parse_delivery(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "matchid", "match_ball_number", "ball", "event", "bowler_short", "batsman_short",
        "runs_text", "over", "over_ball_number", "runs")


@query
def classify_extras(spark, sf_dir):
    return _parsed(spark, sf_dir).select("matchid", "match_ball_number", "runs_text", "Extras")


@query
def classify_dismissal(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "matchid", "match_ball_number", "commentary", "dismissal_method", "dismissed_by")


@query
def super_over_label(spark, sf_dir):
    d = _feeds(spark, sf_dir)["deliveries"]
    return d.select("matchid", "match_ball_number", "innings", "is_super_over",
                    parse.super_over_label(F.col("innings")).alias("super_over_team"))


@query
def parse_toss(spark, sf_dir):
    m = _feeds(spark, sf_dir)["metadata"]
    return m.select("matchid", "toss", parse.toss_winner(F.col("toss")).alias("toss_winner"),
                    parse.toss_decision(F.col("toss")).alias("toss_decision"))


@query
def match_dates_utc(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return silver.enrich_metadata(f["metadata"], f["zones"]).select(
        "matchid", "ground", "local_timezone", "match_date", "match_start_utc", "first_innings_start_utc",
        "first_innings_end_utc", "second_innings_start_utc", "second_innings_end_utc")


@query
def ground_timezone_lookup(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return lookups.with_local_timezone(f["metadata"].select("matchid", "ground"), f["zones"])


@query
def distinct_grounds(spark, sf_dir):
    return lookups.distinct_grounds(_feeds(spark, sf_dir)["metadata"])


# --------------------------------------------------------------------------- names

@query
def match_name_lists(spark, sf_dir):
    lists = lookups.match_name_lists(_feeds(spark, sf_dir)["players"])
    return lists.select(
        "matchid",
        F.array_join(N.index_names(F.col("team_index")), "|").alias("team_names"),
        F.array_join(N.index_names(F.col("player_index")), "|").alias("player_names"),
    )


@query
def resolve_delivery_names(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    resolved = silver.resolve_delivery_names(silver.parse_deliveries(f["deliveries"]), f["players"])
    return resolved.select(
        "matchid", "match_ball_number", "innings", "team", "batsman_short",
        F.col("batsman_resolved").alias("batsman"), "bowler_short", F.col("bowler_resolved").alias("bowler"))


@query
def resolve_innings_teams(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    m = f["metadata"].select("matchid", F.col("first_innings").alias("first_innings_code"),
                             F.col("second_innings").alias("second_innings_code"),
                             "first_innings", "second_innings")
    return silver.resolve_innings_teams(m, f["players"])


# --------------------------------------------------------------------------- gold

@query
def innings_progress(spark, sf_dir):
    events = _events(_feeds(spark, sf_dir))
    return innings.innings_progress(events).select(
        "matchid", "match_ball_number", "team", "super_over_team", "over", "over_ball_number", "runs",
        "dismissal_method", "innings_score", "wickets_lost")


@query
def innings_progress_chunked(spark, sf_dir):
    """As innings_progress, with window partitions bounded by a row count."""
    return innings.innings_progress(_events(_feeds(spark, sf_dir)), chunk_rows=5000).select(
        "matchid", "match_ball_number", "team", "super_over_team", "over", "over_ball_number", "runs",
        "dismissal_method", "innings_score", "wickets_lost")


@query
def batting_per_match(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    meta, events = _metadata(f), _events(f)
    return batting.batting_per_match(events, meta)


@query
def batting_per_series(spark, sf_dir):
    return batting.batting_per_series(batting_per_match(spark, sf_dir))


@query
def batting_overall(spark, sf_dir):
    return batting.batting_overall(batting_per_series(spark, sf_dir))


@query
def maiden_overs(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    meta, events = _metadata(f), _events(f)
    return bowling.maiden_overs(events, meta)


@query
def bowling_per_match(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    meta, events = _metadata(f), _events(f)
    return bowling.bowling_per_match(events, meta)


@query
def bowling_per_series(spark, sf_dir):
    return bowling.bowling_per_series(bowling_per_match(spark, sf_dir))


@query
def bowling_overall(spark, sf_dir):
    return bowling.bowling_overall(bowling_per_series(spark, sf_dir))


@query
def match_summary(spark, sf_dir):
    return summary.match_summary(_metadata(_feeds(spark, sf_dir)))


@query
def appearances_union(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return spans.appearances(_events(f), _players(f))


@query
def player_team_spans(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return spans.player_team_spans(spans.appearances(_events(f), _players(f)), _metadata(f))


@query
def player_team_scd2(spark, sf_dir):
    return spans.player_team_scd2(player_team_spans(spark, sf_dir))


# --------------------------------------------------------------------------- quality

@query
def dq_bronze_events(spark, sf_dir):
    return quality.quality_report(dirty.bronze_events(_feeds(spark, sf_dir)["deliveries"]), "bronze_events")


@query
def dq_bronze_metadata(spark, sf_dir):
    return quality.quality_report(dirty.bronze_metadata(_feeds(spark, sf_dir)["metadata"]), "bronze_metadata")


@query
def dq_bronze_players(spark, sf_dir):
    return quality.quality_report(dirty.bronze_players(_feeds(spark, sf_dir)["players"]), "bronze_players")


@query
def dq_silver_players(spark, sf_dir):
    bronze = silver.as_bronze(dirty.bronze_players(_feeds(spark, sf_dir)["players"]))
    return quality.quality_report(silver.silver_players(bronze), "silver_players")


@query
def dq_silver_metadata(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    bronze = silver.as_bronze(dirty.silver_metadata_feed(f["metadata"]))
    return quality.quality_report(silver.silver_metadata(bronze, _players(f), f["zones"]), "silver_metadata")


@query
def dq_silver_events(spark, sf_dir):
    events = _events(_feeds(spark, sf_dir))
    return quality.quality_report(dirty.silver_events(events), "silver_events")


@query
def dq_gold_events(spark, sf_dir):
    events = _events(_feeds(spark, sf_dir))
    return quality.quality_report(dirty.gold_events(innings.innings_progress(events)), "gold_events")


# --------------------------------------------------------------------------- files and streams

_FEED_FORMATS = {"deliveries": "csv", "metadata": "json", "players": "csv"}
_BRONZE_OF_FEED = {"deliveries": "match_events", "metadata": "match_metadata", "players": "match_players"}
_STAGED = "part-*"


_STAGED_ROOTS: dict[tuple, str] = {}


def _stage_feeds(spark: SparkSession, sf_dir: str, which=("deliveries", "metadata", "players")) -> dict[str, str]:
    """Fixture feeds as files in the ``matchid=<n>/`` layout; returns feed -> root.

    Staged once per session and input directory (the files are read-only
    afterwards); every query run still ingests them into a fresh table with a
    fresh checkpoint, so it reads every file.
    """
    f = _feeds(spark, sf_dir)
    roots = {}
    for feed in which:
        key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), feed)
        if key not in _STAGED_ROOTS:
            root = fresh_dir(spark, f"feed-{feed}")
            files.write_feed(f[feed], root, _FEED_FORMATS[feed])
            _STAGED_ROOTS[key] = root
        roots[feed] = _STAGED_ROOTS[key]
    return roots


def _ingest(spark: SparkSession, sf_dir: str, feed: str, reader, columns) -> DataFrame:
    roots = _stage_feeds(spark, sf_dir, (feed,))
    lake = Lake(fresh_dir(spark, "lake"))
    table = _BRONZE_OF_FEED[feed]
    stream = reader(spark, roots[feed], streaming=True, file_name=_STAGED, run_id="fixture")
    append(stream, lake.table("bronze", table), lake.checkpoint("bronze", table))
    out = lake.read(spark, "bronze", table)
    return out.select("Batchid", *columns, files.source_dir().alias("source_dir"))


@query
def ingest_events_csv(spark, sf_dir):
    return _ingest(spark, sf_dir, "deliveries", files.events, schemas.BRONZE_EVENTS_COLUMNS)


@query
def ingest_metadata_json(spark, sf_dir):
    return _ingest(spark, sf_dir, "metadata", files.metadata, schemas.BRONZE_METADATA_COLUMNS)


@query
def ingest_players_csv(spark, sf_dir):
    return _ingest(spark, sf_dir, "players", files.players, schemas.BRONZE_PLAYERS_COLUMNS)


def _staged_once(spark: SparkSession, sf_dir: str, what: str, write) -> str:
    """Root of files that ``write(root)`` stages, once per session and input directory."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), what)
    if key not in _STAGED_ROOTS:
        root = fresh_dir(spark, f"feed-{what}")
        write(root)
        _STAGED_ROOTS[key] = root
    return _STAGED_ROOTS[key]


@query
def ingest_events_by_header(spark, sf_dir):
    """CSV files whose headers differ: reordered, with an unknown column, and (odd matches) without is_super_over."""
    def write(root: str) -> None:
        d = _feeds(spark, sf_dir)["deliveries"].withColumn("Weather", F.lit("dry, \"cold\""))
        mixed = ["innings", "commentary", "Weather", "bowler", "ball", "is_super_over", "event", "matchid", "batsman", "match_ball_number"]
        fewer = ["event", "match_ball_number", "Weather", "matchid", "batsman", "ball", "commentary", "innings", "bowler"]
        files.write_feed(d.where("matchid % 2 = 0").select(mixed), f"{root}/a", "csv")
        files.write_feed(d.where("matchid % 2 = 1").select(fewer), f"{root}/b", "csv")

    root = _staged_once(spark, sf_dir, "by-header", write)
    lake = Lake(fresh_dir(spark, "lake"))
    out = None
    for part in ("a", "b"):
        stream = files.events(spark, f"{root}/{part}", streaming=True, file_name=_STAGED, run_id="stream")
        append(stream, lake.table("bronze", f"events_{part}"), lake.checkpoint("bronze", f"events_{part}"))
        batch = files.events(spark, f"{root}/{part}", streaming=False, file_name=_STAGED, run_id="batch")
        for df in (lake.read(spark, "bronze", f"events_{part}"), batch):
            df = df.select("Batchid", *schemas.BRONZE_EVENTS_COLUMNS)
            out = df if out is None else out.unionByName(df)
    return out


@query
def ingest_rerun_settings(spark, sf_dir):
    """Two runs with run settings; files that arrive between them are read once, by the second run."""
    p = _feeds(spark, sf_dir)["players"]
    lake_root = fresh_dir(spark, "lake")
    source = fresh_dir(spark, "feed-growing")
    for run, part in (("first", "matchid % 3 <> 0"), ("second", "matchid % 3 = 0")):
        # the second run finds the first one's files again, and new ones
        files.write_feed(p.where(part), source, "csv", mode="append")
        s = settings.from_conf(spark, source_path=source, lake_root=lake_root, run_id=f"run-{run}")
        medallion.run_bronze(spark, s.source_path, Lake(s.lake_root), run_id=s.run_id, tables=("match_players",),
                             file_names={"match_players": _STAGED})
    return Lake(lake_root).read(spark, "bronze", "match_players").select("Batchid", *schemas.BRONZE_PLAYERS_COLUMNS)


def _dedup_twice(spark: SparkSession, sf_dir: str, feed: str, reader, keys) -> Lake:
    """The feed delivered twice (exact copies), the second time between two runs on one checkpoint.

    The copies of the second run are refused by the state that it restores.
    """
    lake = Lake(fresh_dir(spark, "lake"))
    source = fresh_dir(spark, f"feed-twice-{feed}")
    for _ in range(2):
        files.write_feed(_feeds(spark, sf_dir)[feed], source, _FEED_FORMATS[feed], mode="append")
        stream = reader(spark, source, streaming=True, file_name=_STAGED, run_id="fixture")
        append(silver.deduplicate(stream, keys), lake.table("silver", feed), lake.checkpoint("silver", feed))
    return lake


@query
def dedup_players_stream(spark, sf_dir):
    lake = _dedup_twice(spark, sf_dir, "players", files.players, silver.PLAYER_KEYS)
    return lake.read(spark, "silver", "players").select(*schemas.BRONZE_PLAYERS_COLUMNS)


@query
def dedup_metadata_stream(spark, sf_dir):
    lake = _dedup_twice(spark, sf_dir, "metadata", files.metadata, silver.METADATA_KEYS)
    return lake.read(spark, "silver", "metadata").select(*schemas.BRONZE_METADATA_COLUMNS)


@query
def dedup_state_keys(spark, sf_dir):
    """Keys that the de-duplication of line-ups holds after two runs, as read from its checkpoint, a team of a match a row."""
    lake = _dedup_twice(spark, sf_dir, "players", files.players, silver.PLAYER_KEYS)
    held = state.held_keys(spark, lake.checkpoint("silver", "players"))
    return held.groupBy("matchid", "team").agg(F.count("*").alias("held_keys"))


@query
def ingest_rescued_values(spark, sf_dir):
    """Values that found no place, counted per column: numbers and flags that do not parse, and an unknown column."""
    def write(root: str) -> None:
        d = _feeds(spark, sf_dir)["deliveries"]
        n = F.col("match_ball_number")
        files.write_feed(d.withColumns({
            "Weather": F.when(n % 5 == 0, F.concat(F.lit('dry, "'), n.cast("string"), F.lit('"'))),
            "is_super_over": F.when(n % 11 == 0, F.lit("maybe")).otherwise(F.col("is_super_over").cast("string")),
            "match_ball_number": F.when(n % 7 == 0, F.concat(F.lit("no. "), n.cast("string"))).otherwise(n.cast("string")),
        }), root, "csv")

    lake = Lake(fresh_dir(spark, "lake"))
    stream = files.events(spark, _staged_once(spark, sf_dir, "misfits", write), file_name=_STAGED, rescued=True)
    append(stream, lake.table("bronze", "match_events"), lake.checkpoint("bronze", "match_events"))
    found = lake.read(spark, "bronze", "match_events").select("matchid", F.explode("rescued").alias("column_name", "value"))
    return found.groupBy("matchid", "column_name").agg(F.count("*").alias("n_values"), F.min("value").alias("first_value"))


@query
def ingest_header_history(spark, sf_dir):
    """Layouts of the two CSV feeds, and the run that brought each: the second run finds a wider one for some matches."""
    f = _feeds(spark, sf_dir)
    lake = Lake(fresh_dir(spark, "lake"))
    roots = {"match_events": fresh_dir(spark, "feed-layouts"), "match_players": fresh_dir(spark, "feed-layouts")}
    for run, part in (("first", "matchid % 2 = 0"), ("second", "matchid % 2 = 1")):
        d = f["deliveries"].where(part)
        files.write_feed(d if run == "first" else d.withColumn("Weather", F.lit("dry")), roots["match_events"], "csv", mode="append")
        files.write_feed(f["players"].where(part), roots["match_players"], "csv", mode="append")
        medallion.run_headers(spark, roots, lake, run_id=run, file_names=dict.fromkeys(roots, _STAGED))
    return lake.read(spark, "bronze", "header_history").select("Batchid", "feed", "columns")


def _database(spark: SparkSession) -> str:
    """A catalog database of its own."""
    root = fresh_dir(spark, "database")
    name = "pitchlake_" + root.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}'")
    return name


@query
def ingest_events_table(spark, sf_dir):
    """Deliveries appended by two runs to a catalog table partitioned by match, with its description as the catalog has it."""
    d = _feeds(spark, sf_dir)["deliveries"]
    lake, source, name = Lake(fresh_dir(spark, "lake")), fresh_dir(spark, "feed-growing"), None
    for run, part in (("first", "matchid % 3 <> 0"), ("second", "matchid % 3 = 0")):
        files.write_feed(d.where(part), source, "csv", mode="append")
        stream = files.events(spark, source, file_name=_STAGED, run_id=run)
        name = name or tables.create_layer_table(spark, "bronze", "match_events", stream.schema, lake.table("bronze", "match_events"),
                                                 database=_database(spark), partition_by=("matchid",))
        append(stream, None, lake.checkpoint("bronze", "match_events"), partition_by=("matchid",), table=name)
    about = tables.describe(spark, name)
    return in_few_tasks(spark.table(name)).groupBy("Batchid", "matchid").agg(
        F.count("*").alias("n_rows"), F.sum("match_ball_number").alias("ball_numbers")).select(
        "*", F.lit(about["properties"].get("quality")).alias("quality"), F.lit(",".join(about["partition_by"])).alias("partition_by"),
        (F.length(F.lit(about["comment"])) > 0).alias("has_comment"))


@query
def gold_published_rebuild(spark, sf_dir):
    """Batting of the matches so far, recomputed and published while a reader holds the table: it keeps the old rows, the next sees the new."""
    stats = batting_per_match(spark, sf_dir)
    name, root = f"{_database(spark)}.gold_batting_stats_per_match", fresh_dir(spark, "published")
    tables.publish(stats.where("matchid % 2 = 0"), name, root, properties=tables.properties_of("gold"))
    holding = spark.table(name)
    tables.publish(stats, name, root)
    held, now = (df.select(F.lit(label).alias("reader"), "matchid", "batsman", "total_runs") for label, df in
                 (("holding", holding), ("next", spark.table(name))))
    return held.unionByName(now)


def _bucketed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Silver deliveries and metadata as snapshots bucketed by match."""
    f, root, name = _feeds(spark, sf_dir), fresh_dir(spark, "bucketed"), _database(spark)
    return tuple(tables.write_bucketed(df, f"{name}.{t}", f"{root}/{t}", 16) for t, df in
                 (("match_events", _events(f)), ("match_metadata", _metadata(f))))


@query
def bucketed_batting_per_match(spark, sf_dir):
    """Batting per match from bucketed snapshots: the deliveries are not exchanged again."""
    return batting.batting_per_match(*_bucketed(spark, sf_dir))


@query
def bucketed_bowling_per_match(spark, sf_dir):
    """Bowling per match from bucketed snapshots."""
    return bowling.bowling_per_match(*_bucketed(spark, sf_dir))


@query
def bucketed_innings_progress(spark, sf_dir):
    """Running scores from a bucketed snapshot."""
    return innings.innings_progress(_bucketed(spark, sf_dir)[0]).select(
        "matchid", "match_ball_number", "team", "super_over_team", "over", "over_ball_number", "runs",
        "dismissal_method", "innings_score", "wickets_lost")


@query
def ingest_redelivered(spark, sf_dir):
    """Deliveries of which every file comes again under another name, in a second run: its content is known."""
    d = _feeds(spark, sf_dir)["deliveries"]
    lake, source = Lake(fresh_dir(spark, "lake")), fresh_dir(spark, "feed-again")
    for run in ("first", "second"):
        files.write_feed(d, source, "csv", mode="append", sort_by=("match_ball_number",))
        stream = files.events(spark, source, file_name=_STAGED, run_id=run, skip_copies=True)
        append(stream, lake.table("bronze", "match_events"), lake.checkpoint("bronze", "match_events"))
    return lake.read(spark, "bronze", "match_events").select("Batchid", *schemas.BRONZE_EVENTS_COLUMNS)


def _late_lineups(spark: SparkSession, sf_dir: str) -> Lake:
    """Silver tables of which a third of the matches got their line-ups a run too late, repaired."""
    f, lake = _feeds(spark, sf_dir), Lake(fresh_dir(spark, "lake"))
    roots = _stage_feeds(spark, sf_dir, ("deliveries", "metadata"))
    roots = {_BRONZE_OF_FEED[k]: v for k, v in roots.items()} | {"match_players": fresh_dir(spark, "feed-late")}
    for part in ("matchid % 3 <> 1", "matchid % 3 = 1"):
        files.write_feed(f["players"].where(part), roots["match_players"], "csv", mode="append")
        medallion.run_bronze(spark, roots, lake, run_id="fixture", file_names=dict.fromkeys(medallion.BRONZE_TABLES, _STAGED))
        medallion.run_silver(spark, lake, proxies.zones(spark))
        repair.repair(spark, lake, proxies.zones(spark), buckets=16)
    return lake


@query
def silver_events_repaired(spark, sf_dir):
    """Silver deliveries after the repair of names that came late."""
    lake = _late_lineups(spark, sf_dir)
    return repair.current(spark, lake, "silver", "match_events").select(*_without_audit(schemas.SILVER_EVENTS_COLUMNS))


@query
def gold_batting_repaired(spark, sf_dir):
    """Career batting from repaired silver tables."""
    lake = _late_lineups(spark, sf_dir)
    medallion.build_gold(spark, lake, tables=("batting_stats_overall",), repaired=True)
    return lake.read(spark, "gold", "batting_stats_overall").drop("gold_load_timestamp")


@query
def dq_history_two_runs(spark, sf_dir):
    """Violations of the line-up rules as kept for two runs."""
    p = _feeds(spark, sf_dir)["players"].withColumns({
        "player_name": F.when((F.col("matchid") % 3 == 0) & (F.col("batting_position") == 3), F.lit(None)).otherwise(F.col("player_name")),
        "team": F.when((F.col("matchid") % 4 == 1) & (F.col("batting_position") == 5), F.lit(None)).otherwise(F.col("team")),
    })
    lake, source = Lake(fresh_dir(spark, "lake")), fresh_dir(spark, "feed-growing")
    for run, part in (("first", "matchid % 5 <> 0"), ("second", "matchid % 5 = 0")):
        files.write_feed(p.where(part), source, "csv", mode="append")
        runs = medallion.run_bronze(spark, source, lake, run_id=run, tables=("match_players",), file_names={"match_players": _STAGED})
        rows = quality_log.stream_rows(runs["match_players"], "bronze_players", run)
        quality_log.record(spark, lake, rows)
        quality_log.record(spark, lake, rows)  # as after a failure: counted once
    return quality_log.history(spark, lake).select("run_id", "dataset", "rule", "total_rows", "failed_rows")


def _medallion(spark: SparkSession, sf_dir: str, which) -> Lake:
    """files -> bronze -> silver streams for the given tables (line-ups always first)."""
    feeds = {v: k for k, v in _BRONZE_OF_FEED.items()}
    roots = _stage_feeds(spark, sf_dir, [feeds[t] for t in which])
    lake = Lake(fresh_dir(spark, "lake"))
    medallion.run_bronze(spark, {_BRONZE_OF_FEED[k]: v for k, v in roots.items()}, lake, run_id="fixture",
                         file_names=dict.fromkeys(medallion.BRONZE_TABLES, _STAGED), tables=which)
    medallion.run_silver(spark, lake, proxies.zones(spark), tables=which)
    return lake


def _without_audit(columns) -> list[str]:
    return [c for c in columns if c not in ("source_file", "load_timestamp")]


@query
def silver_players_stream(spark, sf_dir):
    lake = _medallion(spark, sf_dir, ("match_players",))
    return lake.read(spark, "silver", "match_players").select(*_without_audit(schemas.SILVER_PLAYERS_COLUMNS))


@query
def silver_metadata_stream(spark, sf_dir):
    lake = _medallion(spark, sf_dir, ("match_players", "match_metadata"))
    return lake.read(spark, "silver", "match_metadata").select(*_without_audit(schemas.SILVER_METADATA_COLUMNS))


@query
def silver_events_stream(spark, sf_dir):
    lake = _medallion(spark, sf_dir, ("match_players", "match_events"))
    return lake.read(spark, "silver", "match_events").select(*_without_audit(schemas.SILVER_EVENTS_COLUMNS))


@query
def gold_write_roundtrip(spark, sf_dir):
    lake = Lake(fresh_dir(spark, "lake"))
    lake.overwrite(batting_per_match(spark, sf_dir), "gold", "batting_stats_per_match")
    return lake.read(spark, "gold", "batting_stats_per_match")


# --------------------------------------------------------------------------- gold tables as written

def _gold_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A gold table as read back, built with what it is computed from out of freshly written silver tables."""
    f, lake = _feeds(spark, sf_dir), Lake(fresh_dir(spark, "lake"))
    lake.overwrite(_players(f), "silver", "match_players")
    lake.overwrite(_metadata(f), "silver", "match_metadata")
    if name != "match_summary":
        lake.overwrite(_events(f), "silver", "match_events")
    medallion.build_gold(spark, lake, chunk_rows=50_000, events_partition_by=("matchid",), tables=(name,))
    table = lake.read(spark, "gold", name).drop("gold_load_timestamp")
    return in_few_tasks(table) if name == "match_events" else table


@query
def gold_audit_times(spark, sf_dir):
    """Deliveries of a match, and those whose load, silver and gold times exist and follow one another."""
    lake = _medallion(spark, sf_dir, ("match_players", "match_metadata", "match_events"))
    medallion.build_gold(spark, lake, tables=("match_events",))
    ordered = F.expr("load_timestamp <= silver_load_timestamp and silver_load_timestamp <= gold_load_timestamp")
    return lake.read(spark, "gold", "match_events").groupBy("matchid").agg(
        F.count("*").alias("n_rows"), F.count_if(ordered).alias("n_ordered"))


@query
def gold_match_events(spark, sf_dir):
    """The match events table, partitioned by matchid, as read back."""
    return _gold_table(spark, sf_dir, "match_events").select(
        "matchid", "match_ball_number", "team", "super_over_team", "over", "over_ball_number", "runs",
        "dismissal_method", "innings_score", "wickets_lost")


@query
def gold_batting_stats_per_match(spark, sf_dir):
    return _gold_table(spark, sf_dir, "batting_stats_per_match")


@query
def gold_batting_stats_per_series(spark, sf_dir):
    return _gold_table(spark, sf_dir, "batting_stats_per_series")


@query
def gold_batting_stats_overall(spark, sf_dir):
    return _gold_table(spark, sf_dir, "batting_stats_overall")


@query
def gold_bowling_stats_per_match(spark, sf_dir):
    return _gold_table(spark, sf_dir, "bowling_stats_per_match")


@query
def gold_bowling_stats_per_series(spark, sf_dir):
    return _gold_table(spark, sf_dir, "bowling_stats_per_series")


@query
def gold_bowling_stats_overall(spark, sf_dir):
    return _gold_table(spark, sf_dir, "bowling_stats_overall")


@query
def gold_match_summary(spark, sf_dir):
    return _gold_table(spark, sf_dir, "match_summary")


@query
def gold_player_team_scd2(spark, sf_dir):
    return _gold_table(spark, sf_dir, "player_team_scd2")


@query
def gold_refresh_two_runs(spark, sf_dir):
    """Career batting after two incremental refreshes, the second for line-ups, metadata and deliveries that came later."""
    def write(root: str) -> None:
        f = _feeds(spark, sf_dir)
        for run, part in (("first", "matchid % 4 <> 1"), ("second", "matchid % 4 = 1")):
            for feed, fmt in _FEED_FORMATS.items():
                files.write_feed(f[feed].where(part), f"{root}/{run}/{feed}", fmt)

    staged = _staged_once(spark, sf_dir, "refresh", write)
    lake = Lake(fresh_dir(spark, "lake"))
    for run in ("first", "second"):
        # each run's files form a source of their own, so the lake sees them arrive one after the other
        roots = {_BRONZE_OF_FEED[feed]: f"{staged}/{run}/{feed}" for feed in _FEED_FORMATS}
        medallion.run_bronze(spark, roots, Lake(f"{lake.root}/in-{run}"), run_id="fixture",
                             file_names=dict.fromkeys(medallion.BRONZE_TABLES, _STAGED))
        for table in medallion.BRONZE_TABLES:
            Lake(f"{lake.root}/in-{run}").read(spark, "bronze", table).write.mode("append").parquet(lake.table("bronze", table))
        medallion.run_silver(spark, lake, proxies.zones(spark), buckets=16)
        incremental.refresh_gold(spark, lake, buckets=16)
    return lake.read(spark, "gold", "batting_stats_overall").drop("gold_load_timestamp")
