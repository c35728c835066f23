"""Ordered incremental runs: files -> bronze -> silver (streams), silver -> gold (batch).

Line-ups run before metadata and events in each trigger, so names arriving in
this run are already in the static line-up snapshot the other two join with.
Gold tables are recomputed with overwrite, and each level is read back from
its written table, which cuts the lineage between levels.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake import constants as K
from pitchlake.operators import batting, bowling, innings, lookups, quality, silver, spans, summary
from pitchlake.session import in_few_tasks, listing
from pitchlake.sources import files
from pitchlake.sources.layout import GOLD_CLUSTER, Lake
from pitchlake.streaming import incremental, quality_log, repair
from pitchlake.streaming.runner import Run, append, observed_totals

BRONZE_TABLES = ("match_events", "match_metadata", "match_players")
_RULE_SET = {"match_events": "events", "match_metadata": "metadata", "match_players": "players"}


def quality_summary(queries: dict, layer: str) -> dict[str, dict[str, int]]:
    """Rule violation counts observed during the last run of each stream of a layer."""
    out = {}
    for table, q in queries.items():
        dataset = f"{layer}_{_RULE_SET[table]}"
        out[dataset] = observed_totals(q, f"dq_{dataset}")
    return out


def gold_quality(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Rule violation counts of the whole gold match events table, as it stands after the run."""
    rows = quality.quality_report(lake.read(spark, K.GOLD, "match_events"), "gold_events").collect()
    return {"total_rows": rows[0]["total_rows"], **{r["rule"]: r["failed_rows"] for r in rows}}


def _stream_table(spark: SparkSession, lake: Lake, layer: str, name: str) -> DataFrame:
    schema = lake.schema(spark, layer, name)
    with listing(spark):
        return spark.readStream.schema(schema).parquet(lake.table(layer, name))


def run_bronze(spark: SparkSession, source_root: str | dict[str, str], lake: Lake, *,
               run_id: str = K.DEFAULT_RUN_ID, file_names: dict[str, str] | None = None, partition_by=None,
               tables=BRONZE_TABLES, max_files: int | None = None, archive_root: str | None = None) -> dict:
    """Ingest new files of the three feeds (each file exactly once across runs).

    ``max_files`` splits a large backlog into micro-batches; ``archive_root``
    moves ingested files to ``<archive_root>/<table>`` after each batch.
    """
    names = {"match_events": K.EVENTS_FILE, "match_metadata": K.METADATA_FILE, "match_players": K.PLAYERS_FILE}
    names.update(file_names or {})
    roots = source_root if isinstance(source_root, dict) else dict.fromkeys(BRONZE_TABLES, source_root)
    readers = {"match_events": files.events, "match_metadata": files.metadata, "match_players": files.players}
    out = {}
    for table in ("match_players", "match_metadata", "match_events"):
        if table not in tables:
            continue
        archive = f"{archive_root.rstrip('/')}/{table}" if archive_root else None
        df = readers[table](spark, roots[table], streaming=True, file_name=names[table], run_id=run_id,
                            max_files=max_files, archive_dir=archive)
        df = quality.observe_rules(df, f"{K.BRONZE}_{_RULE_SET[table]}")
        out[table] = append(df, lake.table(K.BRONZE, table), lake.checkpoint(K.BRONZE, table),
                            partition_by=partition_by, query_name=f"bronze_{table}")
    return out


def run_headers(spark: SparkSession, source_root: str | dict[str, str], lake: Lake, *, run_id: str = K.DEFAULT_RUN_ID,
                file_names: dict[str, str] | None = None, max_files: int | None = None) -> Run:
    """Append the CSV layouts not seen before to the table ``header_history``, with the run and file that brought them.

    The state of its stream holds one row per layout, the files are read once more for their header lines.
    """
    names = {"match_events": K.EVENTS_FILE, "match_players": K.PLAYERS_FILE} | (file_names or {})
    roots = source_root if isinstance(source_root, dict) else dict.fromkeys(names, source_root)
    found = [files.headers(spark, roots[t], t, file_name=names[t], run_id=run_id, max_files=max_files)
             for t in ("match_players", "match_events") if t in roots]
    layouts = reduce(DataFrame.unionByName, found).dropDuplicates(["feed", "columns"])
    return append(layouts, lake.table(K.BRONZE, "header_history"), lake.checkpoint(K.BRONZE, "header_history"), query_name="header_history")


def run_silver(spark: SparkSession, lake: Lake, zones: DataFrame, *, watermark: str | None = None,
               partition_by=None, tables=BRONZE_TABLES, buckets: int | None = None) -> dict:
    """Line-ups first (always), then metadata and deliveries if requested.

    With ``buckets``, silver tables are partitioned by the match bucket used
    by the incremental gold refresh, so its per-bucket reads prune files.
    ``watermark`` bounds the de-duplication state of line-ups only: metadata
    must stay one row per match for the joins of the gold tables.
    """
    out = {}
    if buckets:
        partition_by = (incremental.BUCKET,)
    bucketed = (lambda df: incremental.with_bucket(df, buckets)) if buckets else (lambda df: df)
    zones = lookups.zone_dimension(zones)  # one row per ground, valid zone ids
    players_stream = _stream_table(spark, lake, K.BRONZE, "match_players")
    out["match_players"] = append(
        bucketed(quality.observe_rules(silver.silver_players(players_stream, watermark), "silver_players")),
        lake.table(K.SILVER, "match_players"),
        lake.checkpoint(K.SILVER, "match_players"), partition_by=partition_by, query_name="silver_match_players")
    # Per-match name lists: aggregated once per run into a table, so each
    # micro-batch of the two streams below joins a plain scan instead of
    # re-aggregating every line-up.
    snapshot = lake.read(spark, K.SILVER, "match_players")
    lake.overwrite(lookups.match_name_lists(snapshot), K.SILVER, "match_name_lists")
    lists = lake.read(spark, K.SILVER, "match_name_lists")
    if "match_metadata" in tables:
        meta_stream = _stream_table(spark, lake, K.BRONZE, "match_metadata")
        out["match_metadata"] = append(
            bucketed(quality.observe_rules(silver.silver_metadata(meta_stream, None, zones, lists=lists),
                                           "silver_metadata")),
            lake.table(K.SILVER, "match_metadata"),
            lake.checkpoint(K.SILVER, "match_metadata"), partition_by=partition_by,
            query_name="silver_match_metadata")
    if "match_events" in tables:
        events_stream = _stream_table(spark, lake, K.BRONZE, "match_events")
        out["match_events"] = append(
            bucketed(quality.observe_rules(
                silver.silver_events(events_stream, None, lists=lists, null_keys_bypass=True), "silver_events")),
            lake.table(K.SILVER, "match_events"),
            lake.checkpoint(K.SILVER, "match_events"), partition_by=partition_by, query_name="silver_match_events")
    return out


#: The gold table that each gold table is computed from, where there is one.
_GOLD_FROM = {
    "batting_stats_per_match": "match_events", "batting_stats_per_series": "batting_stats_per_match",
    "batting_stats_overall": "batting_stats_per_series", "bowling_stats_per_match": "match_events",
    "bowling_stats_per_series": "bowling_stats_per_match", "bowling_stats_overall": "bowling_stats_per_series",
    "player_team_scd2": "match_events",
}


def _wanted(tables: Sequence[str] | None) -> set[str]:
    """The given gold tables and those they are computed from; all by default."""
    found = set(GOLD_CLUSTER if tables is None else tables)
    while more := {_GOLD_FROM[t] for t in found if t in _GOLD_FROM} - found:
        found |= more
    return found


def build_gold(spark: SparkSession, lake: Lake, *, chunk_rows: int | None = None,
               events_partition_by: Sequence[str] | None = None, tables: Sequence[str] | None = None,
               repaired: bool = False) -> dict[str, str]:
    """Recompute the gold tables, or the given ones and what they are computed from, from the silver snapshots.

    ``chunk_rows`` bounds the window partitions of the running sums
    (``innings.innings_progress``); set it where an innings key can be hot.
    ``events_partition_by`` partitions the match events table, e.g. by ``matchid``.
    ``repaired`` takes the silver rows that ``streaming.repair`` derived again in place of theirs.
    """
    read = (lambda layer, name: repair.current(spark, lake, layer, name)) if repaired else (lambda layer, name: lake.read(spark, layer, name))
    wanted = _wanted(tables)
    meta, paths = read(K.SILVER, "match_metadata"), {}
    if "match_events" in wanted:
        paths["match_events"] = lake.overwrite(
            innings.gold_events(read(K.SILVER, "match_events"), chunk_rows), K.GOLD, "match_events",
            partition_by=events_partition_by, cluster_by=GOLD_CLUSTER["match_events"])
    events = read(K.GOLD, "match_events") if "match_events" in wanted else None
    if events is not None and events_partition_by:
        events = in_few_tasks(events)
    chain = (
        ("batting_stats_per_match", lambda: batting.batting_per_match(events, meta)),
        ("batting_stats_per_series", lambda: batting.batting_per_series(read(K.GOLD, "batting_stats_per_match"))),
        ("batting_stats_overall", lambda: batting.batting_overall(read(K.GOLD, "batting_stats_per_series"))),
        ("bowling_stats_per_match", lambda: bowling.bowling_per_match(events, meta)),
        ("bowling_stats_per_series", lambda: bowling.bowling_per_series(read(K.GOLD, "bowling_stats_per_match"))),
        ("bowling_stats_overall", lambda: bowling.bowling_overall(read(K.GOLD, "bowling_stats_per_series"))),
        ("match_summary", lambda: summary.match_summary(meta)),
        ("player_team_scd2", lambda: spans.player_team_scd2(
            spans.player_team_spans(spans.appearances(events, read(K.SILVER, "match_players")), meta))),
    )
    for name, build in chain:
        if name not in wanted:
            continue
        paths[name] = lake.overwrite(build().withColumn("gold_load_timestamp", F.current_timestamp()),
                                     K.GOLD, name, cluster_by=GOLD_CLUSTER[name])
    return paths


def run_all(spark: SparkSession, settings, zones: DataFrame, *, watermark: str | None = None,
            partition_by=None, chunk_rows: int | None = None,
            incremental_buckets: int | None = None) -> dict[str, str]:
    """One trigger of the whole flow: new files -> bronze -> silver, then gold.

    Gold is recomputed in full, or, with ``incremental_buckets``, refreshed
    only for the match buckets that received rows (``streaming.incremental``).
    """
    lake = Lake(settings.lake_root)
    bronze = run_bronze(spark, settings.source_path, lake, run_id=settings.run_id, partition_by=partition_by)
    silver_runs = run_silver(spark, lake, zones, watermark=watermark, partition_by=partition_by,
                             buckets=incremental_buckets)
    if incremental_buckets:
        incremental.refresh_gold(spark, lake, buckets=incremental_buckets, chunk_rows=chunk_rows)
        paths = {name: lake.table(K.GOLD, name) for name in GOLD_CLUSTER}
    else:
        paths = build_gold(spark, lake, chunk_rows=chunk_rows)
    gold_counts = gold_quality(spark, lake)
    rows = [row for layer, queries in ((K.BRONZE, bronze), (K.SILVER, silver_runs)) for table, q in queries.items()
            for row in quality_log.stream_rows(q, f"{layer}_{_RULE_SET[table]}", settings.run_id)]
    rows += [(settings.run_id, "gold_events", None, rule, gold_counts["total_rows"], failed)
             for rule, failed in gold_counts.items() if rule != "total_rows"]
    quality_log.record(spark, lake, rows)
    paths["quality"] = {**quality_summary(bronze, K.BRONZE), **quality_summary(silver_runs, K.SILVER),
                        "gold_events": gold_counts}
    return paths
