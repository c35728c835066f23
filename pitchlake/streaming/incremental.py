"""Incremental gold refresh: recompute only the matches that received new rows.

Every per-match gold table (running innings scores, batting and bowling per
match, match summary, appearances) depends on one match's deliveries,
metadata and line-up only. Matches are hashed into ``buckets`` groups; the
per-match tables are partitioned by that bucket. A refresh:

1. reads the ``matchid`` of the rows appended to the three silver tables
   since the last refresh (one stream over the silver tables, progress kept
   in its checkpoint);
2. per micro-batch, collects the set of touched buckets (at most
   ``buckets`` small integers), recomputes the per-match tables for those
   buckets only (filters on the bucket prune the silver tables when they are
   partitioned by it) and replaces exactly those partitions
   (``partitionOverwriteMode=dynamic``);
3. rebuilds, in the series, career and history tables, only the rows of the groups (player of a
   series, player) that the touched matches belong to, before or after the refresh; all other
   rows are carried over as they are. Distinct counts stay exact, as a touched group is counted anew
   from its per-match (or per-series) rows.

A failed batch is re-run from the checkpoint; rewriting a bucket is
idempotent, and the groups that its matches belonged to before are noted before anything is
rewritten, so a second attempt knows them too. Until then, tables already rewritten are a batch ahead of the others. The unit of work is the bucket, not the match: m changed matches
rewrite up to m buckets whole, so a batch of as many matches as there are buckets
is close to a full build. The first refresh touches every bucket and equals one.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake import constants as K
from pitchlake.operators import batting, bowling, innings, spans, summary
from pitchlake.session import fresh_dir, listing, sized_by_rows
from pitchlake.sources.layout import GOLD_CLUSTER, Lake

BUCKET = "match_bucket"
SILVER_TABLES = ("match_events", "match_metadata", "match_players")


def bucket_of(matchid: Column, buckets: int) -> Column:
    """Stable bucket of a match (a NULL matchid has a bucket too)."""
    return F.pmod(F.xxhash64(matchid), F.lit(buckets)).cast("int")


def with_bucket(df: DataFrame, buckets: int) -> DataFrame:
    """Adds the bucket column, e.g. to write silver tables partitioned by it."""
    return df.withColumn(BUCKET, bucket_of(F.col("matchid"), buckets))


def _only(df: DataFrame, touched: list[int], buckets: int) -> DataFrame:
    col = F.col(BUCKET) if BUCKET in df.columns else bucket_of(F.col("matchid"), buckets)
    return df.where(col.isin(touched))


def _write_buckets(df: DataFrame, path: str, buckets: int, sort_keys=("matchid",)) -> None:
    # rows of a bucket meet in few files; adaptive execution splits a bucket that is too large for one
    (with_bucket(df.withColumn("gold_load_timestamp", F.current_timestamp()), buckets).hint("rebalance", BUCKET)
     .sortWithinPartitions(BUCKET, *sort_keys)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(path))


def _drop_bucket(df: DataFrame) -> DataFrame:
    return df.drop(BUCKET) if BUCKET in df.columns else df


#: Derived table -> (source table, columns that name a group).
GROUPS = {
    "batting_stats_per_series": ("batting_stats_per_match", ("series", "season", "batsman")),
    "batting_stats_overall": ("batting_stats_per_series", ("batsman",)),
    "bowling_stats_per_series": ("bowling_stats_per_match", ("series", "season", "bowler")),
    "bowling_stats_overall": ("bowling_stats_per_series", ("bowler",)),
    "player_team_scd2": ("appearances", ("player_name",)),
}
_BUILD = {
    "batting_stats_per_series": batting.batting_per_series,
    "batting_stats_overall": batting.batting_overall,
    "bowling_stats_per_series": bowling.bowling_per_series,
    "bowling_stats_overall": bowling.bowling_overall,
}
#: The per-match table whose rows tell the groups of a derived table, and the name of its player column.
_SEEN_IN = {"batting": ("batting_stats_per_match", "batsman"), "bowling": ("bowling_stats_per_match", "bowler"),
            "player": ("appearances", "player_name")}
_KEYS = "family string, series string, season string, player string"


def _groups_of(spark: SparkSession, lake: Lake, touched: list[int]) -> DataFrame:
    """(family, series, season, player) of the per-match rows in the touched buckets, as the tables stand."""
    out = spark.createDataFrame([], _KEYS)
    for family, (table, player) in _SEEN_IN.items():
        if lake.exists(spark, K.GOLD, table):
            rows = lake.read(spark, K.GOLD, table).where(F.col(BUCKET).isin(touched))
            series = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in ("series", "season")]
            out = out.unionByName(rows.select(F.lit(family).alias("family"), *series, F.col(player).alias("player")))
    return out.distinct()


def _refresh_groups(spark: SparkSession, lake: Lake, name: str, touched: DataFrame) -> None:
    """Rebuild the rows of a derived table whose groups are touched, carry over the others."""
    source, keys = GROUPS[name]
    family = "player" if name == "player_team_scd2" else name.split("_")[0]
    player = keys[-1]
    groups = touched.where(F.col("family") == family).select(*keys[:-1], F.col("player").alias(player)).distinct()
    groups = groups.select(*[F.col(c).alias(f"_{c}") for c in keys])
    same = lambda df: reduce(Column.__and__, [df[c].eqNullSafe(F.col(f"_{c}")) for c in keys])
    rows = lake.read(spark, K.GOLD, source)
    rows = rows.drop(*[c for c in (BUCKET, "gold_load_timestamp") if c in rows.columns])
    rows = rows.join(groups, same(rows), "left_semi")
    if name == "player_team_scd2":
        meta = _drop_bucket(lake.read(spark, K.SILVER, "match_metadata"))
        built = spans.player_team_scd2(spans.player_team_spans(rows, meta))
    else:
        built = _BUILD[name](rows)
    built = built.withColumn("gold_load_timestamp", F.current_timestamp())
    if lake.exists(spark, K.GOLD, name):
        old = lake.read(spark, K.GOLD, name)
        built = built.unionByName(old.join(groups, same(old), "left_anti"))
    staged = fresh_dir(spark, f"refresh-{name}")  # a table cannot be overwritten from itself
    built.write.parquet(staged)
    lake.overwrite(spark.read.schema(built.schema).parquet(staged), K.GOLD, name, cluster_by=GOLD_CLUSTER[name])


def refresh_buckets(spark: SparkSession, lake: Lake, touched: list[int], buckets: int,
                    chunk_rows: int | None = None, batch: str | None = None) -> None:
    """Recompute the per-match gold tables for the given buckets, then the touched groups of the derived levels.

    ``batch`` names the refresh; a repeated one finds the groups noted by the attempt before.
    """
    with sized_by_rows(spark):
        _refresh_buckets(spark, lake, touched, buckets, chunk_rows, batch)


def _refresh_buckets(spark: SparkSession, lake: Lake, touched: list[int], buckets: int, chunk_rows: int | None, batch: str | None) -> None:
    events = _only(lake.read(spark, K.SILVER, "match_events"), touched, buckets).transform(_drop_bucket)
    meta = _only(lake.read(spark, K.SILVER, "match_metadata"), touched, buckets).transform(_drop_bucket)
    players = _only(lake.read(spark, K.SILVER, "match_players"), touched, buckets).transform(_drop_bucket)

    noted = lake.table("_refresh", batch or uuid.uuid4().hex)
    _groups_of(spark, lake, touched).write.mode("append").parquet(noted)
    per_match = {
        "match_events": innings.gold_events(events, chunk_rows).drop("gold_load_timestamp"),
        "batting_stats_per_match": batting.batting_per_match(events, meta),
        "bowling_stats_per_match": bowling.bowling_per_match(events, meta),
        "match_summary": summary.match_summary(meta),
        "appearances": spans.appearances(events, players),
    }
    for name, df in per_match.items():
        _write_buckets(df, lake.table(K.GOLD, name), buckets, GOLD_CLUSTER.get(name, ("matchid",)))

    groups = fresh_dir(spark, "refresh-groups")
    before = spark.read.schema(_KEYS).parquet(noted)
    before.unionByName(_groups_of(spark, lake, touched)).distinct().write.parquet(groups)
    for name in GROUPS:
        _refresh_groups(spark, lake, name, spark.read.schema(_KEYS).parquet(groups))


def refresh_gold(spark: SparkSession, lake: Lake, *, buckets: int = 1024,
                 chunk_rows: int | None = None) -> list[list[int]]:
    """Apply all silver rows appended since the last refresh; returns the touched buckets per batch."""
    changes = None
    for table in SILVER_TABLES:
        schema = lake.schema(spark, K.SILVER, table)
        with listing(spark):
            ids = spark.readStream.schema(schema).parquet(lake.table(K.SILVER, table)).select("matchid")
        changes = ids if changes is None else changes.unionByName(ids)
    applied: list[list[int]] = []

    def apply(batch: DataFrame, batch_id: int) -> None:
        # at most `buckets` small integers reach the driver
        touched = sorted(r[0] for r in batch.select(bucket_of(F.col("matchid"), buckets)).distinct().collect())
        if touched:
            refresh_buckets(spark, lake, touched, buckets, chunk_rows, batch=f"batch-{batch_id}")
            applied.append(touched)

    with listing(spark):
        query = (changes.writeStream.foreachBatch(apply)
                 .option("checkpointLocation", lake.checkpoint(K.GOLD, "_refresh"))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"gold refresh failed: {query.exception()}")
    return applied
