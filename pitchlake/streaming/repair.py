"""Names that came late: deliveries and matches whose line-up arrived after them get the names of an in-order run.

Silver tables are append-only, so a delivery processed before its line-up keeps short names (or a
name picked from a list that was not complete). ``repair`` finds the matches concerned by the load
times of their rows, derives their silver rows again from bronze with the whole line-up, and writes them
beside the silver tables, partitioned by match bucket; a later repair rewrites only the buckets of matches
whose line-up changed since. ``current`` reads a silver table with the repaired rows in place of the old ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake import constants as K
from pitchlake.operators import lookups, silver
from pitchlake.session import compiled
from pitchlake.sources.layout import Lake
from pitchlake.streaming import incremental

#: Tables with names from the line-ups.
TABLES = ("match_metadata", "match_events")
LAYER, LOG = "repaired", "matches"


def _repaired(spark: SparkSession, lake: Lake, name: str) -> DataFrame | None:
    """A repaired table, None while there is none."""
    return lake.read(spark, LAYER, name) if lake.exists(spark, LAYER, name) else None


def late_matches(spark: SparkSession, lake: Lake) -> DataFrame:
    """(matchid, lineup_at) of matches with a line-up row loaded after one of their deliveries or their metadata."""
    lineup = lake.read(spark, K.SILVER, "match_players").groupBy("matchid").agg(F.max("silver_load_timestamp").alias("lineup_at"))
    first = None
    for name in TABLES:
        seen = lake.read(spark, K.SILVER, name).groupBy("matchid").agg(F.min("silver_load_timestamp").alias("first_at"))
        first = seen if first is None else first.unionByName(seen)
    return lineup.join(first.groupBy("matchid").agg(F.min("first_at").alias("first_at")), "matchid").where(
        "lineup_at > first_at").select("matchid", "lineup_at")


def repair(spark: SparkSession, lake: Lake, zones: DataFrame, *, buckets: int = 1024) -> list[int]:
    """Derive the silver rows of late matches again; returns the match buckets that were rewritten.

    A bucket is written whole from its late matches, so running again after a failure gives the same
    tables; the log of repaired matches is written last. At most ``buckets`` integers reach the driver.
    """
    late = incremental.with_bucket(late_matches(spark, lake), buckets)
    done = _repaired(spark, lake, LOG)
    new = late if done is None else late.join(done.select("matchid", "lineup_at"), ["matchid", "lineup_at"], "left_anti")
    touched = sorted(r[0] for r in new.select(incremental.BUCKET).distinct().collect())
    if not touched:
        return []
    todo = late.where(F.col(incremental.BUCKET).isin(touched)).select("matchid", "lineup_at")
    players = lake.read(spark, K.SILVER, "match_players").join(todo.select("matchid"), "matchid", "left_semi")
    lists = lookups.match_name_lists(players)
    bronze = {t: lake.read(spark, K.BRONZE, t).join(todo.select("matchid"), "matchid", "left_semi") for t in TABLES}
    rows = {
        # the row that silver kept: a match has one, and its bronze copies are the same but for their times
        "match_metadata": silver.silver_metadata(bronze["match_metadata"], None, lookups.zone_dimension(zones), lists=lists),
        "match_events": silver.silver_events(bronze["match_events"], None, lists=lists),
        LOG: todo,
    }
    for name, df in rows.items():
        with compiled(spark):
            (incremental.with_bucket(df, buckets).hint("rebalance", incremental.BUCKET).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(incremental.BUCKET).parquet(lake.table(LAYER, name)))
    return touched


def current(spark: SparkSession, lake: Lake, layer: str, name: str) -> DataFrame:
    """A table as ``Lake.read`` gives it, silver tables with repaired rows in place of those of repaired matches."""
    rows = lake.read(spark, layer, name)
    log = _repaired(spark, lake, LOG) if layer == K.SILVER and name in TABLES else None
    if log is None:
        return rows
    mended = _repaired(spark, lake, name).drop(incremental.BUCKET)
    rows = rows.drop(incremental.BUCKET)
    # rows without a match id have no line-up: they stay as they are
    return rows.join(log.select("matchid"), "matchid", "left_anti").select(*mended.columns).unionByName(mended)
