"""Table layout ``<root>/<layer>/<table>`` with checkpoints under ``<root>/_checkpoints``."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pitchlake.session import NO_CHECKSUM_FILES, compiled, listing

# Contract types of columns that tables may be partitioned by.
PARTITION_TYPES = {"matchid": T.LongType(), "match_bucket": T.IntegerType()}

# Sort keys of the gold tables (row-group statistics for data skipping).
GOLD_CLUSTER = {
    "match_events": ("matchid", "team", "over", "match_ball_number"),
    "batting_stats_per_match": ("matchid",),
    "batting_stats_per_series": ("series", "season"),
    "batting_stats_overall": ("batsman",),
    "bowling_stats_per_match": ("matchid",),
    "bowling_stats_per_series": ("series", "season"),
    "bowling_stats_overall": ("bowler",),
    "match_summary": ("matchid",),
    "player_team_scd2": ("player_name", "start_date"),
}


class Lake:
    """Paths and batch I/O of the bronze / silver / gold tables under one root."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def table(self, layer: str, name: str) -> str:
        return os.path.join(self.root, layer, name)

    def checkpoint(self, layer: str, name: str) -> str:
        return os.path.join(self.root, "_checkpoints", layer, name)

    def exists(self, spark: SparkSession, layer: str, name: str) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(self.table(layer, name))
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        """Full snapshot of a table. Built anew on each call, so files added by a
        later run are seen (a DataFrame's file listing is fixed when created).
        Partition columns have their contract types, not those inferred from
        directory names."""
        path, schema = self.table(layer, name), self.schema(spark, layer, name)
        with listing(spark):
            return spark.read.schema(schema).parquet(path)

    def schema(self, spark: SparkSession, layer: str, name: str) -> T.StructType:
        with listing(spark):
            found = spark.read.parquet(self.table(layer, name)).schema
        return T.StructType([T.StructField(f.name, PARTITION_TYPES.get(f.name, f.dataType), f.nullable) for f in found.fields])

    def overwrite(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] | None = None,
                  cluster_by: Sequence[str] | None = None) -> str:
        """Recomputed table: full overwrite; re-running after a failure gives the same table.

        ``cluster_by`` sorts rows within each task (no shuffle), so each row
        group of a file covers a narrow key range and parquet min/max
        statistics let a filter on those keys skip most row groups.
        """
        path = self.table(layer, name)
        if partition_by:
            # one file a value where values are small; adaptive execution splits those that are not
            df = df.hint("rebalance", *partition_by)
        if cluster_by:
            df = df.sortWithinPartitions(*dict.fromkeys([*(partition_by or ()), *cluster_by]))
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.options(**NO_CHECKSUM_FILES).partitionBy(*partition_by)
        with compiled(df.sparkSession):
            writer.parquet(path)
        return path
