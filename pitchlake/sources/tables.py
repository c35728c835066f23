"""Catalog tables over the lake's folders: described, partitioned, appended by streams, republished without a gap.

A table's files lie under a location of their own. Streams append to it (``streaming.runner.append`` with
``table``); a recomputed table is written to a fresh location first and then published by one catalog change, so a
reader sees the old rows or the new ones, never none and never a mix. The old location stays until
``retire`` removes it, for readers that planned their query before the change.

Partitions are found by listing the location, not kept in the catalog: a location change moves them all at once, and a
stream's own file log decides which of its files count.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pitchlake.session import NO_CHECKSUM_FILES, compiled

#: What each table holds; shown by DESCRIBE.
COMMENTS = {
    "bronze_match_events": "Deliveries as they came in CSV files, one row a ball.",
    "bronze_match_metadata": "Match records as they came in JSON files: ground, toss, officials, result.",
    "bronze_match_players": "Line-ups as they came in CSV files, one row a player of a match.",
    "silver_match_players": "Line-ups, one row per match, player and team.",
    "silver_match_metadata": "Matches with toss parts, session times in UTC and full team names.",
    "silver_match_events": "Deliveries with runs, extras, dismissals and full names.",
    "gold_match_events": "Silver deliveries with running score and wickets.",
    "gold_batting_stats_per_match": "Batting of a player in a match.",
    "gold_batting_stats_per_series": "Batting of a player in a series, with milestones.",
    "gold_batting_stats_overall": "Batting of a player over all series.",
    "gold_bowling_stats_per_match": "Bowling of a player in a match; byes and leg byes not charged.",
    "gold_bowling_stats_per_series": "Bowling of a player in a series, with five-wicket hauls.",
    "gold_bowling_stats_overall": "Bowling of a player over all series.",
    "gold_match_summary": "Teams, ground, toss, result and officials of a match.",
    "gold_player_team_scd2": "Which team a player appeared for, from when to when.",
}

#: The properties of the contract. Bronze and silver tables name their quality, gold ones also their layer.
def properties_of(layer: str) -> dict[str, str]:
    return {"quality": layer} | ({"pipeline.layer": layer} if layer == "gold" else {})


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@contextmanager
def _partitions_by_listing(spark: SparkSession):
    """A table remembers how its partitions are found from the setting at its creation."""
    key = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def create(spark: SparkSession, name: str, schema: T.StructType, location: str, *, partition_by: Sequence[str] = (),
           comment: str = "", properties: Mapping[str, str] | None = None) -> None:
    """Create the catalog table if there is none of that name."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    extra = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in (properties or {}).items())
    with _partitions_by_listing(spark):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} LOCATION {_text(location)} "
                  f"COMMENT {_text(comment)} {f'TBLPROPERTIES ({extra})' if extra else ''}")


def create_layer_table(spark: SparkSession, layer: str, table: str, schema: T.StructType, location: str, *,
                       database: str = "default", partition_by: Sequence[str] = ()) -> str:
    """The table ``<database>.<layer>_<table>`` with the layer's comment and properties; returns its name."""
    name = f"{database}.{layer}_{table}"
    create(spark, name, schema, location, partition_by=partition_by, comment=COMMENTS.get(f"{layer}_{table}", ""),
           properties=properties_of(layer))
    return name


def describe(spark: SparkSession, name: str) -> dict:
    """Comment, properties, partition columns and location of a table, as the catalog has them."""
    rows = [(r.col_name, r.data_type) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
    detail = dict(rows)
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return {
        "comment": detail.get("Comment", ""),
        "properties": properties,
        "partition_by": [c.name for c in spark.catalog.listColumns(name) if c.isPartition],
        "location": detail["Location"],
    }


def publish(df: DataFrame, name: str, root: str, *, partition_by: Sequence[str] = (), comment: str = "",
            properties: Mapping[str, str] | None = None) -> str | None:
    """Recompute a table: write ``df`` under a new folder of ``root``, then let the table point to it.

    Returns the location that the table had before, None for a new table. A failure before the last
    step leaves the table as it was; running again writes another folder.
    """
    spark = df.sparkSession
    location = os.path.join(root.rstrip("/"), f"v-{uuid.uuid4().hex[:12]}")
    writer = df.write
    if partition_by:
        writer = writer.options(**NO_CHECKSUM_FILES).partitionBy(*partition_by)
    with compiled(spark):
        writer.parquet(location)
    if not spark.catalog.tableExists(name):
        create(spark, name, df.schema, location, partition_by=partition_by, comment=comment, properties=properties)
        return None
    before = describe(spark, name)["location"]
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(location)}")
    spark.catalog.refreshTable(name)
    return before


def write_bucketed(df: DataFrame, name: str, location: str, buckets: int, key: str = "matchid") -> DataFrame:
    """A snapshot table in ``buckets`` files by the hash of ``key``, sorted by it, as read back.

    Joins, aggregates and windows whose keys include ``key`` then run on such tables without an exchange; the one
    shuffle is that of this write. Streams cannot write buckets, so a snapshot is taken of what they appended.
    """
    with compiled(df.sparkSession):
        (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", location)
         .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def retire(spark: SparkSession, location: str) -> None:
    """Remove a location that ``publish`` returned, once no reader needs it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
