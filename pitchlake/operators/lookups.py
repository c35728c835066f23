"""Per-match name lists, the ground -> timezone dimension and lookup joins."""

from __future__ import annotations

import zoneinfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions import names as N


def join_lookup(left: DataFrame, right: DataFrame, on, how: str = "left") -> DataFrame:
    """Equi-join with a lookup side (at most one row per key).

    No size is counted beforehand and nothing is hinted: the planner knows the sizes
    of written tables, and adaptive execution replaces a sort-merge join by
    a broadcast when the side's bytes, known once its stage has run, are small.
    """
    return left.join(right, on=on, how=how)


def by_merge(lists: DataFrame) -> DataFrame:
    """Name lists whose joins merge on the key, whatever the planner takes the lists' size for.

    A written list table is a few bytes a match on disk, as the names of its lists repeat, and some 5 KB a match in
    memory. By its file size the planner would broadcast it, through the driver, for hundreds of thousands of matches.
    """
    return lists.hint("merge")


def match_name_lists(players: DataFrame) -> DataFrame:
    """matchid -> sorted team and player name index (see ``functions.names``).

    ``collect_set`` is combined map-side, so a match with many line-up rows is
    reduced to its distinct names before the shuffle. Rows without a matchid
    can never join and are left out, so no group collects the names of many
    matches (a per-match list is bounded by the line-up size).
    """
    return players.where(F.col("matchid").isNotNull()).groupBy("matchid").agg(
        N.collect_name_index(F.col("team")).alias("team_index"),
        N.collect_name_index(F.col("player_name")).alias("player_index"),
    )


def match_team_lists(players: DataFrame) -> DataFrame:
    return players.where(F.col("matchid").isNotNull()).groupBy("matchid").agg(N.collect_name_index(F.col("team")).alias("team_index"))


def distinct_grounds(metadata: DataFrame) -> DataFrame:
    """Distinct, non-NULL grounds: the input of a zone lookup service."""
    return metadata.select("ground").where(F.col("ground").isNotNull()).distinct()


def zone_dimension(zones: DataFrame) -> DataFrame:
    """Validated ground -> IANA zone table, one row per ground.

    An unknown zone id would make the time conversion fail at run time, so ids
    are checked up front by an anti-join with the ids of the zone database (a
    fixed table of a few hundred rows); only ids that are not in it, five at
    most, reach the driver.
    """
    one_per_ground = zones.groupBy("ground").agg(F.min("local_timezone").alias("local_timezone"))
    ids = [(z,) for z in sorted(zoneinfo.available_timezones() | {"UTC", "GMT", "Z"})]
    known = zones.sparkSession.createDataFrame(ids, "local_timezone string")
    unknown = one_per_ground.join(F.broadcast(known), "local_timezone", "left_anti").select("local_timezone").distinct()
    bad = sorted(str(r[0]) for r in unknown.limit(5).collect())
    if bad:
        raise ValueError(f"unknown time zone ids in zone dimension: {bad}")
    return one_per_ground


def with_local_timezone(metadata: DataFrame, zones: DataFrame) -> DataFrame:
    """Adds ``local_timezone`` (default "UTC" for an unknown or NULL ground)."""
    dim = zones.withColumnRenamed("local_timezone", "_zone")
    return (
        join_lookup(metadata, dim, "ground", "left")
        .withColumn("local_timezone", F.coalesce(F.col("_zone"), F.lit("UTC")))
        .drop("_zone")
    )
