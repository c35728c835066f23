"""Fixture feeds with planted rule violations, for the quality-report queries.

Violations are planted at fixed key positions ``n`` so the expected counts are
known exactly: ``n % 50 = 0``, ``n % 70 = 1``, ``n % 90 = 2``, ``n % 110 = 3``,
``n % 130 = 4`` (each position rule touches a different column).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _at(n: Column, mod: int, rest: int) -> Column:
    return n % mod == rest


def _delivery_key() -> Column:
    return (F.col("matchid") - 1000) * 240 + F.col("match_ball_number") - 1


def bronze_events(deliveries: DataFrame) -> DataFrame:
    n = _delivery_key()
    return deliveries.select(
        F.lit("fixture").alias("Batchid"),
        "match_ball_number",
        F.when(_at(n, 50, 0), F.lit(None).cast("string")).otherwise(F.col("ball")).alias("ball"),
        "event", "commentary", "bowler", "batsman",
        F.when(_at(n, 70, 1), F.lit("")).otherwise(F.col("innings")).alias("innings"),
        F.when(_at(n, 90, 2), -F.col("matchid")).when(_at(n, 110, 3), F.lit(None).cast("long"))
        .otherwise(F.col("matchid")).alias("matchid"),
        "is_super_over",
        F.when(_at(n, 130, 4), F.lit(None).cast("string")).otherwise(F.lit("fixture/deliveries"))
        .alias("source_file"),
    )


def bronze_metadata(metadata: DataFrame) -> DataFrame:
    n = F.col("matchid") - 1000
    return metadata.withColumns({
        "series": F.when(_at(n, 50, 0), F.lit(None).cast("string"))
        .when(_at(n, 70, 1), F.lit("")).otherwise(F.col("series")),
        "matchid": F.when(_at(n, 90, 2), -F.col("matchid"))
        .when(_at(n, 110, 3), F.lit(None).cast("long")).otherwise(F.col("matchid")),
    })


def bronze_players(players: DataFrame) -> DataFrame:
    n = (F.col("matchid") - 1000) * 11 + F.col("batting_position") - 1
    return players.withColumns({
        "player_name": F.when(_at(n, 50, 0), F.lit(None).cast("string")).otherwise(F.col("player_name")),
        "team": F.when(_at(n, 70, 1), F.lit("")).otherwise(F.col("team")),
        "matchid": F.when(_at(n, 90, 2), -F.col("matchid"))
        .when(_at(n, 110, 3), F.lit(None).cast("long")).otherwise(F.col("matchid")),
    })


def silver_metadata_feed(metadata: DataFrame) -> DataFrame:
    """Blank series only: matchid stays intact so de-duplication is deterministic."""
    n = F.col("matchid") - 1000
    return metadata.withColumn("series", F.when(_at(n, 70, 1), F.lit("")).otherwise(F.col("series")))


def silver_events(events: DataFrame) -> DataFrame:
    n = _delivery_key()
    return events.withColumns({
        "runs": F.when(_at(n, 50, 0), F.lit(9)).otherwise(F.col("runs")),
        "Extras": F.when(_at(n, 70, 1), F.lit("other")).otherwise(F.col("Extras")),
        "over": F.when(_at(n, 90, 2), F.lit(None).cast("int")).otherwise(F.col("over")),
        "dismissal_method": F.when(_at(n, 130, 4), F.lit("Retired")).otherwise(F.col("dismissal_method")),
    }).withColumn(
        "matchid", F.when(_at(n, 110, 3), F.lit(None).cast("long")).otherwise(F.col("matchid")))


def gold_events(events: DataFrame) -> DataFrame:
    n = _delivery_key()
    return events.withColumns({
        "innings_score": F.when(_at(n, 50, 0), F.lit(-1).cast("long")).otherwise(F.col("innings_score")),
        "wickets_lost": F.when(_at(n, 70, 1), F.lit(11).cast("long"))
        .when(_at(n, 90, 2), F.lit(None).cast("long")).otherwise(F.col("wickets_lost")),
    })
