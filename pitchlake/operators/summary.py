"""Match-level summary (narrow projection of silver metadata, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions import parse

SUMMARY_COLUMNS = (
    "matchid", "match_number", "series", "season", "team_1", "team_2", "venue", "match_date",
    "match_start_utc", "toss_winner", "toss_decision", "result_text", "winner", "win_margin",
    "result_type", "has_super_over", "super_over_count", "player_of_the_match", "umpires",
    "tv_umpire", "match_referee", "points",
)


def match_summary(metadata: DataFrame) -> DataFrame:
    result = F.col("series_result")
    return metadata.select(
        "matchid", "match_number", "series", "season",
        F.col("first_innings").alias("team_1"),
        F.col("second_innings").alias("team_2"),
        F.col("ground").alias("venue"),
        "match_date", "match_start_utc",
        F.col("toss").alias("toss_winner"),
        F.col("decision").alias("toss_decision"),
        result.alias("result_text"),
        parse.result_winner(result).alias("winner"),
        parse.result_margin(result).alias("win_margin"),
        parse.result_type(result).alias("result_type"),
        "has_super_over", "super_over_count", "player_of_the_match", "umpires", "tv_umpire",
        "match_referee", "points",
    )


def gold_match_summary(metadata: DataFrame) -> DataFrame:
    return match_summary(metadata).withColumn("gold_load_timestamp", F.current_timestamp())
