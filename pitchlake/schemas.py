"""Explicit schemas of the three input feeds and the column lists of each dataset.

Feeds are read with a fixed schema, never inferred: inference would turn the
``ball`` label "0.10" into the number 0.1 and lose the tenth-ball label.
``matchid`` comes from the ``matchid=<n>`` directory of each file.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, order and types below are the contract of the feeds and datasets.

# Columns stored inside the delivery CSV (matchid is the directory).
EVENTS_FILE_SCHEMA = T.StructType([
    T.StructField("match_ball_number", T.LongType()),
    T.StructField("ball", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("commentary", T.StringType()),
    T.StructField("bowler", T.StringType()),
    T.StructField("batsman", T.StringType()),
    T.StructField("innings", T.StringType()),
    T.StructField("is_super_over", T.BooleanType()),
    T.StructField("matchid", T.LongType()),
])

METADATA_TEXT_FIELDS = (
    "ground", "toss", "series", "season", "player_of_the_match", "player_of_the_series",
    "hours_of_play_local_time", "match_days", "t20_debut", "t20i_debut", "umpires",
    "tv_umpire", "reserve_umpire", "match_referee", "points", "match_number",
)

METADATA_FILE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in METADATA_TEXT_FIELDS]
    + [
        T.StructField("player_replacements", T.StringType()),
        T.StructField("first_innings", T.StringType()),
        T.StructField("second_innings", T.StringType()),
        T.StructField("has_super_over", T.BooleanType()),
        T.StructField("super_over_count", T.IntegerType()),
        T.StructField("series_result", T.StringType()),
        T.StructField("matchid", T.LongType()),
    ]
)

PLAYERS_FILE_SCHEMA = T.StructType([
    T.StructField("innings", T.StringType()),
    T.StructField("team", T.StringType()),
    T.StructField("player_name", T.StringType()),
    T.StructField("batted", T.BooleanType()),
    T.StructField("batting_position", T.IntegerType()),
    T.StructField("player_type", T.StringType()),
    T.StructField("retired", T.StringType()),
    T.StructField("not_out", T.StringType()),
    T.StructField("bowled", T.StringType()),
    T.StructField("matchid", T.LongType()),
])

# Bronze column order (data columns between Batchid and the provenance columns).
BRONZE_EVENTS_COLUMNS = (
    "match_ball_number", "ball", "event", "commentary", "bowler", "batsman", "innings",
    "matchid", "is_super_over",
)
BRONZE_METADATA_COLUMNS = METADATA_TEXT_FIELDS + (
    "matchid", "player_replacements", "first_innings", "second_innings",
    "has_super_over", "super_over_count", "series_result",
)
BRONZE_PLAYERS_COLUMNS = (
    "matchid", "innings", "team", "player_name", "batted", "batting_position",
    "player_type", "retired", "not_out", "bowled",
)
AUDIT_COLUMNS = ("source_file", "load_timestamp")

SILVER_PLAYERS_COLUMNS = ("Batchid",) + BRONZE_PLAYERS_COLUMNS + AUDIT_COLUMNS

SILVER_METADATA_COLUMNS = (
    "Batchid", "matchid", "ground", "toss", "decision", "series", "season",
    "player_of_the_match", "player_of_the_series", "t20_debut", "t20i_debut",
    "umpires", "tv_umpire", "reserve_umpire", "match_referee", "points",
    "player_replacements", "match_number", "match_date", "match_start_utc",
    "first_innings_start_utc", "first_innings_end_utc", "second_innings_start_utc",
    "second_innings_end_utc", "first_innings", "second_innings", "has_super_over",
    "super_over_count", "series_result",
) + AUDIT_COLUMNS

SILVER_EVENTS_COLUMNS = (
    "Batchid", "matchid", "event", "ball", "over", "over_ball_number", "match_ball_number",
    "runs", "commentary", "bowler", "batsman", "team", "is_super_over", "super_over_team",
    "runs_text", "Extras", "dismissal_method", "dismissed_by",
) + AUDIT_COLUMNS

ZONES_SCHEMA = T.StructType([
    T.StructField("ground", T.StringType(), False),
    T.StructField("local_timezone", T.StringType(), False),
])
