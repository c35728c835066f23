"""Which team each player represented, and when (type-2 history).

Appearances are the distinct (matchid, player, team) triples from batting
deliveries and line-ups, de-duplicated once after the union (the distinct is
combined map-side, so 240 deliveries per match shrink to a few dozen rows
before any shuffle). Spans aggregate per (player, team); the history window
then runs over spans, i.e. over at most one row per team a player played for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.operators import lookups


def appearances(events: DataFrame, players: DataFrame) -> DataFrame:
    batting = events.select("matchid", F.col("batsman").alias("player_name"), "team")
    listed = players.select("matchid", "player_name", "team")
    return batting.unionByName(listed).distinct()


def player_team_spans(appearances_df: DataFrame, metadata: DataFrame) -> DataFrame:
    """First/last match date and match count per (player, team); undated matches are left out."""
    dates = metadata.select("matchid", "match_date").where(F.col("match_date").isNotNull())
    dated = lookups.join_lookup(appearances_df, dates, "matchid", "inner")
    return dated.groupBy("player_name", "team").agg(
        F.min("match_date").alias("first_match_date"),
        F.max("match_date").alias("last_match_date"),
        F.count_distinct("matchid").alias("matches_for_team"),
    )


def player_team_scd2(spans: DataFrame) -> DataFrame:
    """One validity span per (player, team).

    A span runs from the first match for the team to the first match for the
    player's next team (NULL when none); the latest span is active. Returning
    to a former team does not open a new span. Equal start dates are ordered
    by team name so the history is a function of the input.
    """
    w = Window.partitionBy("player_name").orderBy("first_match_date", "team")
    nxt = F.lead("first_match_date").over(w)
    return spans.select(
        "player_name", "team",
        F.col("first_match_date").alias("start_date"),
        nxt.alias("end_date"),
        nxt.isNull().alias("is_active"),
        "matches_for_team",
    )


def gold_player_team_scd2(events: DataFrame, players: DataFrame, metadata: DataFrame) -> DataFrame:
    spans = player_team_spans(appearances(events, players), metadata)
    return player_team_scd2(spans).withColumn("gold_load_timestamp", F.current_timestamp())
