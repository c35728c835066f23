"""Bowling statistics per match, per series and over a career.

Per match is a two-level aggregate: deliveries -> (matchid, bowler, over),
which yields both the maiden test and partial sums of every other measure,
then -> (matchid, bowler). No self-join; series and season are attached to
the small per-match result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake import constants as K
from pitchlake.functions import rates
from pitchlake.operators import lookups

RUN_COUNTS = tuple(f"runs_{n}s_conceded" for n in range(1, 7))


def _flags(events: DataFrame) -> DataFrame:
    legal = F.when(F.col("Extras").isin(K.EXTRAS_WIDE, K.EXTRAS_NOBALL), F.lit(0)).otherwise(F.lit(1))
    bowler_runs = F.when(F.col("Extras").isin(K.EXTRAS_LEGBYES, K.EXTRAS_BYES), F.lit(0)).otherwise(F.col("runs"))
    method = F.col("dismissal_method")
    return events.select(
        "matchid", "bowler", "over",
        legal.alias("legal"),
        bowler_runs.alias("bowler_runs"),
        ((method != K.NOT_OUT) & (method != K.RUN_OUT)).alias("wicket"),
    )


def per_over(events: DataFrame) -> DataFrame:
    """(matchid, bowler, over) partial sums; super-over balls share over 1.

    Deliveries without a bowler are dropped (an empty, unparsed bowler name
    stays as its own group). The NULL test is applied to the grouped rows
    (``count(bowler) > 0``) rather than to the deliveries: a filter on the
    delivery column would be pushed below the projection that resolves the
    bowler name and make the plan resolve every name twice.
    """
    r = F.col("bowler_runs")
    return _flags(events).groupBy("matchid", "bowler", "over").agg(
        F.count("bowler").alias("_bowler_rows"),
        F.count(F.lit(1)).alias("deliveries"),
        F.sum("legal").alias("legal_balls"),
        F.sum("bowler_runs").alias("bowler_runs"),
        F.count_if((F.col("legal") == 1) & (r == 0)).alias("dot_balls"),
        F.count_if("wicket").alias("wickets"),
        *[F.count_if(r == n).alias(f"runs_{n}s_conceded") for n in range(1, 6)],
        F.count_if(r >= 6).alias("runs_6s_conceded"),
    ).where(F.col("_bowler_rows") > 0).drop("_bowler_rows")


def _is_maiden():
    return (F.col("legal_balls") == 6) & (F.col("bowler_runs") == 0)


def maiden_overs(events: DataFrame, metadata: DataFrame) -> DataFrame:
    agg = per_over(events).groupBy("matchid", "bowler").agg(F.count_if(_is_maiden()).alias("maiden_overs"))
    return lookups.join_lookup(agg, metadata.select("matchid", "series", "season"), "matchid", "left").select(
        "matchid", "bowler", "series", "season", "maiden_overs")


def bowling_per_match(events: DataFrame, metadata: DataFrame) -> DataFrame:
    agg = per_over(events).groupBy("matchid", "bowler").agg(
        F.sum("deliveries").alias("total_deliveries"),
        F.sum("legal_balls").alias("legal_balls_bowled"),
        F.sum("bowler_runs").alias("runs_conceded"),
        F.count_if(_is_maiden()).alias("maiden_overs"),
        F.sum("dot_balls").alias("dot_balls"),
        *[F.sum(c).alias(c) for c in RUN_COUNTS],
        F.sum("wickets").alias("wickets_taken"),
    )
    out = lookups.join_lookup(agg, metadata.select("matchid", "series", "season"), "matchid", "left")
    return out.select(
        "matchid", "series", "season", "bowler", "total_deliveries", "legal_balls_bowled",
        rates.overs_notation(F.col("legal_balls_bowled")).alias("overs_bowled"),
        "runs_conceded",
        rates.economy_rate(F.col("runs_conceded"), F.col("legal_balls_bowled")).alias("economy_rate"),
        "maiden_overs", "dot_balls", *RUN_COUNTS, "wickets_taken",
    )


def _career_columns() -> list:
    legal, runs, wk = F.col("total_legal_balls"), F.col("total_runs_conceded"), F.col("total_wickets")
    return [
        rates.overs_notation(legal).alias("total_overs_bowled"),
        "total_runs_conceded",
        rates.economy_rate(runs, legal).alias("economy_rate"),
        rates.bowling_average(runs, wk).alias("bowling_average"),
        rates.bowling_strike_rate(legal, wk).alias("bowling_strike_rate"),
    ]


def bowling_per_series(per_match: DataFrame) -> DataFrame:
    agg = per_match.groupBy("series", "season", "bowler").agg(
        F.count_distinct("matchid").alias("matches_played"),
        F.sum("total_deliveries").alias("total_deliveries"),
        F.sum("legal_balls_bowled").alias("total_legal_balls"),
        F.sum("runs_conceded").alias("total_runs_conceded"),
        F.sum("maiden_overs").alias("total_maiden_overs"),
        F.sum("dot_balls").alias("total_dot_balls"),
        F.sum("wickets_taken").alias("total_wickets"),
        *[F.sum(c).alias(c) for c in RUN_COUNTS],
        F.count_if(F.col("wickets_taken") >= 5).alias("five_wicket_hauls"),
    )
    return agg.select(
        "series", "season", "bowler", "matches_played", "total_deliveries", "total_legal_balls",
        *_career_columns(), "total_maiden_overs", "total_dot_balls", *RUN_COUNTS,
        "total_wickets", "five_wicket_hauls",
    )


def bowling_overall(per_series: DataFrame) -> DataFrame:
    summed = ("total_deliveries", "total_legal_balls", "total_runs_conceded", "total_maiden_overs",
              "total_dot_balls", "total_wickets", *RUN_COUNTS, "five_wicket_hauls")
    agg = per_series.groupBy("bowler").agg(
        F.count_distinct("series").alias("series_played"),
        F.sum("matches_played").alias("total_matches"),
        *[F.sum(c).alias(c) for c in summed],
    )
    return agg.select(
        "bowler", "series_played", "total_matches", "total_deliveries", "total_legal_balls",
        *_career_columns(), "total_maiden_overs", "total_dot_balls", *RUN_COUNTS,
        "total_wickets", "five_wicket_hauls",
    )
