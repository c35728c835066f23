"""Batting statistics per match, per series and over a career.

Per match, runs, balls, run counts and dismissals come from ONE aggregate over
(matchid, batsman, team); series and season are attached afterwards by a join
of the (much smaller) aggregate to the metadata. Because metadata holds one
row per match, this equals grouping by (matchid, batsman, team, series,
season) after joining every delivery, at a fraction of the join input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake import constants as K
from pitchlake.functions import rates
from pitchlake.operators import lookups

RUN_COUNTS = ("runs_1s", "runs_2s", "runs_3s", "runs_4s", "runs_5s", "runs_6s")


def _run_counts(value: str) -> list:
    v = F.col(value)
    return [F.count_if(v == n).alias(f"runs_{n}s") for n in range(1, 6)] + [F.count_if(v >= 6).alias("runs_6s")]


def batting_per_match(events: DataFrame, metadata: DataFrame) -> DataFrame:
    flags = events.select(
        "matchid", "batsman", "team",
        F.when(F.col("Extras").isin(K.EXTRAS_LEGBYES, K.EXTRAS_BYES, K.EXTRAS_WIDE), F.lit(0))
        .otherwise(F.col("runs")).alias("batsman_runs"),
        F.when(F.col("Extras") == K.EXTRAS_WIDE, F.lit(0)).otherwise(F.lit(1)).alias("ball_faced"),
        (F.col("dismissal_method") != K.NOT_OUT).alias("dismissed"),
    )
    agg = flags.groupBy("matchid", "batsman", "team").agg(
        F.sum("ball_faced").alias("balls_faced"),
        F.sum("batsman_runs").alias("total_runs"),
        F.count_if(F.col("batsman_runs") == 0).alias("dot_balls"),
        *_run_counts("batsman_runs"),
        F.count_if("dismissed").alias("times_dismissed"),
    )
    out = lookups.join_lookup(agg, metadata.select("matchid", "series", "season"), "matchid", "left")
    return out.select(
        "matchid", "series", "season", "batsman", "team", "balls_faced", "total_runs",
        rates.strike_rate(F.col("total_runs"), F.col("balls_faced")).alias("strike_rate"),
        "dot_balls", *RUN_COUNTS,
        (F.col("times_dismissed") == 0).alias("not_out"),
        "times_dismissed",
    )


def _career_columns() -> list:
    return [
        rates.strike_rate(F.col("total_runs"), F.col("total_balls_faced")).alias("strike_rate"),
        rates.batting_average(F.col("total_runs"), F.col("total_dismissals")).alias("batting_average"),
    ]


def batting_per_series(per_match: DataFrame) -> DataFrame:
    agg = per_match.groupBy("series", "season", "batsman").agg(
        F.count_distinct("matchid").alias("matches_played"),
        F.sum("balls_faced").alias("total_balls_faced"),
        F.sum("total_runs").alias("total_runs"),
        F.sum("dot_balls").alias("dot_balls"),
        *[F.sum(c).alias(c) for c in RUN_COUNTS],
        F.count_if(F.col("total_runs") >= 30).alias("scores_gte_30"),
        F.count_if(F.col("total_runs") >= 50).alias("scores_gte_50"),
        F.count_if(F.col("total_runs") >= 100).alias("scores_gte_100"),
        F.count_if("not_out").alias("not_out_count"),
        F.sum("times_dismissed").alias("total_dismissals"),
    )
    return agg.select(
        "series", "season", "batsman", "matches_played", "total_balls_faced", "total_runs",
        *_career_columns(), "dot_balls", *RUN_COUNTS,
        "scores_gte_30", "scores_gte_50", "scores_gte_100", "not_out_count", "total_dismissals",
    )


def batting_overall(per_series: DataFrame) -> DataFrame:
    """Career totals. ``series_played`` counts distinct series names (a series in
    two seasons counts once); ``total_matches`` adds the per-series counts."""
    summed = ("total_balls_faced", "total_runs", "dot_balls", *RUN_COUNTS,
              "scores_gte_30", "scores_gte_50", "scores_gte_100", "not_out_count", "total_dismissals")
    agg = per_series.groupBy("batsman").agg(
        F.count_distinct("series").alias("series_played"),
        F.sum("matches_played").alias("total_matches"),
        *[F.sum(c).alias(c) for c in summed],
    )
    return agg.select(
        "batsman", "series_played", "total_matches", "total_balls_faced", "total_runs",
        *_career_columns(), "dot_balls", *RUN_COUNTS,
        "scores_gte_30", "scores_gte_50", "scores_gte_100", "not_out_count", "total_dismissals",
    )
