"""Batting and bowling rates; every zero denominator has an explicit branch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strike_rate(runs: Column, balls: Column) -> Column:
    """Runs per 100 balls, 2 decimals; 0.0 when no ball was faced."""
    return F.when(balls > 0, F.round(runs / balls * 100, 2)).otherwise(F.lit(0.0))


def batting_average(runs: Column, dismissals: Column) -> Column:
    """Runs per dismissal, 2 decimals; total runs when never dismissed."""
    return F.when(dismissals > 0, F.round(runs / dismissals, 2)).otherwise(runs.cast("double"))


def overs_notation(legal_balls: Column) -> Column:
    """Cricket overs: 23 legal balls -> 3.5."""
    return F.round(F.floor(legal_balls / 6) + (legal_balls % 6) / 10, 1)


def economy_rate(runs: Column, legal_balls: Column) -> Column:
    """Runs per six legal balls, 2 decimals; 0.0 when no legal ball."""
    return F.when(legal_balls > 0, F.round(runs / (legal_balls / 6), 2)).otherwise(F.lit(0.0))


def bowling_average(runs: Column, wickets: Column) -> Column:
    """Runs per wicket, 2 decimals; NULL without a wicket."""
    return F.when(wickets > 0, F.round(runs / wickets, 2)).otherwise(F.lit(None).cast("double"))


def bowling_strike_rate(legal_balls: Column, wickets: Column) -> Column:
    """Legal balls per wicket, 2 decimals; NULL without a wicket."""
    return F.when(wickets > 0, F.round(legal_balls / wickets, 2)).otherwise(F.lit(None).cast("double"))
