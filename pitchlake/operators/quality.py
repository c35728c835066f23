"""Data-quality rules: violations are reported, never dropped.

``quality_report`` evaluates every rule of a dataset in ONE global aggregate
(partial counts per task, a single-row merge), so the cost is one scan and no
data shuffle. A rule whose predicate is NULL counts as failed. On streams,
``observe_rules`` attaches the same counts as observed metrics of every
micro-batch (``query.lastProgress["observedMetrics"]``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake import constants as K


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# Rule names and predicates are the contract of the quality reports.
RULES: dict[str, dict[str, str]] = {
    "bronze_events": {
        "matchid_not_null": "matchid IS NOT NULL",
        "matchid_positive": "matchid > 0",
        "ball_not_null": "ball IS NOT NULL AND ball != ''",
        "innings_not_null": "innings IS NOT NULL AND innings != ''",
        "source_file_present": "source_file IS NOT NULL",
    },
    "bronze_metadata": {
        "matchid_not_null": "matchid IS NOT NULL",
        "matchid_positive": "matchid > 0",
        "series_not_null": "series IS NOT NULL AND series != ''",
    },
    "bronze_players": {
        "matchid_not_null": "matchid IS NOT NULL",
        "matchid_positive": "matchid > 0",
        "player_name_not_null": "player_name IS NOT NULL AND player_name != ''",
        "team_not_null": "team IS NOT NULL AND team != ''",
    },
    "silver_players": {
        "matchid_not_null": "matchid IS NOT NULL",
        "player_name_not_null": "player_name IS NOT NULL AND player_name != ''",
        "team_not_null": "team IS NOT NULL AND team != ''",
    },
    "silver_metadata": {
        "matchid_not_null": "matchid IS NOT NULL",
        "series_not_null": "series IS NOT NULL AND series != ''",
        "match_date_present": "match_date IS NOT NULL",
    },
    "silver_events": {
        "matchid_not_null": "matchid IS NOT NULL",
        "runs_not_null": "runs IS NOT NULL",
        "runs_valid_range": "runs >= 0 AND runs <= 7",
        "over_not_null": "over IS NOT NULL",
        "extras_valid_domain": f"Extras IN ({_in_list(K.EXTRAS_DOMAIN)})",
        "dismissal_valid": f"dismissal_method IN ({_in_list(K.DISMISSAL_DOMAIN)})",
    },
    "gold_events": {
        "innings_score_non_negative": "innings_score >= 0",
        "wickets_range": "wickets_lost >= 0 AND wickets_lost <= 10",
    },
}


def _failed(predicate: str) -> Column:
    return ~F.coalesce(F.expr(predicate), F.lit(False))


def rule_metrics(rules: dict[str, str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("total_rows")] + [
        F.count_if(_failed(p)).alias(name) for name, p in rules.items()
    ]


def quality_report(df: DataFrame, dataset: str, rules: dict[str, str] | None = None) -> DataFrame:
    """Long form (dataset, rule, total_rows, failed_rows), one row per rule."""
    rules = RULES[dataset] if rules is None else rules
    counts = df.agg(*rule_metrics(rules))
    rows = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("failed_rows")) for name in rules
    ])
    return counts.select(F.lit(dataset).alias("dataset"), "total_rows", F.inline(rows)).select(
        "dataset", "rule", "total_rows", "failed_rows")


def observe_rules(df: DataFrame, dataset: str, rules: dict[str, str] | None = None) -> DataFrame:
    """Same counts as observed metrics named ``dq_<dataset>``, per batch or micro-batch."""
    rules = RULES[dataset] if rules is None else rules
    return df.observe(f"dq_{dataset}", *rule_metrics(rules))
