"""Quality reports: counts, NULL predicates, observed metrics."""

from pitchlake.operators import quality


def test_report_counts_null_as_failed(spark):
    df = spark.createDataFrame([(1, "a"), (-1, ""), (None, None), (2, "b")], "matchid long, series string")
    rules = {"matchid_positive": "matchid > 0", "series_not_null": "series IS NOT NULL AND series != ''"}
    got = {r.rule: (r.total_rows, r.failed_rows) for r in quality.quality_report(df, "t", rules).collect()}
    assert got == {"matchid_positive": (4, 2), "series_not_null": (4, 2)}


def test_observe_rules_on_batch(spark):
    df = spark.createDataFrame([(1,), (None,)], "matchid long")
    from pyspark.sql import Observation
    obs = Observation("dq")
    rules = {"matchid_not_null": "matchid IS NOT NULL"}
    df.observe(obs, *quality.rule_metrics(rules)).count()
    assert obs.get == {"total_rows": 2, "matchid_not_null": 1}


def test_rule_sets_cover_all_datasets():
    assert set(quality.RULES) == {"bronze_events", "bronze_metadata", "bronze_players", "silver_players",
                                  "silver_metadata", "silver_events", "gold_events"}
    assert sum(len(v) for v in quality.RULES.values()) == 26
