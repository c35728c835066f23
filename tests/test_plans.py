"""Plan assertions: no Python evaluation in any batch query, no driver collect in the library."""

import os
import re

import pytest

from conftest import SF_SMALL

STREAMING = {"ingest_events_csv", "ingest_metadata_json", "ingest_players_csv", "dedup_players_stream",
             "dedup_metadata_stream", "silver_players_stream", "silver_metadata_stream",
             "silver_events_stream", "gold_write_roundtrip", "ingest_events_by_header", "ingest_rerun_settings",
             "gold_refresh_two_runs", "innings_progress_chunked", "ingest_rescued_values", "ingest_header_history",
             "ingest_events_table", "dedup_state_keys", "dq_history_two_runs", "ingest_redelivered", "silver_events_repaired"}


def _batch_queries():
    import __spark_entry__ as E
    from pitchlake.plans import catalog
    return sorted(n for n in set(catalog.registry()) - STREAMING if not n.startswith("gold_"))


@pytest.mark.parametrize("name", _batch_queries())
def test_no_python_in_plan(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_scan_is_pruned(spark):
    import __spark_entry__ as E
    plan = E.queries()["batting_per_match"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))
    assert schemas and all("props" not in s and "event_type" not in s for s in schemas)


def test_no_collect_in_library():
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "pitchlake")
    allowed = {
        os.path.join("operators", "lookups.py"),          # at most five unknown zone ids
        os.path.join("streaming", "incremental.py"),      # touched bucket ids: at most `buckets` ints
        os.path.join("streaming", "medallion.py"),        # one row a quality rule
        os.path.join("streaming", "repair.py"),           # touched bucket ids
        os.path.join("sources", "tables.py"),             # a table's description
    }
    offenders = []
    for dirpath, _, names in os.walk(root):
        for n in names:
            if n.endswith(".py") and os.path.basename(dirpath) != "llm":
                path = os.path.join(dirpath, n)
                rel = os.path.relpath(path, root)
                text = open(path).read()
                if (".collect()" in text or ".toPandas()" in text or "localCheckpoint" in text) and rel not in allowed:
                    offenders.append(rel)
    assert offenders == []


@pytest.mark.parametrize("name, merged", [("innings_progress", 2), ("batting_per_match", 1), ("bowling_per_match", 1),
                                          ("maiden_overs", 1), ("player_team_spans", 1), ("dq_gold_events", 2)])
def test_delivery_shuffles(spark, name, merged):
    """Exchanges that carry delivery rows (they hold the raw event text), in the form a large input has:
    more splits than shuffle partitions, name lists joined by merge. Rows without a match id go round that
    join. With broadcast name lists there is one exchange less."""
    import __spark_entry__ as E
    found = {}
    for way, threshold in (("merge", "-1"), ("broadcast", "100m")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        try:
            df = E.queries()[name](spark, SF_SMALL)
            df.collect()  # the final adaptive plan
            text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        text = text.split("== Physical Plan ==")[-1].split("+- == Initial Plan ==")[0]
        blocks = re.split(r"\n(?=\(\d+\) )", text)
        exchanges = [b for b in blocks if re.match(r"\(\d+\) Exchange\b", b)]
        found[way] = len([b for b in exchanges if re.search(r"Input \[\d+\]: \[[^\]]*\bevent#", b)])
    assert found["merge"] <= merged and found["broadcast"] <= max(merged - 1, 0), found


def test_building_a_query_starts_few_jobs(spark):
    """Only schema reads run while a batch query is built."""
    import __spark_entry__ as E
    sc = spark.sparkContext
    for name in ("batting_overall", "bowling_overall", "match_summary", "innings_progress"):
        sc.setJobGroup(f"build-{name}", name)
        E.queries()[name](spark, SF_SMALL)
        jobs = sc.statusTracker().getJobIdsForGroup(f"build-{name}")
        sc._jsc.clearJobGroup()
        assert len(jobs) <= 1, (name, jobs)
