"""A kept record of rule violations: one row a run, micro-batch, dataset and rule.

Streams report their counts as observed metrics of each micro-batch (``operators.quality.observe_rules``); after a
run they are appended to the table ``quality/violations``. A run brings as many rows as it has micro-batches and
rules, whatever its data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.sources.layout import Lake
from pitchlake.streaming.runner import Run, _counts, observed_batches

LAYER, TABLE = "quality", "violations"
SCHEMA = "run_id string, dataset string, micro_batch long, rule string, total_rows long, failed_rows long"


def stream_rows(query: Run, dataset: str, run_id: str) -> list[tuple]:
    """Rows of the last run of a stream whose rules were observed under ``dq_<dataset>``."""
    out = []
    for batch, metrics in observed_batches(query):
        if f"dq_{dataset}" in metrics:
            counts = _counts(metrics[f"dq_{dataset}"])
            total = counts.pop("total_rows")
            out += [(run_id, dataset, batch, rule, total, failed) for rule, failed in counts.items()]
    return out


def record(spark: SparkSession, lake: Lake, rows: Iterable[tuple]) -> None:
    """Append rows to the log. Recording a run again after a failure repeats its rows; ``history`` counts them once."""
    rows = list(rows)
    if rows:
        df = spark.createDataFrame(rows, SCHEMA).withColumn("recorded_at", F.current_timestamp())
        df.coalesce(1).write.mode("append").parquet(lake.table(LAYER, TABLE))


def history(spark: SparkSession, lake: Lake) -> DataFrame:
    """(run_id, dataset, rule, micro_batches, total_rows, failed_rows, recorded_at) over all recorded runs."""
    key = ["run_id", "dataset", "rule", "micro_batch"]
    last = lake.read(spark, LAYER, TABLE).groupBy(*key).agg(
        F.max_by(F.struct("total_rows", "failed_rows", "recorded_at"), "recorded_at").alias("r"))
    return last.groupBy("run_id", "dataset", "rule").agg(
        F.count("*").alias("micro_batches"), F.sum("r.total_rows").alias("total_rows"),
        F.sum("r.failed_rows").alias("failed_rows"), F.max("r.recorded_at").alias("recorded_at"))
