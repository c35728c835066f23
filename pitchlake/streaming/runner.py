"""Incremental runs: each call processes what arrived since the last one, then stops.

``append`` starts a query with ``trigger(availableNow=True)`` and waits for it.
Progress (files read, state) lives in the checkpoint, so a re-run reads only
new files and an executor lost mid-run is retried by Spark; a failed run is
simply started again from the same checkpoint.
"""

from __future__ import annotations

import gc
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pitchlake.session import listing

# How often a run reads the progress of its micro-batches. Spark keeps the last
# hundred reports of a query, and a micro-batch writes its checkpoint files,
# so no hundred of them fit between two reads; a gap would raise all the same.
POLL_S = 0.05


@dataclass(frozen=True)
class Run:
    """A finished run: names of its query and the progress of all its micro-batches, in order.

    Not the query itself: with it the driver would keep its file listings and plans, several KB for each file read.
    """

    id: str
    runId: str
    name: str | None
    recentProgress: list = field(repr=False)

    @property
    def lastProgress(self):
        return self.recentProgress[-1] if self.recentProgress else None


def _batch_id(p) -> int:
    return p.get("batchId") if isinstance(p, dict) else getattr(p, "batchId", -1)


def _collect(query: StreamingQuery, seen: dict[int, object]) -> None:
    for p in query.recentProgress:
        seen.setdefault(_batch_id(p), p)


def append(df: DataFrame, path: str | None, checkpoint: str, *, partition_by: Sequence[str] | None = None,
           fmt: str = "parquet", query_name: str | None = None, table: str | None = None) -> Run:
    """Append a stream to a file table until all currently available input is processed.

    The files go to ``path``, or, with ``table``, to the location of that catalog table.
    """
    writer = (df.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    seen: dict[int, object] = {}
    with listing(df.sparkSession):  # a file source lists with the session's settings of the moment
        query = writer.toTable(table) if table else writer.start(path)
        while not query.awaitTermination(POLL_S):
            _collect(query, seen)
    _collect(query, seen)
    if query.exception() is not None:
        raise RuntimeError(f"stream {query_name or table or path} failed: {query.exception()}")
    if seen and len(seen) != max(seen) - min(seen) + 1:
        raise RuntimeError(f"stream {query_name or table or path}: progress of some micro-batches is missing")
    run = Run(query.id, query.runId, query.name, [seen[k] for k in sorted(seen)])
    del writer, query
    # Python's proxies of JVM objects point to themselves: without this the query would stay until Python happens to collect
    gc.collect()
    return run


def observed_batches(query: Run | StreamingQuery) -> list[tuple[int, dict]]:
    """(micro-batch, observed metrics) of the last run, for micro-batches that observed any."""
    out = []
    for p in query.recentProgress:
        metrics = p.get("observedMetrics") if isinstance(p, dict) else getattr(p, "observedMetrics", None)
        if metrics:
            out.append((_batch_id(p), dict(metrics)))
    return out


def observed_metrics(query: Run | StreamingQuery) -> list[dict]:
    """Observed metrics (e.g. quality counts) of every micro-batch of the last run."""
    return [metrics for _, metrics in observed_batches(query)]


def _counts(row) -> dict[str, int]:
    values = row.asDict() if hasattr(row, "asDict") else dict(row)
    return {k: v or 0 for k, v in values.items()}


def observed_totals(query: Run | StreamingQuery, name: str) -> dict[str, int]:
    """Sum of one observed metric set over all micro-batches of the last run."""
    totals: dict[str, int] = {}
    for batch in observed_metrics(query):
        row = batch.get(name)
        if row is None:
            continue
        for k, v in _counts(row).items():
            totals[k] = totals.get(k, 0) + v
    return totals
