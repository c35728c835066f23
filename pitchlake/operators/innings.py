"""Running innings score and wickets (gold match events).

The running sums are a ROWS window per innings, ordered by over and ball
number with two tie-breaks so the order is total. An innings is at most a few
hundred deliveries, so the window partitions are small by nature.

Dirty keys (for example a NULL matchid or team shared by many deliveries)
would pile up in a single window partition. ``chunk_rows`` cuts the
deliveries, in the order of innings and ball, into ranges of about that many
rows, so a key of any size is spread over as many ranges as it needs: running sums are computed
per innings and range, range totals are prefix-summed per innings (one
row per range), and the offsets are joined back. The result is identical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake import constants as K
from pitchlake.session import compiled, fresh_dir

INNINGS_KEYS = ("matchid", "team", "super_over_team")
ORDER = ("over", "match_ball_number", "over_ball_number", "event")


def _wicket(method: Column) -> Column:
    return F.when(method != K.NOT_OUT, F.lit(1)).otherwise(F.lit(0))


def innings_progress(events: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Adds ``innings_score`` and ``wickets_lost`` running totals to each delivery.

    With ``chunk_rows`` no window partition holds more than about that many rows, at the cost of
    writing the deliveries, then their ranges, to the scratch folder.
    """
    if chunk_rows:
        return _chunked(events, chunk_rows)
    w = (Window.partitionBy(*INNINGS_KEYS).orderBy(*ORDER)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return events.withColumns({
        "innings_score": F.sum("runs").over(w),
        "wickets_lost": F.sum(_wicket(F.col("dismissal_method"))).over(w),
    })


def chunks(events: DataFrame, chunk_rows: int) -> DataFrame:
    """``events`` with ``_chunk``, the number of a range of about ``chunk_rows`` rows in (innings, ball) order.

    The rows are written before they are counted and sampled for the ranges, so what makes them runs once, and the
    ranges are written too, so each row keeps its number whatever is recomputed later.
    """
    spark = events.sparkSession
    rows, path = fresh_dir(spark, "innings-rows"), fresh_dir(spark, "innings-chunks")
    with compiled(spark):
        events.withColumn("_tie", F.monotonically_increasing_id()).write.parquet(rows)
    tied = spark.read.parquet(rows)
    n = max(1, -(-tied.count() // chunk_rows))  # from the files' footers
    ranged = tied.repartitionByRange(n, *INNINGS_KEYS, *ORDER, "_tie").withColumn("_chunk", F.spark_partition_id())
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def _chunked(events: DataFrame, chunk_rows: int) -> DataFrame:
    # Struct keys compare and hash NULL fields as equal values, so NULL innings
    # keys join back to their own offsets.
    df = chunks(events, chunk_rows).withColumns({
        "_innings": F.struct(*INNINGS_KEYS),
        "_w": _wicket(F.col("dismissal_method")),
    })
    local_w = (Window.partitionBy("_innings", "_chunk").orderBy(*ORDER, "_tie")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = df.withColumns({
        "_runs_in_chunk": F.sum("runs").over(local_w),
        "_wkts_in_chunk": F.sum("_w").over(local_w),
    })
    # Chunk totals: a partial aggregate that reads only the key and measure
    # columns; the prefix sums then run over one row per chunk.
    totals = df.groupBy("_innings", "_chunk").agg(
        F.sum("runs").alias("_chunk_runs"), F.sum("_w").alias("_chunk_wkts"))
    before = (Window.partitionBy("_innings").orderBy("_chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        "_innings", "_chunk",
        F.sum("_chunk_runs").over(before).alias("_runs_before"),
        F.sum("_chunk_wkts").over(before).alias("_wkts_before"),
    )
    joined = local.join(offsets, on=["_innings", "_chunk"], how="inner")

    def plus(prefix: str, within: str) -> Column:
        # sum() skips NULL runs, so a chunk of only NULLs has a NULL total.
        return F.when(F.col(within).isNull() & F.col(prefix).isNull(), F.lit(None)).otherwise(
            F.coalesce(F.col(prefix), F.lit(0)) + F.coalesce(F.col(within), F.lit(0)))

    return joined.withColumns({
        "innings_score": plus("_runs_before", "_runs_in_chunk"),
        "wickets_lost": plus("_wkts_before", "_wkts_in_chunk"),
    }).drop("_innings", "_chunk", "_tie", "_w", "_runs_in_chunk", "_wkts_in_chunk", "_runs_before", "_wkts_before")


def gold_events(silver_events: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    cols = [
        "Batchid", "matchid", "event", "ball", "over", "over_ball_number", "match_ball_number",
        "runs", "innings_score", "wickets_lost", "commentary", "bowler", "batsman", "team",
        "is_super_over", "super_over_team", "runs_text", "Extras", "dismissal_method",
        "dismissed_by", "source_file", "load_timestamp", "silver_load_timestamp",
    ]
    return innings_progress(silver_events, chunk_rows).select(
        *cols, F.current_timestamp().alias("gold_load_timestamp"))
