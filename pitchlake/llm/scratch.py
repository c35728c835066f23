"""Lineage cuts and size-checked joins shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.session import fresh_dir

#: A side of at most this many narrow rows (a few ids or numbers each) may be broadcast.
BROADCAST_ROWS = 400_000

#: Whole texts that go to a Python worker at once; Spark's 10,000 lie in the executor's memory several times over.
TEXT_ROWS = 1000
_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


#: Bytes that go to a Python worker at once where rows may be whole texts or narrow; Spark's 64 MB bind few batches.
BATCH_BYTES = 1 << 21
_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def byte_batches(spark: SparkSession) -> Iterator[None]:
    """What runs in here hands rows to Python at most about BATCH_BYTES at a time; the results are the same."""
    before = spark.conf.get(_BYTES_KEY)
    spark.conf.set(_BYTES_KEY, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BYTES_KEY, before)


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """What runs in here hands rows to Python at most TEXT_ROWS at a time; the results are the same."""
    before = spark.conf.get(_ROWS_KEY)
    rows = int(before)
    spark.conf.set(_ROWS_KEY, str(min(rows, TEXT_ROWS) if rows > 0 else TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_ROWS_KEY, before)


def cut(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: an executor lost later costs no recomputation.

    ``codec`` compresses the files otherwise than the session does.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, f"llm-{label}")
    schema = df.schema
    df.write.parquet(path, compression=codec)
    return spark.read.schema(schema).parquet(path)


def join_counted(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a written narrow table: broadcast if its counted rows are within the bound, else shuffle both sides.

    ``small`` must be the result of ``cut``, so that counting reads parquet footers only.
    """
    small = F.broadcast(small) if small.count() <= rows else small.hint("merge")
    return big.join(small, on, how)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
