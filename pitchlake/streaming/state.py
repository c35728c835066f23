"""What a stream keeps between its runs, read from its checkpoint by Spark's state data source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def held_keys(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """One row a key that a stateful operator of a stopped stream holds, with the key's columns."""
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return state.select("key.*")


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operatorId, operatorName, stateStoreName, numPartitions, minBatchId, maxBatchId) of a stream's stateful operators."""
    return spark.read.format("state-metadata").load(checkpoint)
