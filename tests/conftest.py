import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pitchlake.session import local_session

    session = local_session("*", shuffle_partitions=8, app="pitchlake-tests")
    yield session
    session.stop()


def one_col(spark, values, name="c", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")


def evaluate(spark, expr_fn, rows, schema):
    """Applies a Column expression to hand-written rows, returns the values in row order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema).withColumn("_i", F.monotonically_increasing_id())
    return [r[0] for r in df.select(expr_fn(), "_i").orderBy("_i").collect()]
