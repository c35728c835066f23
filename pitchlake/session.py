"""Session helpers: a local session for tests/bench and the shared scratch root.

On a cluster the shared folder for lineage cuts and scratch output is the one
the cluster names in ``spark.checkpoint.dir``; it is only ever *read* here.
A local fallback is created only where that setting is unset (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SCRATCH_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pitchlake",
                  event_log_dir: str | None = None) -> SparkSession:
    """A local session configured the way the library expects (UTC, AQE on, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a hot join partition (e.g. NULL keys) even when that costs a
        # shuffle downstream: paid only when skew is detected at run time
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_FALLBACK: dict[int, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where unset, a fresh local one, on a local master only."""
    root = None
    try:
        root = spark.conf.get(_SCRATCH_KEY, None)
    except Exception:  # noqa: BLE001 - core key not exposed through the SQL conf
        root = None
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session without a SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get(_SCRATCH_KEY, None)
    if not root and sc is not None and not sc.master.startswith("local"):
        raise ValueError(f"set {_SCRATCH_KEY} to a folder that driver and executors share")
    if not root:
        key = id(sc) if sc is not None else id(spark)
        if key not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="pitchlake-scratch-")
            if sc is not None:
                sc.setCheckpointDir(_LOCAL_FALLBACK[key])
        root = _LOCAL_FALLBACK[key]
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, never-used directory path under the scratch root (not created)."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex[:12]}")


#: Most tasks that list the folders of a table or feed. Spark's default starts one task a folder (up to 10,000), whose
#: start costs more than the listing of a folder and whose reports all go to the driver.
LISTING_TASKS = 64
_LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Bytes of listings that Spark keeps in the driver beside those of its tables. It keeps them by reader, so no other reader finds
#: them: a stream leaves one a file behind, until there are 250 MB of them.
_KEPT_KEY = "spark.sql.hive.filesourcePartitionFileCacheSize"


@contextmanager
def _at_most(spark: SparkSession, key: str, most: int) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), most)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by at most LISTING_TASKS tasks, and listings go with their reader, each time a read is set up or a stream runs in here."""
    with _at_most(spark, _LISTING_KEY, LISTING_TASKS), _at_most(spark, _KEPT_KEY, 0):
        yield


def in_few_tasks(df: DataFrame) -> DataFrame:
    """Rows read from many small files, by at most as many tasks as a shuffle has.

    Spark counts 4 MB for each file's opening when it fills a task, so files of a few KB would take a task for every 4 to 32 of
    them, each with a report to the driver and, in a stream, a file of its own in the table written.
    """
    return df.coalesce(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


#: Files on a local file system get no checksum file beside them: creating one costs as much as creating the file itself. For
#: feeds, which come without, and tables of many small files. Other file systems have no use for these settings. As options of a batch
#: write only: a stream takes them from its session, whose state store needs the usual class.
NO_CHECKSUM_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


#: Bytes of the largest method that the JVM compiles. Spark's default keeps the generated code of a stage whole up to 65,535
#: bytes; parsing a delivery and resolving its names take more than 8,000, and would run interpreted, row by row.
METHOD_BYTES = 8000
_METHOD_KEY = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Stages too large for one compiled method run as several, for tables written in here.

    Streams keep Spark's default: their deliveries are parsed and resolved in one stage, which took longer this way.
    """
    with _at_most(spark, _METHOD_KEY, METHOD_BYTES):
        yield


_BROADCAST_KEY = "spark.sql.autoBroadcastJoinThreshold"
_BROADCAST_SEEN_KEY = "spark.sql.adaptive.autoBroadcastJoinThreshold"


@contextmanager
def sized_by_rows(spark: SparkSession) -> Iterator[None]:
    """Joins run in here broadcast a side by the bytes of its rows, known once its stage has run, never by those of its files.

    Rows of line-ups and of groups repeat their names: their files are a thirtieth or less of what they take in the driver.
    """
    before, seen = spark.conf.get(_BROADCAST_KEY), spark.conf.get(_BROADCAST_SEEN_KEY, None)
    spark.conf.set(_BROADCAST_KEY, "-1")
    spark.conf.set(_BROADCAST_SEEN_KEY, seen or before)
    try:
        yield
    finally:
        spark.conf.set(_BROADCAST_KEY, before)
        if seen is None:
            spark.conf.unset(_BROADCAST_SEEN_KEY)
        else:
            spark.conf.set(_BROADCAST_SEEN_KEY, seen)
