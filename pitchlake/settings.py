"""Run parameters read from the Spark conf, with defaults.

    pitchlake.source_path   root of the feeds (<root>/matchid=<n>/<file>)
    pitchlake.lake_root     root of the bronze/silver/gold tables and checkpoints
    pitchlake.run_id        value written to ``Batchid`` (default "default")
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from pitchlake import constants as K


@dataclass(frozen=True)
class RunSettings:
    source_path: str
    lake_root: str
    run_id: str = K.DEFAULT_RUN_ID


def from_conf(spark: SparkSession, source_path: str | None = None, lake_root: str | None = None,
              run_id: str | None = None) -> RunSettings:
    """Explicit arguments win over the conf; the conf wins over the defaults."""
    conf = spark.conf
    src = source_path or conf.get("pitchlake.source_path", None)
    lake = lake_root or conf.get("pitchlake.lake_root", None)
    if not src or not lake:
        raise ValueError("source_path and lake_root are required (arguments or pitchlake.* conf)")
    return RunSettings(src, lake, run_id or conf.get("pitchlake.run_id", K.DEFAULT_RUN_ID))
