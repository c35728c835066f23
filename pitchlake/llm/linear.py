"""Sparse logistic regression trained with follow-the-regularised-leader (proximal) updates.

Training takes a bounded sample: its examples are dealt to a fixed number of shards by a
hash of their key, each shard runs the updates over its examples in key order, and the
shards' weights are averaged by feature in Spark. A lost executor costs one shard again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.scratch import text_batches


@dataclass(frozen=True)
class Ftrl:
    """Settings of the learner: feature space, step sizes, penalties, passes over the shard."""

    bits: int = 18
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01
    epochs: int = 8
    shards: int = 4
    #: Only features are learned whose examples carry label 1 by so many standard deviations more often than all.
    min_z: float | None = None


def train_examples(examples: list[tuple[np.ndarray, np.ndarray, int]], cfg: Ftrl) -> np.ndarray:
    """Weights (the last is the bias) after FTRL-proximal updates over (indices, values, label)."""
    size = (1 << cfg.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    bias = np.array([size - 1])
    if cfg.min_z is not None and examples:
        rate = sum(y for _, _, y in examples) / len(examples)
        df, pos = (np.bincount(np.concatenate([i for i, _, y in examples if y >= least] or [bias[:0]]), minlength=size) for least in (0, 1))
        told = pos - df * rate >= cfg.min_z * np.sqrt(df * rate * (1 - rate) + 1e-9)
        told &= df > 0
        examples = [(i[told[i]], v[told[i]], y) for i, v, y in examples]
    examples = [(np.append(i, bias), np.append(v, 1.0), y) for i, v, y in examples]

    def weights(idx: np.ndarray) -> np.ndarray:
        zi = z[idx]
        l1 = np.where(idx == size - 1, 0.0, cfg.l1)
        w = -(zi - np.sign(zi) * l1) / ((cfg.beta + np.sqrt(n[idx])) / cfg.alpha + cfg.l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(cfg.epochs):
        for idx, val, y in examples:
            w = weights(idx)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ val, -30, 30)))
            g = (p - y) * val
            sigma = (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / cfg.alpha
            z[idx] += g - sigma * w
            n[idx] += g * g
    return weights(np.arange(size))


def _train_shard(pdf: pd.DataFrame, cfg: Ftrl) -> pd.DataFrame:
    pdf = pdf.sort_values("key", kind="stable")
    # features come packed: 4-byte indices, 4-byte values
    w = train_examples(
        [(np.frombuffer(i, np.int32).astype(np.int64), np.frombuffer(v, np.float32).astype(np.float64), int(y))
         for i, v, y in zip(pdf["idx"], pdf["val"], pdf["label"])],
        cfg,
    )
    at = np.flatnonzero(w)
    return pd.DataFrame({"feature": at.astype(np.int64), "weight": w[at]})


def _featurise(batches: Iterator[pa.RecordBatch], features: Callable) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        idx, val = [], []
        for i, v in features(batch.column("text")):
            idx.append(np.asarray(i, np.int32).tobytes())
            val.append(np.asarray(v, np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("label"), pa.array(idx, pa.binary()), pa.array(val, pa.binary())],
            names=["key", "label", "idx", "val"],
        )


def fit(examples: DataFrame, features: Callable, cfg: Ftrl) -> np.ndarray:
    """Average weights of the shards over (key, label, text) examples.

    ``features(text column)`` yields (indices, values) a text. The driver receives at most one
    number a feature, 2**bits + 1 in all. Without examples every weight is 0.
    """
    rows = examples.select(F.xxhash64(F.col("key").cast("string")).alias("key"), F.col("label").cast("int").alias("label"), "text")
    packed = rows.mapInArrow(partial(_featurise, features=features), "key long, label int, idx binary, val binary")
    trained = (
        packed.withColumn("shard", F.pmod("key", F.lit(cfg.shards)))
        .groupBy("shard")
        .applyInPandas(lambda pdf: _train_shard(pdf, cfg), "feature long, weight double")
    )
    with text_batches(examples.sparkSession):
        mean = trained.groupBy("feature").agg((F.sum("weight") / cfg.shards).alias("weight")).orderBy("feature").toPandas()
    w = np.zeros((1 << cfg.bits) + 1)
    w[mean["feature"].to_numpy(np.int64)] = mean["weight"].to_numpy(float)
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    train: Callable, limit: int) -> DataFrame:
    """(key, label, text) of at most ``limit`` labelled rows whose id passes ``train``.

    The sample is the rows of smallest id hash, so it does not depend on partitions; only its
    ids and labels are broadcast (``limit`` rows). Ids with several labels count as the
    smallest one; null ids and labels are left out.
    """
    ids = (
        labels.select(F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("key").isNotNull() & F.col("label").isNotNull() & train(F.col("key")))
        .groupBy("key").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64(F.col("key").cast("string")), "key").limit(limit)
    )
    src = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    return src.join(F.broadcast(ids), "key")


def crc_mod(id_col, mod: int):
    """crc32 of the id as text, modulo ``mod``."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(mod))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))
