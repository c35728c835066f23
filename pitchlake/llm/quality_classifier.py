"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL updates."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import tokens
from pitchlake.llm.linear import Ftrl, fit, labelled_sample, sigmoid

#: Words are runs of letters, digits and non-ASCII bytes; runs of other visible signs are words too.
SIGNS = tokens.NOT_SPACE & ~tokens.ALNUM_WORD

#: Hash of the n-gram "a word, then the same word".
SAME = np.uint64(0xA5A3564E27F8865B)

CONFIG = Ftrl(bits=18, alpha=0.5, l1=0.01, l2=0.01, epochs=6, shards=4)
MAX_TRAIN = 6000
#: Factor on n-gram shares, so that a tenth of a text can decide.
SCALE = 30.0


def hashed_ngrams(texts: tokens.Texts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and pairs of neighbouring words, and the index of their text."""
    parts = [tokens.runs(texts, c) for c in (tokens.ALNUM_WORD, SIGNS)]
    begin, end, owner = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(begin, kind="stable")
    begin, end, owner = begin[order], end[order], owner[order]
    one = tokens.Hasher(texts.data).of(begin, end)
    two, owner_two = tokens.grams(one, owner, 2)
    if len(two):  # a word after itself is one n-gram whatever the word: [X, same as before]
        again = (one[1:] == one[:-1])[owner[1:] == owner[:-1]]
        two[again] = SAME
    shift = np.uint64(64 - bits)
    return np.concatenate([one >> shift, two >> shift]).astype(np.int64), np.concatenate([owner, owner_two])


def _features(column: pa.Array, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text: distinct buckets and their share of the text's n-grams, times SCALE."""
    for texts in tokens.blocks(column):
        bucket, owner = hashed_ngrams(texts, bits)
        pairs, count = np.unique((owner << bits) | bucket, return_counts=True)
        cuts = np.searchsorted(pairs >> bits, np.arange(len(texts) + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield pairs[a:b] & ((1 << bits) - 1), SCALE * count[a:b] / max(1, count[a:b].sum())


def _score(batches: Iterator[pa.RecordBatch], weights, bits: int) -> Iterator[pa.RecordBatch]:
    w = weights.value
    for batch in batches:
        scores = []
        for texts in tokens.blocks(batch.column("text")):
            bucket, owner = hashed_ngrams(texts, bits)
            total = np.bincount(owner, weights=w[bucket], minlength=len(texts))
            n = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
            scores.append(sigmoid(SCALE * total / n + w[-1]))
        score = np.concatenate(scores) if scores else np.empty(0)
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=[*batch.schema.names[:-1], "score"])


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", train=lambda c: F.lit(True), max_train: int = MAX_TRAIN,
                  config: Ftrl = CONFIG) -> np.ndarray:
    """Weights from at most ``max_train`` labelled documents whose id passes ``train`` (1: good)."""
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, train, max_train)
    return fit(sample, partial(_features, bits=config.bits), config)


def score_quality(docs: DataFrame, weights: np.ndarray, text_col: str = "text", score_col: str = "score",
                  config: Ftrl = CONFIG) -> DataFrame:
    """All rows and columns of ``docs`` but the text, and the score of the whole text (0 to 1).

    The score is a sparse dot product of n-gram shares and weights; the weights (2**bits numbers)
    are broadcast. Null and empty texts score as the bias alone. A column that is already named
    ``score_col`` is replaced; other columns pass through.
    """
    return _scored(docs, weights, text_col, score_col, config, keep_text=False)


def with_quality(docs: DataFrame, weights: np.ndarray, text_col: str = "text", score_col: str = "score",
                 config: Ftrl = CONFIG) -> DataFrame:
    """As ``score_quality``, with the text kept."""
    return _scored(docs, weights, text_col, score_col, config, keep_text=True)


def _scored(docs: DataFrame, weights: np.ndarray, text_col: str, score_col: str, config: Ftrl, keep_text: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    kept = [c for c in docs.columns if c != score_col and (keep_text or c != text_col)]
    # positional names inside, so no input column can clash with the operator's own
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = ", ".join([f"c{i} {inner.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(kept))] + ["score double"])
    out = inner.mapInArrow(partial(_score, weights=shared, bits=config.bits), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], F.col("score").alias(score_col))
