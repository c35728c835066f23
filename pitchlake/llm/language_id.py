"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.scratch import cut

#: Buckets of the n-gram hash, as a power of two.
BITS = 16
#: Lengths of the character n-grams.
SIZES = (1, 2, 3)
MAX_TRAIN = 4000
UNKNOWN = "und"
#: N-grams scored at once, and characters of texts handled together (a longer text is handled alone).
CHUNK = 1 << 17

_MUL = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)


@dataclass(frozen=True)
class Model:
    """Log probabilities [bucket, language] of the n-grams, and of the languages."""

    languages: list[str]
    ngram: np.ndarray
    prior: np.ndarray


@cache
def _letters() -> np.ndarray:
    """Which code points are letters; made once in a worker."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _groups(column: pa.Array) -> Iterator[list[str]]:
    """The texts in runs of at most about CHUNK characters; null counts as empty."""
    group, size = [], 0
    for text in column.to_pylist():
        text = text or ""
        if group and size + len(text) > CHUNK:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def ngram_buckets(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, index of their text, ascending) of all character n-grams of the lower-cased texts.

    Each text has a space before and after it, and a run of signs that are no letters counts as one space; a text
    without letters has no n-grams. No n-gram reaches over two texts.
    """
    lower = [t.lower() for t in texts]
    codes = np.frombuffer("".join(f" {t} " for t in lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(lower)), [len(t) + 2 for t in lower])
    inside = _letters()[codes]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    keep[first] = np.bincount(owner, weights=inside, minlength=len(lower)) > 0
    codes, owner = np.where(inside, codes, 32)[keep].astype(np.uint64), owner[keep]
    found, of = [], []
    for n in SIZES:
        m = max(0, len(codes) - n + 1)
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = (h ^ codes[k : k + m]) * _MUL[k]
            h ^= h >> np.uint64(29)
        h *= np.uint64(0x9FB21C651E98DF25)
        whole = owner[:m] == owner[n - 1 : n - 1 + m]
        found.append((h >> np.uint64(64 - bits)).astype(np.int64)[whole])
        of.append(owner[:m][whole])
    if len(lower) == 1:
        return np.concatenate(found), np.concatenate(of)
    owner = np.concatenate(of)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], owner[order]


def _counts(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """(language, bucket, n) of the training texts of a task; bucket -1 counts the texts."""
    total: dict[str, np.ndarray] = {}
    texts: dict[str, int] = {}
    for batch in batches:
        labels, at = batch.column("label").to_pylist(), 0
        for group in _groups(batch.column("text")):
            mine = labels[at : at + len(group)]
            at += len(group)
            buckets, owner = ngram_buckets(group, bits)
            names = sorted(set(mine))
            code = np.array([names.index(x) for x in mine])[owner]
            for k, lang in enumerate(names):
                n = np.bincount(buckets[code == k], minlength=1 << bits)
                total[lang] = total[lang] + n if lang in total else n
                texts[lang] = texts.get(lang, 0) + mine.count(lang)
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(at) + 1)), pa.array(np.append(at, -1)), pa.array(np.append(n[at], texts[lang]))],
            names=["label", "bucket", "n"],
        )


def train_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   train=lambda c: F.lit(True), max_train: int = MAX_TRAIN, bits: int = BITS) -> Model:
    """Model from at most ``max_train`` documents of each language (smallest id hash) whose id passes ``train``.

    Rows are counted by language first; a cut of the id hash then leaves a few more than ``max_train`` of each,
    of which a window takes the smallest, so that no language is sorted whole. The driver receives one number a
    language, then one a bucket and language.

    Edge cases: rows whose id, language or text is null are not learned from; an empty table gives a model
    without languages; other columns are not read.
    """
    src = docs.select(F.col(id_col).alias("key"), F.col(lang_col).alias("label")).where(
        F.col("key").isNotNull() & F.col("label").isNotNull() & F.col(text_col).isNotNull() & train(F.col("key"))
    )
    sizes = cut(src.groupBy("label").agg(F.count(F.lit(1)).alias("size")), "languages")
    langs = [r[0] for r in sizes.select("label").orderBy("label").collect()]
    if not langs:
        return Model([], np.zeros((1 << bits, 0), np.float32), np.zeros(0))
    # six standard deviations above max_train, as a share of the range of the hash
    slack = max_train + 6 * max_train**0.5 + 10
    hashed = F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(1 << 40))
    low = src.join(F.broadcast(sizes), "label").withColumn("h", hashed).where(
        F.col("h").cast("double") * F.col("size") <= F.lit(float(slack * (1 << 40)))
    )
    order = Window.partitionBy("label").orderBy("h", "key")
    chosen = low.withColumn("place", F.row_number().over(order)).where(F.col("place") <= max_train).select("key", "label")
    texts = docs.select(F.col(id_col).alias("key"), F.col(lang_col).alias("label"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen.distinct()), ["key", "label"]).select("label", "text")
    counts = sample.mapInArrow(partial(_counts, bits=bits), "label string, bucket long, n long")
    got = counts.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros((1 << bits, len(langs)))
    prior = np.ones(len(langs))
    for i, lang in enumerate(langs):
        mine = got[got["label"] == lang]
        grams = mine[mine["bucket"] >= 0]
        n[grams["bucket"].to_numpy(np.int64), i] = grams["n"].to_numpy(float)
        prior[i] += mine.loc[mine["bucket"] < 0, "n"].sum()
    n += 0.1
    return Model(langs, np.log(n / n.sum(axis=0)).astype(np.float32), np.log(prior / prior.sum()))


def _log_likelihoods(model: Model, buckets: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """[text, language]: the rows of the matrix that a text's n-grams pick, added up; ``owner`` ascends."""
    total = np.tile(model.prior, (n_texts, 1))
    for at in range(0, len(buckets), CHUNK):
        of = owner[at : at + CHUNK]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        total[of[first]] += np.add.reduceat(model.ngram[buckets[at : at + CHUNK]], first, axis=0, dtype=np.float64)
    return total


def _predict(batches: Iterator[pa.RecordBatch], shared, bits: int) -> Iterator[pa.RecordBatch]:
    model = shared.value
    names = np.array([*model.languages, UNKNOWN], object)
    for batch in batches:
        found, scores = [], []
        for texts in _groups(batch.column("text")):
            best, score = np.full(len(texts), len(model.languages)), np.zeros(len(texts))
            if model.languages:
                buckets, owner = ngram_buckets(texts, bits)
                told = np.bincount(owner, minlength=len(texts)) > 0
                total = _log_likelihoods(model, buckets, owner, len(texts))[told]
                best[told] = total.argmax(axis=1)
                score[told] = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            found += names[best].tolist()
            scores.append(score)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(found, pa.string()), pa.array(np.concatenate(scores) if scores else np.empty(0))],
            names=["id", "lang_pred", "score"],
        )


def predict_language(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(id, lang_pred, score): the likeliest language of each whole text and its posterior probability.

    The log probability matrix (2**bits rows, one column a learned language) is broadcast, and a
    text's n-grams pick and add its rows. Null texts and texts without a letter give ``und``
    with score 0, as does a model without languages. Equal probabilities go to the language
    first in alphabetical order. Null and repeated ids are kept; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = src.mapInArrow(partial(_predict, shared=shared, bits=bits),
                         f"id {src.schema['id'].dataType.simpleString()}, lang_pred string, score double")
    return out.select(F.col("id").alias(id_col), "lang_pred", "score")
