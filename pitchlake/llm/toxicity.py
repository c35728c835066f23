"""Toxicity: noisy-channel deobfuscation, then a hashed linear score of the restored text.

A *lattice* of characters is laid over every piece of text that may be disguised: tokens that
mix letters with look-alike signs, letters written twice or more, letters divided by signs, and single
letters set apart by any white space. A Viterbi search under a character trigram model of the whole
corpus picks the most likely reading. Where the only choices of a token are letters written twice and
single signs within it, each choice is first weighed by itself on whole arrays: if none is worth taking
the token is its own most likely reading. Words broken by blanks into parts of two letters or more stay as written.
The restored text is scored with logistic
regression on the presence of words and word beginnings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import tokens
from pitchlake.llm.linear import Ftrl, fit, labelled_sample, sigmoid

CONFIG = Ftrl(bits=20, alpha=0.5, l1=0.3, l2=0.01, epochs=12, shards=1, min_z=5.0)
MAX_TRAIN = 6000
#: Bytes of a word's beginnings that are features beside the whole word.
BEGINNINGS = (4, 5, 6, 7)

# Letters that a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
SEPARATORS = " ._*-~/\\\t\n\r"
# Channel costs, in nats.
COST_LOOKALIKE, COST_DROPPED_SIGN, COST_LITERAL = 0.5, 4.0, 2.5
COST_DROPPED_SEPARATOR, COST_SHORTENED, COST_KEPT_RUN = 0.2, 0.5, 1.5
#: A letter written twice read as one, a single sign between longer parts read as none: common in clean text, so
#: the other reading has to be e**10 times as likely.
COST_HALVED, COST_JOINED = 10.0, 10.0

#: 32 character classes of the language model: 0 boundary or sign, 1-26 letters, 27 non-ASCII byte.
_CLASS = np.zeros(256, np.int64)
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = np.arange(1, 27)
_CLASS[0x80:] = 27
_LETTER = _CLASS > 0
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOKALIKES]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[ord(c) for c in SEPARATORS]] = True


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 15, np.int64)
    for batch in batches:
        for texts in tokens.blocks(batch.column("text")):
            # a boundary between texts
            c = np.insert(_CLASS[texts.data], np.minimum(texts.starts, len(texts.data)), 0)
            if len(c) > 2:
                total += np.bincount((c[:-2] << 10) | (c[1:-1] << 5) | c[2:], minlength=1 << 15)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probabilities [two classes before, class] from the trigram counts of all texts (at most 32,768 numbers)."""
    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_count_trigrams, "gram long, n long")
    counts = rows.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    c = np.zeros(1 << 15)
    c[counts["gram"].to_numpy(np.int64)] = counts["n"].to_numpy(float)
    c = c.reshape(1 << 10, 32) + 0.2
    return np.log(c / c.sum(axis=1, keepdims=True)).astype(np.float32)


def _options(sign: str, run: int, apart: bool = True) -> list[tuple[str, float]]:
    """Readings of ``run`` equal characters, with their costs; ``apart``: a sign with a single letter on both sides."""
    if sign.isalpha() or ord(sign) > 0x7F:
        if run == 1:
            return [(sign, 0.0)]
        if run == 2:
            return [(sign * 2, 0.0), (sign, COST_HALVED)]
        return [(sign, COST_SHORTENED), (sign * 2, COST_SHORTENED), (sign * run, COST_KEPT_RUN)]
    if sign in SEPARATORS and not apart and run == 1:
        return [(sign, 0.0), ("", COST_JOINED)]
    options = [(sign * run, COST_LITERAL)]
    if sign in LOOKALIKES:
        options += [(x * n, COST_LOOKALIKE) for x in LOOKALIKES[sign] for n in range(1, min(run, 2) + 1)]
        options.append(("", COST_DROPPED_SIGN))
    elif sign in SEPARATORS:
        options.append(("", COST_DROPPED_SEPARATOR))
    return options


def _set_apart(piece: str, at: int, run: int) -> bool:
    """Whether the signs at ``at`` stand between single characters (or at an end of the piece)."""
    left = at < 2 or piece[at - 2] in SEPARATORS
    right = at + run + 1 >= len(piece) or piece[at + run + 1] in SEPARATORS
    return left and right


def decode(piece: str, model: np.ndarray) -> str:
    """The most likely reading of a piece (lower-cased) under the channel costs and the character model."""
    piece = piece.lower()
    best: dict[int, tuple[float, str]] = {0: (0.0, "")}
    at = 0
    while at < len(piece):
        run = 1
        while at + run < len(piece) and piece[at + run] == piece[at]:
            run += 1
        options = [
            (text, cost, [int(x) for x in _CLASS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]])
            for text, cost in _options(piece[at], run, _set_apart(piece, at, run))
        ]
        after: dict[int, tuple[float, str]] = {}
        for state, (score, so_far) in best.items():
            for text, cost, classes in options:
                s, value = state, score - cost
                for c in classes:
                    value += float(model[s, c])
                    s = ((s << 5) | c) & 1023
                if s not in after or value > after[s][0]:
                    after[s] = (value, so_far + text)
        best = after
        at += run
    return max((score + float(model[s, 0]), text) for s, (score, text) in best.items())[1]


def _suspects(texts: tokens.Texts, model: np.ndarray) -> list[tuple[int, int, int]]:
    """(begin, end, text) of the pieces that may read otherwise than written."""
    data = texts.data
    begin, end, owner = tokens.runs(texts, tokens.NOT_SPACE)
    if not len(begin):
        return []
    letter, sign, digit = _LETTER[data], _SIGN[data], _DIGIT[data]
    n = len(data)

    def at(flags: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(n, bool)
        if k < n:
            out[: n - k] = flags[k:]
        return out

    def inside(flags: np.ndarray, reach: int) -> np.ndarray:
        total = np.zeros(n + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[np.maximum(end - reach, begin)] > total[begin]

    same = np.zeros(n, bool)
    same[:-1] = data[1:] == data[:-1]
    stretched = letter & same & at(same, 1)
    gap = _SEPARATOR[data]
    some = letter | sign
    apart = some & at(gap, 1) & at(some, 2) & at(gap, 3) & at(some, 4)
    mixed = inside(letter, 0) & (inside(sign & at(letter | (sign & digit), 1), 1) | inside(sign & digit, 0))
    one = (end - begin == 1) & some[begin]
    # a letter written twice, or one sign between letters: is the other reading worth its cost by itself?
    c = np.where(tokens.NOT_SPACE[data], _CLASS[data], 0)
    around = np.concatenate([[0, 0], c, [0, 0, 0]])
    p, q, x, y, z = (around[k : k + n] for k in range(5))
    twice = letter & (x == y) & (x != q) & (y != z) & (x < 27)
    halved = twice & (model[(q << 5) | x, z] - COST_HALVED > model[(q << 5) | x, y] + model[(x << 5) | y, z])
    joint = gap & tokens.NOT_SPACE[data] & (q > 0) & (y > 0)
    kept = model[(p << 5) | q, 0] + model[q << 5, y] + model[y, z]
    joined = joint & (model[(p << 5) | q, y] + model[(q << 5) | y, z] - COST_JOINED > kept)
    close = twice | joint  # choices that share characters are weighed by the search
    near = close & (at(close, 1) | at(close, 2) | at(close, 3))
    odd = mixed | inside(stretched, 2) | (inside(apart, 4) & inside(letter, 0))
    odd |= inside(halved, 0) | inside(joined, 0) | inside(near, 0)
    # three or more single characters in a row form one piece
    pieces = []
    edge = np.flatnonzero(np.diff(np.concatenate([[False], one, [False]]).astype(np.int8)))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        while a < b:
            c = a
            while c < b and owner[c] == owner[a]:
                c += 1
            if c - a >= 3:
                odd[a:c] = False
                pieces.append((int(begin[a]), int(end[c - 1]), int(owner[a])))
            a = c
    pieces += [(int(begin[i]), int(end[i]), int(owner[i])) for i in np.flatnonzero(odd)]
    return sorted(pieces)


def restored(texts: tokens.Texts, model: np.ndarray, known: dict[bytes, bytes]) -> tokens.Texts:
    """The texts with every disguised piece replaced by its reading."""
    pieces = _suspects(texts, model)
    if not pieces:
        return texts
    raw = texts.data.tobytes()
    out, at = [], 0
    longer = np.zeros(len(texts) + 1, np.int64)
    for a, b, of in pieces:
        piece = raw[a:b]
        reading = known.get(piece)
        if reading is None:
            if len(known) > 50_000:
                known.clear()
            reading = decode(piece.decode("utf-8", "replace"), model).encode()
            known[piece] = reading
        out += [raw[at:a], reading]
        at = b
        longer[of + 1] += len(reading) - (b - a)
    out.append(raw[at:])
    return tokens.Texts(texts.first, np.frombuffer(b"".join(out), np.uint8), texts.starts + np.cumsum(longer))


def _buckets(texts: tokens.Texts, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, index of their text) of the words, then of each length of beginnings."""
    begin, end, owner = tokens.runs(texts, tokens.ALNUM_WORD)
    hasher = tokens.Hasher(texts.data, lower=True)
    shift = np.uint64(64 - bits)
    yield (hasher.of(begin, end) >> shift).astype(np.int64), owner
    for size in BEGINNINGS:
        long = end - begin > size
        b = begin[long]
        yield (tokens.mix(hasher.of(b, b + size)) >> shift).astype(np.int64), owner[long]


def _features(column: pa.Array, model, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    known: dict[bytes, bytes] = {}
    for texts in tokens.blocks(column):
        texts = restored(texts, model.value, known)
        bucket, owner = (np.concatenate(x) for x in zip(*_buckets(texts, bits)))
        pairs = np.unique((owner << bits) | bucket)
        cuts = np.searchsorted(pairs >> bits, np.arange(len(texts) + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield pairs[a:b] & ((1 << bits) - 1), np.ones(b - a)


def _score(batches: Iterator[pa.RecordBatch], model, weights, bits: int) -> Iterator[pa.RecordBatch]:
    w = weights.value
    known: dict[bytes, bytes] = {}
    for batch in batches:
        scores = []
        for texts in tokens.blocks(batch.column("text")):
            texts = restored(texts, model.value, known)
            found = []
            for bucket, owner in _buckets(texts, bits):
                told = np.flatnonzero(w[bucket])
                found.append((owner[told] << bits) | bucket[told])
            pairs = np.unique(np.concatenate(found))
            total = np.bincount(pairs >> bits, weights=w[pairs & ((1 << bits) - 1)], minlength=len(texts))
            scores.append(sigmoid(total + w[-1]))
        score = np.concatenate(scores) if scores else np.empty(0)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score)], names=["id", "score"])


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", train=lambda c: F.lit(True), max_train: int = MAX_TRAIN,
                    config: Ftrl = CONFIG) -> DataFrame:
    """(id, score): the probability that the restored whole text is toxic.

    The character model counts all texts; the regression learns from at most ``max_train``
    labelled documents whose id passes ``train``. Both are bounded tables and broadcast.

    Edge cases: null, empty and wordless texts score as the bias alone; null ids are scored
    too; repeated ids each get a row; an empty table gives an empty result and, without labels,
    every score is 0.5. Other columns are not read, so their names cannot clash.
    """
    sc = docs.sparkSession.sparkContext
    model = sc.broadcast(character_model(docs, text_col))
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, train, max_train)
    weights = sc.broadcast(fit(sample, partial(_features, model=model, bits=config.bits), config).astype(np.float32))
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = src.mapInArrow(
        partial(_score, model=model, weights=weights, bits=config.bits), f"id {src.schema['id'].dataType.simpleString()}, score double"
    )
    return scored.select(F.col("id").alias(id_col), "score")
