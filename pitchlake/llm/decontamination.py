"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. Training texts stream through it
word by word; after each word it knows the longest run of words ending there that some item
contains, and from its state which items contain it.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import tokens
from pitchlake.llm.scratch import cut

#: Words of items that one automaton may hold; larger benchmarks are dealt to several, used one after another.
#: While one is built the driver holds about 600 bytes a word; what is broadcast takes under 100 bytes a word.
MAX_WORDS = 500_000


class _Builder:
    """States while items are added, as parallel lists; state 0 is the root."""

    def __init__(self) -> None:
        self.go: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]

    def add_item(self, words: list[int]) -> None:
        """Extend the automaton by one item."""
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _new(self, size: int) -> int:
        self.go.append({})
        self.link.append(-1)
        self.size.append(size)
        return len(self.go) - 1

    def _clone(self, state: int, size: int) -> int:
        twin = self._new(size)
        self.go[twin] = dict(self.go[state])
        self.link[twin] = self.link[state]
        return twin

    def _repoint(self, state: int, w: int, old: int, new: int) -> None:
        while state != -1 and self.go[state].get(w) == old:
            self.go[state][w] = new
            state = self.link[state]

    def _extend(self, last: int, w: int) -> int:
        known = self.go[last].get(w)
        if known is not None:  # an earlier item went this way
            if self.size[known] == self.size[last] + 1:
                return known
            twin = self._clone(known, self.size[last] + 1)
            self._repoint(last, w, known, twin)
            self.link[known] = twin
            return twin
        cur = self._new(self.size[last] + 1)
        state = last
        while state != -1 and w not in self.go[state]:
            self.go[state][w] = cur
            state = self.link[state]
        if state == -1:
            self.link[cur] = 0
            return cur
        after = self.go[state][w]
        if self.size[after] == self.size[state] + 1:
            self.link[cur] = after
            return cur
        twin = self._clone(after, self.size[state] + 1)
        self._repoint(state, w, after, twin)
        self.link[after] = self.link[cur] = twin
        return cur


@dataclass
class Automaton:
    """A finished automaton as flat, sorted arrays; word numbers index ``vocabulary``."""

    vocabulary: np.ndarray
    #: state * words + word of every transition, ascending, and the states they lead to.
    moves: np.ndarray
    to: np.ndarray
    link: np.ndarray
    size: np.ndarray
    #: Lengths of windows, descending: the window, and those of whole items that are shorter.
    lengths: list[int]
    #: state * longest window + length - 1 of the strings that are windows, ascending; the items of the
    #: k-th are ``owners[first[k]:first[k + 1]]``, numbers in ``names``.
    windows: np.ndarray
    first: np.ndarray
    owners: np.ndarray
    names: list[str]

    def step(self, state: int, length: int, w: int) -> tuple[int, int]:
        """State and longest match length after one more word."""
        n, moves = len(self.vocabulary), self.moves
        while True:
            key = state * n + w
            at = bisect_left(moves, key)
            if at < len(moves) and moves[at] == key:
                return int(self.to[at]), length + 1
            if not state:
                return 0, 0
            state = int(self.link[state])
            length = int(self.size[state])

    def at_length(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of a match that ends in ``state``."""
        while (up := int(self.link[state])) >= 0 and self.size[up] >= length:
            state = up
        return state

    def owners_at(self, state: int, length: int) -> list[str]:
        """Items with the window that is the last ``length`` words of a match that ends in ``state``."""
        key = self.at_length(state, length) * self.lengths[0] + length - 1
        at = bisect_left(self.windows, key)
        if at == len(self.windows) or self.windows[at] != key:
            return []
        return [self.names[i] for i in self.owners[self.first[at] : self.first[at + 1]]]


def _flat(made: _Builder, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = max(1, len(vocabulary))
    counts = np.fromiter(map(len, made.go), np.int64, len(made.go))
    words = np.fromiter((w for g in made.go for w in g), np.int64, counts.sum())
    to = np.fromiter((t for g in made.go for t in g.values()), np.int32, counts.sum())
    moves = np.repeat(np.arange(len(made.go)), counts) * n + words
    order = np.argsort(moves, kind="stable")
    return moves[order], to[order]


def build(items: list[tuple[str, list[int]]], window: int, vocabulary: np.ndarray) -> Automaton:
    """Automaton of (item id, word hashes) with the items of every window; hashes must be in ``vocabulary``."""
    made = _Builder()
    numbered = [(i, np.searchsorted(vocabulary, np.array(w, np.uint64)).tolist()) for i, w in items if w]
    for _, words in numbered:
        made.add_item(words)
    lengths = sorted({min(window, len(words)) for _, words in numbered}, reverse=True)
    none = np.empty(0, np.int64)
    sam = Automaton(vocabulary, *_flat(made, vocabulary), np.array(made.link, np.int32), np.array(made.size, np.int32),
                    lengths, none, none, none, [])
    del made
    number: dict[str, int] = {}
    found = array("q"), array("q")
    for item, words in numbered:
        m = min(window, len(words))
        state = length = 0
        for w in words:
            state, length = sam.step(state, length, w)
            if length >= m:
                found[0].append(sam.at_length(state, m) * lengths[0] + m - 1)
                found[1].append(number.setdefault(item, len(number)))
    pairs = np.unique(np.stack([np.array(x, np.int64) for x in found], axis=1), axis=0)
    sam.windows, first = np.unique(pairs[:, 0], return_index=True)
    sam.first = np.append(first, len(pairs))
    sam.owners = pairs[:, 1]
    sam.names = list(number)
    return sam


def matches(sam: Automaton, h: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]], set]]:
    """Per text with a hit: (text, merged spans of hit words [a, b), items). Word numbers count within the block.

    Only runs of at least the shortest window of words that items have are streamed;
    a match cannot contain any other word.
    """
    if not len(h) or not sam.lengths:
        return
    at = np.searchsorted(sam.vocabulary, h)
    at[at == len(sam.vocabulary)] = 0
    known = sam.vocabulary[at] == h
    breaks = np.ones(len(h), bool)
    breaks[1:] = owner[1:] != owner[:-1]
    begin = np.flatnonzero(known & (breaks | ~np.concatenate([[False], known[:-1]])))
    stop = np.flatnonzero(known & (np.concatenate([breaks[1:], [True]]) | ~np.concatenate([known[1:], [False]]))) + 1
    least = sam.lengths[-1]
    long = stop - begin >= least
    begin, stop = begin[long], stop[long]
    text, spans, items = -1, [], set()
    for a, b, of in zip(begin.tolist(), stop.tolist(), owner[begin].tolist()):
        if of != text:
            if spans:
                yield text, spans, items
            text, spans, items = of, [], set()
        state = length = 0
        for i, w in enumerate(at[a:b].tolist(), a):
            state, length = sam.step(state, length, w)
            if length >= least:
                hit = 0
                for m in sam.lengths:
                    if length >= m and (found := sam.owners_at(state, m)):
                        hit = max(hit, m)
                        items.update(found)
                if hit:
                    if spans and i + 1 - hit <= spans[-1][1]:
                        # a longer window may reach back over earlier spans
                        start = i + 1 - hit
                        while spans and spans[-1][1] >= start:
                            start = min(start, spans.pop()[0])
                        spans.append((start, i + 1))
                    else:
                        spans.append((i + 1 - hit, i + 1))
    if spans:
        yield text, spans, items


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = []
        for texts in tokens.blocks(batch.column("text")):
            h, owner = tokens.words(texts, tokens.ALNUM_WORD, lower=True)
            cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
            words += [h[a:b].view(np.int64) for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(words, pa.list_(pa.int64()))], names=["item", "words"])


_HITS = "n_words long, spans array<long>, places array<long>, items array<string>"


def _stream(batches: Iterator[pa.RecordBatch], shared, text: str) -> Iterator[pa.RecordBatch]:
    """Adds n_words, the spans of hit words (numbers of words, then bytes) and the items to each row.

    Finds of an earlier automaton, if the rows have them, are merged in. ``text``: "drop" it, "keep" it, or "cut" the spans out.
    """
    sam = shared.value
    for batch in batches:
        n_words, spans, places, items = [], [], [], []
        for texts in tokens.blocks(batch.column("text")):
            begin, end, owner = tokens.runs(texts, tokens.ALNUM_WORD)
            h = tokens.Hasher(texts.data, lower=True).of(begin, end)
            counts = np.bincount(owner, minlength=len(texts))
            first = np.concatenate([[0], np.cumsum(counts)])
            base = len(n_words)
            n_words += counts.tolist()
            spans += [[]] * len(texts)
            places += [[]] * len(texts)
            items += [[]] * len(texts)
            for of, found, who in matches(sam, h, owner):
                spans[base + of] = [x - int(first[of]) for s in found for x in s]
                start = int(texts.starts[of])
                places[base + of] = [x for a, b in found for x in (int(begin[a]) - start, int(end[b - 1]) - start)]
                items[base + of] = sorted(who)
        if "items" in batch.schema.names:
            before = [batch.column(c).to_pylist() for c in ("spans", "places", "items")]
            spans = [_merge(x, y) for x, y in zip(before[0], spans)]
            places = [_merge(x, y) for x, y in zip(before[1], places)]
            items = [sorted({*x, *y}) for x, y in zip(before[2], items)]
        columns = {"id": batch.column("id")}
        if text != "drop":
            columns["text"] = batch.column("text")
        if text == "cut" and any(places):
            whole = columns["text"].to_pylist()
            columns["text"] = pa.array([_without(t, p) if p else t for t, p in zip(whole, places)], pa.string())
        longs = pa.list_(pa.int64())
        columns |= {
            "n_words": pa.array(n_words, pa.int64()), "spans": pa.array(spans, longs),
            "places": pa.array(places, longs), "items": pa.array(items, pa.list_(pa.string())),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _blocks(items: DataFrame, item_col: str, text_col: str, max_words: int) -> tuple[DataFrame, int]:
    """Written (item, words, block) rows and the number of blocks, each of at most about ``max_words`` words."""
    src = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    words = cut(src.where("item is not null").mapInArrow(_item_words, "item string, words array<long>"), "items")
    total = words.agg(F.sum(F.size("words"))).first()[0] or 0
    n = max(1, -(-total // max_words))
    return words.where(F.size("words") > 0).withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n))), n


def _automaton(words: DataFrame, block: int, window: int) -> Automaton:
    rows = words.where(F.col("block") == block).orderBy("item").collect()
    coded = [(r[0], np.array(r[1], np.int64).view(np.uint64)) for r in rows]
    vocabulary = np.unique(np.concatenate([w for _, w in coded])) if coded else np.empty(0, np.uint64)
    return build([(i, w.tolist()) for i, w in coded], window, vocabulary)


def _merge(one: list[int], two: list[int]) -> list[int]:
    """Union of two flat lists of [a, b) pairs; pairs that touch are joined."""
    pairs = sorted((s[i], s[i + 1]) for s in (one, two) for i in range(0, len(s), 2))
    out: list[int] = []
    for a, b in pairs:
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _hits(src: DataFrame, items: DataFrame, item_col: str, item_text_col: str, window: int, max_words: int, text: str) -> DataFrame:
    """Rows (id, text) through one automaton after another; ``text`` as in ``_stream``.

    An automaton is built, broadcast, used and let go before the next block is read, so that the driver and the
    workers hold one at a time, whatever the size of the benchmark.
    """
    sc = src.sparkSession.sparkContext
    words, blocks = _blocks(items, item_col, item_text_col, max_words)
    fields = {f.name: f.dataType.simpleString() for f in src.schema.fields}
    rows = src
    for k in range(blocks):
        last = k == blocks - 1
        way = text if last else "keep"
        schema = ", ".join([f"id {fields['id']}"] + ["text string"] * (way != "drop") + [_HITS])
        shared = sc.broadcast(_automaton(words, k, window))
        rows = rows.mapInArrow(partial(_stream, shared=shared, text=way), schema)
        if not last:
            rows = cut(rows, "hits")
            shared.destroy()
    return rows


def benchmark_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", window: int = 13,
                   max_words: int = MAX_WORDS) -> DataFrame:
    """(id, n_words, spans, places, items) a row of ``docs``.

    ``spans`` lists the hit words as flat, sorted, disjoint [first, after) word numbers, ``places``
    the same spans as UTF-8 byte offsets, ``items`` the ids (as text) with an occurring window. A
    window is ``window`` consecutive words of an item; an item of fewer words, but not
    none, is one window.

    The items are collected to build the automaton, one block of about ``max_words`` words at a time; with
    several blocks the rows pass through one automaton after another, and no window is lost. An item is never
    split, so one of more words makes a larger block.

    Edge cases: null texts have no words; null item ids are left out, repeated item ids count
    once; an empty benchmark hits nothing; null and repeated document ids keep their rows; an
    empty table gives an empty result. Other columns are not read.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return _hits(src, items, item_col, item_text_col, window, max_words, "drop").withColumnRenamed("id", id_col)


def with_verdict(hits: DataFrame, share: int = 20) -> DataFrame:
    """Adds n_hit and contaminated: hit words make up at least one in ``share`` of the words."""
    ends = F.filter("spans", lambda x, i: i % 2 == 1)
    starts = F.filter("spans", lambda x, i: i % 2 == 0)
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda t, x: t + x)
    n_hit = (total(ends) - total(starts)).cast("long")
    return hits.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))
    )


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 13, share: int = 20, max_words: int = MAX_WORDS) -> DataFrame:
    """The rows and columns of ``docs`` without contaminated texts, and without the hit spans of the others.

    A text whose hit words make up at least one in ``share`` goes; from a text below that limit only
    the hit spans (each at least a window long) are cut out, the rest stays as it is, byte for
    byte. Rows without a hit, null texts among them, stay unchanged. The other columns travel
    with their text through the same pass, whatever their names, so nothing is joined back.
    """
    order = docs.columns
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(order) if c != text_col]
    src = docs.select(F.struct(F.lit(0).alias("row"), *others).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kept = with_verdict(_hits(src, items, item_col, item_text_col, window, max_words, "cut"), share).where("not contaminated")
    return kept.select(*[(F.col("text") if c == text_col else F.col(f"id.c{i}")).alias(c) for i, c in enumerate(order)])


def _without(text: str, places: list[int]) -> str:
    """The text without the byte ranges [a, b) of ``places``."""
    raw = text.encode("utf-8", "surrogatepass")
    out, at = [], 0
    for a, b in zip(places[::2], places[1::2]):
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")
