"""Ranked lexical search, reversed: the items' terms are indexed, the documents stream through the index.

Items (the queries) are few against the corpus, so the inverted index is built over *their* terms and
broadcast, in blocks of items of bounded size. Documents pass twice:

1. every text is cut into terms once; what remains is its length and the counts of those terms that
   any item of the block holds. Document frequencies and totals come from these rows;
2. the counts of each document go through the index term by term, which adds up its score for
   every item that shares a term; each task keeps one bounded heap an item.

The heaps of the tasks are then merged in two steps, first salted by document, so that no
item's candidates meet in one task unreduced.

Terms are compared by a 64-bit hash of their bytes.
"""

from __future__ import annotations

import math
from bisect import insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.scratch import cut
from pitchlake.llm.tokens import ALNUM_WORD, blocks, words

#: Bounds of one block of items, and so of one broadcast index: distinct (item, term) pairs, and items.
MAX_POSTINGS, MAX_ITEMS = 2_000_000, 20_000
#: Cells of the score table of one batch of documents (documents x items).
CELLS = 1 << 19
#: Parts that an item's candidates are merged in before its final merge.
SALT = 16


@dataclass
class Index:
    """Inverted index of a block of items: postings of term t are ``item[first[t]:first[t + 1]]`` with ``times``."""

    terms: np.ndarray  # sorted hashes
    first: np.ndarray
    item: np.ndarray
    times: np.ndarray
    n_items: int


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, term, times) of every distinct term of an item."""
    for batch in batches:
        rows = batch.column("row").to_numpy()
        for texts in blocks(batch.column("text")):
            h, owner = words(texts, ALNUM_WORD, lower=True)
            pairs, times = np.unique(np.stack([owner.astype(np.uint64), h]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[texts.first + pairs[0].astype(np.int64)]), pa.array(pairs[1].view(np.int64)), pa.array(times, pa.int64())],
                names=["row", "term", "times"],
            )


def _index(rows: list) -> Index:
    """Index of collected (item number in the block, term, times)."""
    item, term, times = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    term = term.view(np.uint64)
    order = np.lexsort((item, term))
    terms, first = np.unique(term[order], return_index=True)
    return Index(terms, np.append(first, len(order)), item[order], times[order], int(item.max()) + 1 if len(item) else 0)


def _counts(batches: Iterable[pa.RecordBatch], terms) -> Iterator[pa.RecordBatch]:
    """(id, n, terms, tfs) of every text with a term: its length in terms, and its counts of indexed terms."""
    vocabulary = terms.value
    for batch in batches:
        for texts in blocks(batch.column("text")):
            h, owner = words(texts, ALNUM_WORD, lower=True)
            n = np.bincount(owner, minlength=len(texts))
            at = np.searchsorted(vocabulary, h)
            at[at == len(vocabulary)] = 0
            known = vocabulary[at] == h if len(vocabulary) else np.zeros(len(h), bool)
            key, tf = np.unique(owner[known] * max(len(vocabulary), 1) + at[known], return_counts=True)
            doc, term = np.divmod(key, max(len(vocabulary), 1))
            full = np.flatnonzero(n)
            cuts = np.append(np.searchsorted(doc, full), len(doc))
            lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x, pa.int32())) for x in (term, tf)]
            ids = batch.column("id").take(pa.array(texts.first + full))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n[full], pa.int64()), *lists], names=["id", "n", "terms", "tfs"])


def _m(n: list[int], docs: int, total: int) -> np.ndarray:
    """Length factor of each document; in Python integers, as 25 * n * docs may pass 64 bits."""
    return np.array([75 + 25 * x * docs // total for x in n], np.int64)


def _score(batches: Iterable[pa.RecordBatch], shared, k: int) -> Iterator[pa.RecordBatch]:
    """The k best (item, doc_id, score) of this task for every item of the index."""
    index, weight, docs, total = shared.value
    step = max(1, CELLS // max(index.n_items, 1))
    heaps: list[list] = [[] for _ in range(index.n_items)]  # ascending (-score, no id, id): best first, at most k
    floor = np.ones(index.n_items, np.int64)  # scores below cannot enter
    id_type = None
    for batch in batches:
        id_type = batch.schema.field("id").type
        none = 0 if pa.types.is_integer(id_type) else ""
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            lists = part.column("terms")
            size = np.diff(lists.offsets.to_numpy())
            term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            tf = part.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(part.num_rows), size)
            m = _m(part.column("n").to_pylist(), docs, total)
            gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
            width = index.first[term + 1] - index.first[term]
            posting = np.arange(width.sum()) + np.repeat(index.first[term] - (np.cumsum(width) - width), width)
            table = np.zeros(part.num_rows * index.n_items, np.int64)
            np.add.at(table, np.repeat(doc * index.n_items, width) + index.item[posting], np.repeat(gain, width) * index.times[posting])
            table = table.reshape(part.num_rows, index.n_items)
            # worth a look: at least the score of an item's k-th best so far
            d, i = np.nonzero(table >= floor)
            ids = part.column("id").to_pylist() if len(d) else []
            for row, item, score in zip(d.tolist(), i.tolist(), table[d, i].tolist()):
                heap = heaps[item]
                x = ids[row]
                insort(heap, (-score, x is None, none if x is None else x))
                if len(heap) > k:
                    heap.pop()
                if len(heap) == k:
                    floor[item] = -heap[-1][0]
    if id_type is not None:
        flat = [(i, None if no else x, -s) for i, heap in enumerate(heaps) for s, no, x in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in flat], pa.int64()), pa.array([r[1] for r in flat], id_type), pa.array([r[2] for r in flat], pa.int64())],
            names=["item", "id", "score"],
        )


def _merge(candidates: DataFrame, k: int) -> DataFrame:
    """The k best of every item: within salted parts of its candidates, then of what those leave."""
    order = [F.desc("score"), F.asc_nulls_last("id")]
    part = F.pmod(F.xxhash64("id", "score"), F.lit(SALT))
    some = candidates.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
    some = some.where(F.col("rank") <= k).drop("rank", "part")
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return best.where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", max_postings: int = MAX_POSTINGS,
                  max_items: int = MAX_ITEMS) -> DataFrame:
    """(item_col, rank, id_col, score): the k best documents of every item with a score above 0.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z in lower case. With N documents that
    hold a term, L terms in all, n terms of a document, tf and df as usual: a term weighs
    w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 75 + 25 n N div L, and a document scores the sum over
    the item's terms (repeats included) of w * (10**9 tf div (1000 tf + 12 m)). Equal scores go by ascending id.

    The index of at most ``max_postings`` (item, term) pairs and ``max_items`` items is broadcast; more items make more
    blocks, one after another, each with its own pass over the documents. No document or item is left out.

    Edge cases: null and empty texts have no terms, count nowhere and are never found; a very long text is a
    block of its own in its task; every row is a document, so repeated rows (of one id or not) each
    take a rank, and null ids rank after others of their score; every item row is a query of its own, so a
    repeated item id has a ranking a row; items without terms or without hits give no rows; empty
    tables give an empty result. Other columns are not read, whatever their names. ``id_col`` holds
    integers or strings.
    """
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    rows = cut(items.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{item_col}`").alias("item_id"),
                            F.col(f"`{item_text_col}`").cast("string").alias("text")), "items")
    pairs = cut(rows.select("row", "text").mapInArrow(_item_terms, "row long, term long, times long"), "item-terms")
    n_pairs, n_items = pairs.agg(F.count("*"), F.countDistinct("row")).first()
    # items of a block are those of one hash; twice as many blocks as the bounds ask for, as hashes deal unevenly
    n = 1 if n_pairs <= max_postings and n_items <= max_items else 2 * max(-(-n_pairs // max_postings), -(-n_items // max_items))
    found = None
    for b in range(n):
        block = pairs.where(F.pmod(F.xxhash64("row"), F.lit(n)) == b)
        numbers = {r[0]: i for i, r in enumerate(block.select("row").distinct().orderBy("row").collect())}
        index = _index([(numbers[r[0]], r[1], r[2]) for r in block.collect()])
        if not numbers:
            continue
        terms = sc.broadcast(index.terms)
        counts = cut(src.mapInArrow(partial(_counts, terms=terms), f"id {id_type}, n long, terms array<int>, tfs array<int>"), "counts")
        size, total = counts.agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(len(index.terms), np.int64)
        for r in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most a row an indexed term
            df[r[0]] = r[1]
        weight = np.array([math.floor(1000 * math.log((2 * size + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        shared = sc.broadcast((index, weight, size, total or 1))
        scored = counts.where(F.size("terms") > 0).mapInArrow(partial(_score, shared=shared, k=k), f"item long, id {id_type}, score long")
        names = docs.sparkSession.createDataFrame([(i, row) for row, i in numbers.items()], "item long, row long")
        # at most max_items rows a block
        best = _merge(scored, k).join(F.broadcast(names), "item").select("row", "rank", "id", "score")
        if n > 1:
            best = cut(best, "ranked")  # before the next block's index is built
            shared.unpersist()
        terms.unpersist()
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = src.limit(0).select(F.lit(0).cast("long").alias("row"), F.lit(0).alias("rank"), "id", F.lit(0).cast("long").alias("score"))
    ids = rows.select("row", "item_id")
    out = found.join(ids.hint("merge") if n_items > max_items else ids, "row")
    return out.select(F.col("item_id").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
