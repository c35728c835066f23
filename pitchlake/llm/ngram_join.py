"""N-gram Jaccard self-join with adaptive multi-match prefixes, and its connected components.

Two texts link when the Jaccard similarity of their sets of k-word shingles reaches a
threshold t. Under any total order of the shingles, two linked sets of n and m elements
share at least l elements among the first n - ceil(t n) + l and m - ceil(t m) + l: a prefix
lengthened by l - 1 must hold l matches. The join uses this three times, each time with
longer prefixes for fewer texts:

1. *Screen.* Every text spends a prefix of its longest shingles (in bytes; long shingles
   are rare ones, and the order needs no corpus pass) lengthened by a ``SCREEN`` share of
   its set, and stays only if that many are shared with a different text.
2. *Whole sets.* The texts that stay are lengthened to their whole sets: ceil(t n) elements
   must be shared with another such text.
3. *Pairs.* Elements are ordered by the number of remaining texts that hold them. Each text
   estimates its candidate cost from the posting lengths of its shortest prefix, and
   lengthens the prefix (and the matches asked for) the more candidates that prefix would
   bring. A pair is verified on whole sets if it shares min(l, l') prefix elements and its
   positions leave room for the needed overlap.

Copies are one node. Groups of near copies would still make a quadratic number of pairs, so
each prefix element first names a hub (the text with the fewest elements of its own), every
text is verified against hubs only, and the components of those links are formed. What
remains are pairs in *different* components that share a prefix element; an element
held by one component makes no pair at all. No link between components is lost, and no
list of candidates is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import tokens
from pitchlake.llm.components import components
from pitchlake.llm.scratch import cut, join_counted

#: Prefix lengthening of the screen, as a share (in hundredths) of the set.
SCREEN = 4
#: Elements that a task gathers before it looks for those shared among its own texts.
FLUSH = 1 << 18
#: Rounds of hub links before the remaining pairs of different components are listed.
HUB_ROUNDS = 1


def _elements(texts: tokens.Texts, k: int) -> list[np.ndarray]:
    """Per text: its distinct shingles as sorted 64-bit elements, longest shingles first.

    The upper byte falls with the bytes of the shingle's words, the other 56 bits are its hash.
    """
    begin, end, owner = tokens.runs(texts, tokens.NOT_SPACE)
    h = tokens.Hasher(texts.data, lower=True).of(begin, end)
    size = np.zeros(len(h) + 1, np.int64)
    np.cumsum(end - begin, out=size[1:])

    def element(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        rank = (63 - np.minimum(sizes >> 1, 63)).astype(np.uint64) << np.uint64(56)
        return (rank | (hashes >> np.uint64(8))).view(np.int64)

    s, of = tokens.grams(h, owner, k)
    if len(h) >= k:
        inner = owner[: len(owner) - k + 1] == owner[k - 1 :]
        s = element(s, (size[k:] - size[:-k])[inner])
    cut_at = np.searchsorted(of, np.arange(len(texts) + 1))
    out = [np.unique(s[a:b].view(np.int64)) for a, b in zip(cut_at[:-1], cut_at[1:])]
    n_words = np.bincount(owner, minlength=len(texts))
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    for t, f in zip(short.tolist(), np.searchsorted(owner, short).tolist()):
        n = int(n_words[t])
        whole, _ = tokens.grams(h[f : f + n], owner[f : f + n], n)
        out[t] = element(whole, size[f + n : f + n + 1] - size[f])
    return out


def _class(elements: np.ndarray) -> tuple[int, int]:
    """A 128-bit key of a set."""
    u = elements.view(np.uint64)
    a = tokens.mix(tokens.mix(u ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(u)))
    b = tokens.mix(tokens.mix(u + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64, keepdims=True) ^ np.uint64(len(u)))
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])


def _texts(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    for run in tokens.blocks(batch.column("text")):
        for i, e in enumerate(_elements(run, k)):
            yield run.first + i, e


def _classes(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(len(e), *(_class(e) if len(e) else (0, 0))) for _, e in _texts(batch, k)]
        n, a, b = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
            names=["id", "n", "class_a", "class_b"],
        )


def _emit(ids: list[np.ndarray], elements: list[np.ndarray]) -> pa.RecordBatch:
    """(element, id, credit) rows of some texts, pre-aggregated.

    An element that several of these texts hold is credited to them at once, and only two
    of its rows go on (to tell texts elsewhere), so no element sends more than two rows a flush.
    """
    id_ = np.repeat(np.array(ids, np.int64), [len(e) for e in elements])
    el = np.concatenate(elements) if elements else np.empty(0, np.int64)
    order = np.lexsort((id_, el))
    el, id_ = el[order], id_[order]
    fresh = np.ones(len(el), bool)
    fresh[1:] = (el[1:] != el[:-1]) | (id_[1:] != id_[:-1])
    el, id_ = el[fresh], id_[fresh]
    first = np.ones(len(el), bool)
    first[1:] = el[1:] != el[:-1]
    group = np.cumsum(first) - 1
    held = np.bincount(group, minlength=0)[group] if len(el) else group
    rank = np.arange(len(el)) - np.flatnonzero(first)[group] if len(el) else group
    shared = held > 1
    go = rank < 2
    who, credit = np.unique(id_[shared & ~go], return_counts=True)
    # a local credit travels as a row of an element of its own: the id itself, marked by the credit
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([el[go], who])),
            pa.array(np.concatenate([id_[go], who])),
            pa.array(np.concatenate([np.zeros(int(go.sum()), np.int32), credit.astype(np.int32)])),
        ],
        names=["element", "id", "credit"],
    )


def _screen_rows(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Screen prefixes of each different text of the task, as (element, class, credit) rows."""
    ids: list = []
    kept: list = []
    seen: set = set()
    total = 0
    for batch in batches:
        for _, e in _texts(batch, k):
            n = len(e)
            if not n:
                continue
            a, _b = _class(e)
            if a in seen:
                continue
            seen.add(a)
            prefix = e[: n - (percent * n + 99) // 100 + 1 + SCREEN * n // 100]
            ids.append(a)
            kept.append(prefix.copy())
            total += len(prefix)
            if total >= FLUSH:
                yield _emit(ids, kept)
                ids, kept, seen, total = [], [], set(), 0
    if ids:
        yield _emit(ids, kept)


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole sets (node, elements) as (element, node, credit) rows."""
    ids: list = []
    kept: list = []
    total = 0
    for batch in batches:
        column = batch.column("elements")
        ends, values = column.offsets.to_numpy(), column.values.to_numpy()
        for i, node in enumerate(batch.column("node").to_numpy().tolist()):
            ids.append(node)
            kept.append(values[ends[i] : ends[i + 1]].copy())
            total += len(kept[-1])
            if total >= FLUSH:
                yield _emit(ids, kept)
                ids, kept, total = [], [], 0
    if ids:
        yield _emit(ids, kept)


def _credits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (element, id): one credit to each id of an element that different ids hold.

    Looks one row back only; an element that goes on in the next batch is followed there.
    """
    last_el = last_id = None
    last_told = False

    def out(ids: np.ndarray, credit: np.ndarray) -> pa.RecordBatch:
        who, at = np.unique(ids, return_inverse=True)
        total = np.bincount(at, weights=credit, minlength=len(who)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(who), pa.array(total)], names=["id", "credit"])

    for batch in batches:
        el, id_, credit = (batch.column(c).to_numpy() for c in ("element", "id", "credit"))
        local = credit > 0
        got_id, got = [id_[local]], [credit[local].astype(np.int64)]
        el, id_ = el[~local], id_[~local]
        if len(el):
            carry = last_el is not None and el[0] == last_el
            if carry:
                el, id_ = np.concatenate([[last_el], el]), np.concatenate([[last_id], id_])
            fresh = np.ones(len(el), bool)
            fresh[1:] = (el[1:] != el[:-1]) | (id_[1:] != id_[:-1])
            el, id_ = el[fresh], id_[fresh]
            first = np.ones(len(el), bool)
            first[1:] = el[1:] != el[:-1]
            group = np.cumsum(first) - 1
            shared = (np.bincount(group) > 1)[group]
            told = shared.copy()
            if carry and last_told:
                told[0] = False  # credited with the batch before
            got_id.append(id_[told])
            got.append(np.ones(int(told.sum()), np.int64))
            last_told = bool(shared[-1]) or (len(el) == 1 and carry and last_told)
            last_el, last_id = el[-1], id_[-1]
        ids, amounts = np.concatenate(got_id), np.concatenate(got)
        if len(ids):
            yield out(ids, amounts)


def _shared(rows: DataFrame) -> DataFrame:
    """(element, id, credit) rows -> (id, shared): elements of the id that another id holds too."""
    dealt = rows.repartition("element").sortWithinPartitions("element", "id")
    return (
        dealt.mapInArrow(_credits, "id long, credit long").groupBy("id").agg(F.sum("credit").alias("shared"))
    )


def _whole_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Sets of the chosen texts whose class is the one they were chosen for."""
    for batch in batches:
        nodes = batch.column("node").to_numpy()
        chosen = batch.column("class_a").to_numpy()
        found = [(i, e) for i, e in _texts(batch, k) if len(e) and _class(e)[0] == chosen[i]]
        if not found:
            continue
        sizes = np.array([len(e) for _, e in found], np.int64)
        ends = np.zeros(len(found) + 1, np.int32)
        np.cumsum(sizes, out=ends[1:])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(nodes[[i for i, _ in found]]),
                pa.array(sizes),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([e for _, e in found]))),
            ],
            names=["node", "n", "elements"],
        )


def _ordered_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Rows (element, node, n, own, at, ell): the adaptive prefix of each set, rarest elements first.

    ``own`` counts the elements no other set holds; they come first in the order and can match
    nothing, so they take up positions but make no rows. ``at`` is the 0-based position.
    """
    flat = sets.select("node", "n", F.explode("elements").alias("element"))
    held = flat.groupBy("element").agg(F.count("*").alias("df")).where("df > 1")
    ranked = (
        flat.join(held, "element")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "element"))).alias("order"))
    )
    base = F.expr(f"n - ({percent} * n + 99) div 100 + 1")
    ranked = ranked.select("node", "n", "order", (F.col("n") - F.size("order")).alias("own"), base.alias("base"))
    short = F.expr("slice(order, 1, int(greatest(base - own, 0)))")
    ranked = ranked.withColumn("cost", F.aggregate(short, F.lit(0).cast("long"), lambda total, x: total + x["df"] - 1))
    # candidates that the shortest prefix would bring, per element of the set: each doubling asks for one match more
    ell = F.expr("least(1 + int(floor(log2(1 + cost / n))), 1 + n div 20)")
    ranked = ranked.withColumn("ell", ell)
    prefix = F.expr("slice(order, 1, int(greatest(base + ell - 1 - own, 0)))")
    return ranked.select("node", "n", "own", "ell", F.posexplode(prefix)).select(
        F.col("col.element").alias("element"), "node", "n", F.col("own").cast("long").alias("own"),
        (F.col("own") + F.col("pos")).cast("long").alias("at"), F.col("ell").cast("int").alias("ell"),
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold on whole sets."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("elements").alias("ea"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("elements").alias("eb"))
    both = F.size(F.array_intersect("ea", "eb"))
    return (
        pairs.join(one, "a").join(two, "b")
        .where(100 * both >= percent * (F.col("na") + F.col("nb") - both))
        .select("a", "b")
    )


def _multi_match(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose prefixes share as many elements as the shorter lengthening asks for."""
    whole = prefixes.groupBy("node").agg(F.collect_list("element").alias("prefix"), F.min("ell").alias("ell"))
    one, two = (whole.select(F.col("node").alias(c), F.col("prefix").alias(f"p{c}"), F.col("ell").alias(f"l{c}")) for c in "ab")
    return (
        pairs.join(one, "a").join(two, "b")
        .where(F.size(F.array_intersect("pa", "pb")) >= F.least("la", "lb")).select("a", "b")
    )


def _component_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes that have the same components as all links."""
    prefixes = cut(_ordered_prefixes(sets, percent), "prefixes")
    root = sets.select("node", F.col("node").alias("root")).limit(0)
    links: DataFrame | None = None
    fits = f"least(x.n, y.n) * 100 >= {percent} * greatest(x.n, y.n)"
    # after the first element that a linked pair shares there is room for the rest of its overlap
    room = f"least(x.n - x.at, y.n - y.at) >= ({percent} * (x.n + y.n) + {99 + percent}) div {100 + percent}"
    for step in range(HUB_ROUNDS + 1):
        now = prefixes.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = now.groupBy("element").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        now = cut(now.join(mixed.select("element"), "element"), "postings")
        hub = now.groupBy("element").agg(F.min(F.struct("own", "node", "root")).alias("hub")).select(
            "element", F.col("hub.root").alias("main"), F.col("hub.node").alias("hub")
        )
        if step < HUB_ROUNDS:
            # the hub that a text shares most prefix elements with
            votes = now.join(hub, "element").where("root <> main").groupBy("node", "hub").agg(F.count("*").alias("votes"))
            best = votes.groupBy("node").agg(F.max(F.struct("votes", "hub")).alias("best"))
            pairs = best.select(F.col("node").alias("a"), F.col("best.hub").alias("b"))
        else:
            # one side of every pair of different components lies outside the element's main one
            x = now.join(hub, "element").where("root <> main").alias("x")
            pairs = _multi_match(
                x.join(now.alias("y"), F.expr(f"x.element = y.element and x.root <> y.root and {fits} and {room}"))
                .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(),
                prefixes,
            )
        found = cut(_verified(pairs, sets, percent), "links")
        links = found if links is None else links.union(found)
        if step < HUB_ROUNDS:
            root = cut(components(links), "roots")
    return links


def ngram_jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90
) -> DataFrame:
    """One row a document: (id, n_shingles, component_id), the smallest id reachable by links.

    Words are maximal runs without ASCII white space, A-Z lower-cased; a set holds the
    distinct k-word shingles (fewer words: the whole sequence as one). Documents link when
    100 * intersection >= percent * union.

    Edge cases: null and empty texts (and texts without words) have 0 shingles and are their own
    component. A null id gets its shingle count and a null component, and links nothing. Rows that
    repeat an id count as one node: links of any of its texts hold for it, each row is returned.
    An empty table gives an empty result. Other columns are not read, so their names cannot clash.
    Elements are 62-bit keys of shingles and classes 128-bit keys of sets; verification counts
    those keys.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    rows = cut(src.mapInArrow(partial(_classes, k=k), f"id {id_type}, n long, class_a long, class_b long"), "classes")
    whole = rows.where("n > 0 and id is not null")
    reps = whole.groupBy("class_a", "class_b", "n").agg(F.min("id").alias("node"))

    texts = src.where("id is not null").select("text")
    screened = _shared(texts.mapInArrow(partial(_screen_rows, k=k, percent=percent), "element long, id long, credit int"))
    reps = cut(reps, "representatives")
    # a partner may be smaller, down to ceil(t n), and then ask for fewer matches
    least = f"1 + {SCREEN} * (({percent} * n + 99) div 100) div 100"
    stay = cut(
        reps.join(screened.select(F.col("id").alias("class_a"), "shared"), "class_a").where(f"shared >= {least}")
        .select("node", "class_a"), "screened",
    )
    chosen = join_counted(src.where("id is not null"), stay.withColumnRenamed("node", "id"), ["id"])
    sets = cut(
        chosen.select(F.col("id").alias("node"), "class_a", "text").mapInArrow(
            partial(_whole_sets, k=k), f"node {id_type}, n long, elements array<long>"
        ),
        "sets",
    )
    shared = _shared(sets.select("node", "elements").mapInArrow(_set_rows, "element long, id long, credit int"))
    full = cut(shared.select(F.col("id").alias("node"), "shared"), "shared")
    sets = cut(
        join_counted(sets, full, ["node"]).where(f"shared >= ({percent} * n + 99) div 100").select("node", "n", "elements"),
        "sets",
    )
    links = _component_links(sets, percent)
    classes = reps.select("class_a", "class_b", "node")
    own = rows.where("n > 0 and id is not null").join(classes, ["class_a", "class_b"]).select("id", "node").where("id <> node")
    root = cut(components(links.union(own.select(F.col("id").alias("a"), F.col("node").alias("b")))), "roots")
    return rows.join(root, rows["id"] == root["node"], "left").select(
        rows["id"].alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("root", "id").alias("component_id")
    )
