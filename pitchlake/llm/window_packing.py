"""Best-fit decreasing packing of tokenised documents into windows of one length.

A document's ids and an end mark are cut into as many full windows as they fill, each a sequence by
itself; what is left over (shorter than a window) is dealt to shards of bounded size and packed there, longest
first, each into the open window with the least room that holds it. The window is found in a segment tree
over capacities: leaf c counts the open windows with c free ids, so the tightest fit is the first
non-empty leaf from the piece's length on.

The few windows that a shard leaves underfilled are emptied again and their ids poured into the gaps of the
others, cut where a gap ends; at most one window of a shard stays short of its length.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.llm.scratch import cut
from pitchlake.llm.tokens import blocks

#: Ids of a window, and the id that ends a document.
WINDOW, END = 1024, 0
#: Left-over pieces of a shard (about 20 MB of ids); a shard is packed by one task.
SHARD = 10_000
#: Most pieces of a long text in a batch.
BATCH = 1 << 17
#: Fixed value: the pre-token pattern of the byte-level BPE vocabularies.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Room:
    """Open windows by free ids: a segment tree over the capacities 0..window."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, free: int, b: int) -> None:
        self.bins[free].append(b)
        at = free + self.size
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(free, window) of the tightest open window with at least ``need`` free ids, which is removed; None if there is none."""
        at = need + self.size
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        free = at - self.size
        while at:
            self.count[at] -= 1
            at >>= 1
        return free, self.bins[free].pop()


def best_fit_decreasing(sizes: list[int], window: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece, given sizes in descending order, none above ``window``."""
    room = Room(window)
    place, bins = [], 0
    for size in sizes:
        free, b = room.take(size) or (window, bins)
        bins += b == bins
        place.append((b, window - free))
        if free > size:
            room.add(free - size, b)
    return place


def pour(sizes: list[int], place: list[tuple[int, int]], window: int) -> list[tuple[int, int, int, int]]:
    """(piece, first, length, bin, offset) of the parts of pieces after the emptiest bins were poured into the gaps of the others.

    Bins are emptied from the emptiest on while the gaps of the rest hold their ids.
    """
    n = max((b for b, _ in place), default=-1) + 1
    used = [0] * n
    for size, (b, _) in zip(sizes, place):
        used[b] += size
    order = sorted(range(n), key=lambda b: (used[b], -b))
    gaps = sum(window - u for u in used)
    gone: set[int] = set()
    loose = 0
    for b in order:
        if loose + used[b] > gaps - (window - used[b]):
            break
        loose += used[b]
        gaps -= window - used[b]
        gone.add(b)
    out = [(k, 0, size, b, offset) for k, (size, (b, offset)) in enumerate(zip(sizes, place)) if b not in gone]
    rest = [(k, size) for k, (size, (b, _)) in enumerate(zip(sizes, place)) if b in gone]
    # the widest gaps first, so that few cuts are needed
    open_ = [b for b in order if b not in gone and used[b] < window]
    at = 0
    for k, size in rest:
        first = 0
        while first < size:
            b = open_[at]
            part = min(size - first, window - used[b])
            out.append((k, first, part, b, used[b]))
            used[b] += part
            first += part
            at += used[b] == window
    return out


class Encoder:
    """Ids of texts by a tokenizer file of byte-level BPE.

    ``ranks`` may name the same vocabulary as a rank file; texts without a special token's string then go through
    the rank encoder, which gives the same ids in a fifth of the time (tests compare both on every
    code point), the others through the tokenizer file.
    """

    def __init__(self, path: str, ranks: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=PRE_TOKENS, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast and not any(s in text for s in self.special):
            return self.fast.encode_ordinary(text)
        return self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids


_LOADED: dict[tuple, Encoder] = {}


def _tokenize(batches: Iterable[pa.RecordBatch], files: tuple[str, str | None], end: int) -> Iterator[pa.RecordBatch]:
    """(id, ids) of every document: its ids and the end mark."""
    if files not in _LOADED:
        _LOADED[files] = Encoder(*files)
    model = _LOADED[files]
    for batch in batches:
        column = batch.column("text")
        for texts in blocks(column):
            ids = [np.array([*model.ids(t.as_py() or ""), end], np.int32) for t in column.slice(texts.first, len(texts))]
            offsets = np.append(0, np.cumsum([len(x) for x in ids]))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(texts.first, len(texts)), lists], names=["id", "ids"])


def _cut_windows(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Full windows of each document's ids and the rest: (id, start, ids, doc_tokens), the ids as bytes."""
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        n = np.diff(offsets)
        pieces = -(-n // window)
        doc = np.repeat(np.arange(len(n)), pieces)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
        flat = lists.flatten()
        begin = offsets[:-1][doc] - offsets[0] + start
        ends = np.minimum(begin + window, offsets[1:][doc] - offsets[0])
        cuts = np.append(begin, ends[-1:])  # pieces follow one another without gap
        raw = flat.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
        for at in range(0, len(doc), BATCH):
            part = cuts[at : at + BATCH + 1]
            ids = pa.Array.from_buffers(
                pa.binary(), len(part) - 1, [None, pa.py_buffer(((part - part[0]) * 4).astype(np.int32)), pa.py_buffer(raw[part[0] : part[-1]])])
            own = doc[at : at + BATCH]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(own)), pa.array(start[at : at + BATCH]), ids, pa.array(n[own])],
                names=["id", "start", "ids", "doc_tokens"],
            )


def _pieces(batches: Iterable[pa.RecordBatch], files: tuple[str, str | None], window: int, end: int) -> Iterator[pa.RecordBatch]:
    yield from _cut_windows(_tokenize(batches, files, end), window)


def _pack_shard(pdf: pd.DataFrame, window: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["length", "order", "start"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    sizes = pdf["length"].astype(int).tolist()
    rows = pour(sizes, best_fit_decreasing(sizes, window), window)
    piece = np.array([r[0] for r in rows], np.int64)
    ids = pdf["ids"].tolist()
    return pd.DataFrame({
        "id": pdf["id"].take(piece).to_numpy(),
        "start": pdf["start"].to_numpy()[piece] + [r[1] for r in rows],
        "length": [r[2] for r in rows],
        "ids": [ids[k][4 * first : 4 * (first + size)] for k, first, size, _, _ in rows],
        "doc_tokens": pdf["doc_tokens"].to_numpy()[piece],
        "shard": pdf["shard"].to_numpy()[piece],
        "bin": [r[3] for r in rows],
        "offset": [r[4] for r in rows],
    })


def _as_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``ids`` as lists instead of bytes."""
    for batch in batches:
        at = batch.schema.get_field_index("ids")
        column = batch.column(at)
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
        data = column.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view("<i4") if len(column) else np.empty(0, np.int32)
        lists = pa.ListArray.from_arrays(pa.array((offsets - offsets[0]) // 4, pa.int32()), pa.array(raw, pa.int32()))
        yield batch.set_column(at, "ids", lists)


def pack_windows(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END, id_col: str = "doc_id",
                 text_col: str = "text", shard: int = SHARD, ranks: str | None = None, as_bytes: bool = False) -> DataFrame:
    """One row a piece: (id, start, length, ids, doc_tokens, sequence_id, offset).

    A document is its ids by the tokenizer file ``tokenizer`` and the id ``end`` (``ranks``: the same vocabulary as a rank
    file, for speed; paths that every executor has); ``ids`` is an array, or with ``as_bytes`` the ids as little-endian 32-bit
    numbers, which Spark moves in one piece; ``start`` counts its ids before the piece, ``doc_tokens`` all of them. The pieces of a document cover it without gap
    or overlap, those of a sequence follow one another from offset 0. Full windows never leave the task that made them
    but as files; only what is left of a document is shuffled, once.

    Edge cases: null and empty texts have the end mark alone; a very long text is tokenised by itself in its
    task; null ids and repeated rows are packed each; equal lengths go in the order of a hash of their row; an empty
    table gives an empty result. Other columns are not read, whatever their names.
    """
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    t = src.schema["id"].dataType.simpleString()
    made = src.mapInArrow(partial(_pieces, files=(tokenizer, ranks), window=window, end=end), f"id {t}, start long, ids binary, doc_tokens long")
    pieces = cut(made.withColumn("length", F.expr("octet_length(ids) div 4")), "token-pieces")
    pieces = pieces.withColumn("row", F.monotonically_increasing_id())  # of a written table
    rests = pieces.where(F.col("length") < window)
    shards = max(1, -(-rests.count() // shard))
    dealt = rests.withColumn("order", F.xxhash64("row")).withColumn("shard", F.pmod(F.col("order"), F.lit(shards))).drop("row")
    packed = dealt.groupBy("shard").applyInPandas(
        lambda pdf: _pack_shard(pdf, window),
        f"id {t}, start long, length long, ids binary, doc_tokens long, shard long, bin long, offset long",
    )
    # even numbers for packed windows (a shard has at most 2 * shard of them), odd ones for full windows
    packed = packed.withColumn("sequence_id", 2 * (F.col("shard") * (2 * shard) + F.col("bin")))
    full = pieces.where(F.col("length") == window).withColumn("sequence_id", 2 * F.col("row") + 1).withColumn("offset", F.lit(0).cast("long"))
    order = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    found = packed.select(*order).union(full.select(*order))
    if not as_bytes:
        found = found.mapInArrow(_as_lists, f"id {t}, start long, length long, ids array<int>, doc_tokens long, sequence_id long, offset long")
    return found.withColumnRenamed("id", id_col)


def _crc_column(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("ids")
        lists = batch.column(at)
        offsets = (lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()) * 4
        raw = memoryview(lists.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes())
        crc = pa.array([zlib.crc32(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.int64())
        yield batch.set_column(at, "ids_crc32", crc)


def with_crc32(pieces: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32``, the CRC-32 of the ids as little-endian unsigned 32-bit numbers."""
    if pieces.schema["ids"].dataType == T.BinaryType():
        return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
    fields = ", ".join("ids_crc32 long" if f.name == "ids" else f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return pieces.mapInArrow(_crc_column, fields)
