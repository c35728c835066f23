"""Best-fit packing into bins of several permitted lengths.

Documents are cut into pieces no longer than the largest permitted length, dealt to shards of
bounded size by a hash of their row, and packed shard by shard: longest piece first, each
into the open bin with the least room that holds it. Which lengths may open is chosen jointly:
the shard's pieces are packed once for every mix of permitted lengths and either way to open a
bin, and the packing of least total cost stays. At the end every bin shrinks to the smallest
permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.scratch import cut


@dataclass(frozen=True)
class Bins:
    """Permitted lengths in tokens, ascending; cost of a bin: fixed + length + attention * length**2."""

    lengths: tuple[int, ...] = (256, 512, 1024, 2048, 4096)
    fixed: float = 16.0
    attention: float = 1e-5

    def cost(self, length: int) -> float:
        return self.fixed + length + self.attention * length * length


#: Pieces of a shard; a shard is packed by one task.
SHARD = 5000


def _trial(sizes: list[int], bins: Bins, mix: tuple[int, ...], snug: bool) -> tuple[float, list[tuple[int, int]], list[int]]:
    """(total cost, (bin, offset) of each piece, final capacity of each bin) if only the lengths ``mix`` may open.

    A new bin takes the shortest length of the mix that holds its first piece (``snug``), else the length of
    least cost per token that this piece and the shorter ones to come can fill.
    """
    rest = sum(sizes)
    price = {c: bins.cost(c) for c in bins.lengths}
    room: list[tuple[int, int]] = []  # (free tokens, bin), ascending
    used: list[int] = []
    place: list[tuple[int, int]] = []
    for size in sizes:
        rest -= size
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            fitting = mix[bisect_left(mix, size) :]
            free = fitting[0] if snug else min(fitting, key=lambda c: (price[c] / (size + min(c - size, rest)), c))
            b = len(used)
            used.append(0)
        place.append((b, used[b]))
        used[b] += size
        if free - size:
            insort(room, (free - size, b))
    final = [bins.lengths[bisect_left(bins.lengths, u)] for u in used]
    return sum(price[c] for c in final), place, final


def mixes(bins: Bins, longest: int) -> list[tuple[int, ...]]:
    """Every set of permitted lengths whose largest holds a piece of ``longest`` tokens."""
    n = len(bins.lengths)
    return [
        mix for k in range(1, n + 1) for mix in combinations(bins.lengths, k) if mix[-1] >= longest
    ]


def pack(sizes: list[int], bins: Bins) -> list[tuple[int, int, int]]:
    """(bin, offset, final capacity) of each piece, given sizes in descending order, none above the largest length.

    The packing of least total cost over all mixes of lengths and both ways to open a bin; equal costs go to
    the mix of fewer lengths, then to that of shorter ones. The mixes of one length are among them, so no
    single length packed the same way costs less.
    """
    if not sizes:
        return []
    _, place, final = min(
        (_trial(sizes, bins, mix, snug) for mix in mixes(bins, sizes[0]) for snug in ((True,) if len(mix) == 1 else (False, True))),
        key=lambda found: found[0],
    )
    return [(b, offset, final[b]) for b, offset in place]


def _pack_shard(pdf: pd.DataFrame, bins: Bins) -> pd.DataFrame:
    pdf = pdf.sort_values(["size", "order", "first"], ascending=[False, True, True], kind="stable")
    placed = pack(pdf["size"].astype(int).tolist(), bins)
    pdf["bin"] = [b for b, _, _ in placed]
    pdf["offset"] = [o for _, o, _ in placed]
    pdf["capacity"] = [c for _, _, c in placed]
    return pdf[["id", "first", "size", "shard", "bin", "offset", "capacity"]]


def best_fit_pack(docs: DataFrame, n_tokens: Column, id_col: str = "doc_id", bins: Bins = Bins(), shard: int = SHARD) -> DataFrame:
    """One row a piece: (id, first, n_tokens, bin_id, position, capacity).

    ``first`` is the number of the piece's first token in its document, ``bin_id`` names the bin,
    ``position`` is where the piece begins in it, ``capacity`` the bin's final length. The pieces of a
    document cover it without gap or overlap, those of a bin its first tokens.

    Only ids and lengths are shuffled, never texts. Shards hold about ``shard`` pieces, as many
    shards as that takes; pieces are dealt by a hash of their row, so no id or length is hot.

    Edge cases: documents without tokens (null, empty) get one row with 0 tokens and null bin,
    position and capacity; null ids are packed too; repeated rows are packed each;
    equal lengths go in the order of a hash of their id; an empty table gives an empty result.
    """
    largest = bins.lengths[-1]
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(n_tokens.cast("long"), F.lit(0)).alias("n"))
    id_type = src.schema["id"].dataType.simpleString()
    src = cut(src, "lengths")
    starts = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(largest).cast("long"))
    pieces = src.where("n > 0").select("id", "n", F.explode(starts).alias("first")).select(
        "id", "first", F.least(F.col("n") - F.col("first"), F.lit(largest)).alias("size")
    )
    total = src.agg(F.sum(F.expr(f"(n + {largest - 1}) div {largest}"))).first()[0] or 0
    shards = max(1, -(-total // shard))
    # dealt by the row of the written table, so that repeated or null ids spread over the shards too
    pieces = pieces.select(
        "id", "first", "size", F.xxhash64(F.col("id").cast("string"), "first").alias("order"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).alias("shard"),
    )
    packed = pieces.groupBy("shard").applyInPandas(
        lambda pdf: _pack_shard(pdf, bins),
        f"id {id_type}, first long, size long, shard long, bin long, offset long, capacity long",
    )
    rows = packed.select(
        F.col("id").alias(id_col), "first", F.col("size").alias("n_tokens"),
        F.concat_ws("-", "shard", "bin").alias("bin_id"), F.col("offset").alias("position"), "capacity",
    )
    none = src.where("n <= 0").select(
        F.col("id").alias(id_col), F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("n_tokens"),
        F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("long").alias("position"), F.lit(None).cast("long").alias("capacity"),
    )
    return rows.union(none)


def word_count(text: Column) -> Column:
    """Words (runs without white space) of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
