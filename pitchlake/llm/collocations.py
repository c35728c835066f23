"""Phrase collocations from suffix subtrees that are built independently, one prefix group at a time.

Every frequent phrase is a path of the suffix tree of the corpus' words, cut off at depth four. The tree is
partitioned vertically, by the words its suffixes begin with:

1. words are counted, then pairs of frequent words. A suffix ends with its first pair that is not frequent, as
   no frequent phrase reaches beyond; frequent words and pairs travel as Bloom filters of fixed
   size, whose false positives only lengthen suffixes;
2. a prefix of one word with more suffixes than a group may be filled with is extended by the next word, and
   so on; the prefixes are dealt to as many groups as the suffixes need at the group's budget;
3. each group sorts its suffixes into the depth-first order of its subtrees and reads each node's
   count off the leaf totals below it in one pass over batches, so a group never lies whole in memory.
   Nodes above an extended prefix are spread over groups; their partial counts are added up.

Scores, cuts and the containment rule are then joins on the (small) table of frequent phrases.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.scratch import cut, join_counted, text_batches
from pitchlake.llm.tokens import Hasher, Texts, blocks, mix, runs

#: Longest phrase in words.
DEPTH = 4
#: Suffix rows of a group; prefixes above a small share of it are extended.
GROUP_ROWS = 1 << 19
#: Least number of suffix rows from which a prefix is extended, and most prefixes of a length that are: the
#: bound rises with the corpus, so the extended prefixes can be broadcast at any size.
EXTEND_ROWS, MAX_EXTENDED = 1 << 14, 100_000
#: Bits of a Bloom filter.
FILTER_BITS = 1 << 26
#: Bits that a pair's hash is shortened by: collisions only add to counts, so no frequent pair is missed, and rows
#: of 40 bits take less of the shuffle.
SHORTER = np.uint64(24)
#: Parts that a language's phrases are ranked in before its final ranking.
SALT = 16
#: Bytes of text that are worked on at once.
BLOCK = 1 << 18

#: Suffix rows and pairs that a task holds before they leave it (under 100 MB while they are merged).
FLUSH, FLUSH_PAIRS = 1 << 19, 1 << 20
#: Suffix rows of a batch that leaves a task.
OUT_ROWS = 1 << 16

_BREAK = np.zeros(256, np.int64)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = 1
_WORD = _BREAK == 0
_WORD[[0x20, 0x09]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


class Words:
    """The words of a block of texts in lower case, each followed by one blank, with piece numbers and languages."""

    def __init__(self, texts: Texts, lang: np.ndarray):
        begin, end, self.owner = runs(texts, _WORD)
        size = end - begin + 1
        self.first = np.append(0, np.cumsum(size))
        source = np.arange(self.first[-1]) + np.repeat(begin - self.first[:-1], size)
        source[self.first[1:] - 1] = 0
        self.data = _LOWER[texts.data[source]] if len(begin) else np.empty(0, np.uint8)
        self.data[self.first[1:] - 1] = 0x20
        breaks = np.cumsum(_BREAK[texts.data]) if len(texts.data) else np.empty(0, np.int64)
        # a break anywhere before a word raises its number; so does a new text
        self.piece = (breaks[begin] if len(begin) else begin) + self.owner * (len(texts.data) + 1)
        self.lang = lang[self.owner]
        self.hasher = Hasher(self.data)

    def __len__(self) -> int:
        return len(self.first) - 1

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of words [begin, end) with their language."""
        return mix(self.hasher.of(self.first[begin], self.first[end]) ^ self.lang[begin])

    def strings(self, begin: np.ndarray, end: np.ndarray) -> pa.Array:
        """Words [begin, end) as they stand in ``data``, the last blank included."""
        a, b = self.first[begin], self.first[end]
        offsets = np.append(0, np.cumsum(b - a))
        at = np.arange(offsets[-1]) + np.repeat(a - offsets[:-1], b - a)
        return pa.LargeStringArray.from_buffers(len(a), pa.py_buffer(offsets), pa.py_buffer(self.data[at].tobytes()))


def _language(column: pa.Array) -> tuple[np.ndarray, list]:
    """Hash of each row's language, and the languages themselves."""
    names = column.to_pylist()
    known: dict[str, int] = {}
    for x in names:
        if x not in known:
            raw = np.frombuffer(x.encode(), np.uint8)
            known[x] = int(Hasher(raw).of(np.zeros(1, np.int64), np.array([len(raw)]))[0])
    return np.array([known[x] for x in names], np.uint64), names


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[Words, pa.Array]]:
    """Words of each block of a batch, and the language of each word."""
    codes, names = _language(batch.column("lang"))
    names = pa.array(names, pa.string())
    for texts in blocks(batch.column("text"), BLOCK):
        w = Words(texts, codes[texts.first : texts.first + len(texts)])
        yield w, names.slice(texts.first, len(texts)).take(pa.array(w.owner))


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, f) of every distinct word of a block."""
    for batch in batches:
        for w, lang in _blocks(batch):
            at = np.arange(len(w))
            _, first, times = np.unique(w.spans(at, at + 1), return_index=True, return_counts=True)
            words = w.strings(first, first + 1)
            yield pa.RecordBatch.from_arrays(
                [lang.take(pa.array(first)), words.cast(pa.string()), pa.array(times, pa.int64())], names=["lang", "phrase", "f"])


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the filter that belong to a hash."""
    return (h % np.uint64(bits)).astype(np.int64), (mix(h) % np.uint64(bits)).astype(np.int64)


def _word_hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of every (lang, phrase) of one word, as ``Words.spans`` gives it."""
    for batch in batches:
        codes, _ = _language(batch.column("lang"))
        for texts in blocks(batch.column("phrase")):
            h = Hasher(texts.data).of(texts.starts[:-1], texts.starts[1:])
            h = mix(h ^ codes[texts.first : texts.first + len(texts)])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])


def _filter_words(batches: Iterable[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """(word, flags): the 32-bit words of the filter that the hashes set."""
    for batch in batches:
        p = np.concatenate(_places(batch.column("h").to_numpy().view(np.uint64), bits))
        yield pa.RecordBatch.from_arrays([pa.array(p >> 5), pa.array(np.int64(1) << (p & 31))], names=["word", "flags"])


def _bloom(hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter of a column ``h``: at most bits / 32 rows come to the driver, whatever the corpus."""
    set_ = hashes.mapInArrow(partial(_filter_words, bits=bits), "word long, flags long")
    flags = np.zeros(bits >> 5, np.uint32)
    for r in set_.groupBy("word").agg(F.bit_or("flags").alias("flags")).toLocalIterator():
        flags[r[0]] = r[1]
    return flags


def _held(h: np.ndarray, flags: np.ndarray, bits: int) -> np.ndarray:
    one, two = _places(h, bits)
    hit = lambda p: (flags[p >> 5] >> (p & 31).astype(np.uint32)) & np.uint32(1) == 1
    return hit(one) & hit(two)


def _count_pairs(batches: Iterable[pa.RecordBatch], shared, bits: int) -> Iterator[pa.RecordBatch]:
    """(h, f) of the pairs of frequent words, by hash: those of many blocks are counted together, FLUSH_PAIRS at a time."""
    flags = shared.value
    held: list[np.ndarray] = []
    for batch in batches:
        for w, _ in _blocks(batch):
            at = np.arange(len(w))
            frequent = _held(w.spans(at, at + 1), flags, bits)
            at = np.flatnonzero(frequent[:-1] & frequent[1:] & (w.piece[:-1] == w.piece[1:]))
            held.append(w.spans(at, at + 2) >> SHORTER)
            if sum(map(len, held)) > FLUSH_PAIRS:
                yield from _counted(held)
                held = []
    yield from _counted(held)


def _counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    if held:
        h, f = np.unique(np.concatenate(held), return_counts=True)
        for k in range(0, len(h), 100_000):
            part = slice(k, k + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(h[part].view(np.int64)), pa.array(f[part], pa.int64())], names=["h", "f"])


def _merged(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """(lang, suffix, times) of the (hash, lang, suffix, times) of several blocks, equal suffixes once, OUT_ROWS at a time.

    The blocks are let go before the first rows are given.
    """
    h, times = (np.concatenate([x[i] for x in held]) for i in (0, 3))
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    total = np.bincount(which, times).astype(np.int64)  # exact: far below 2**53
    del h, which, times
    langs, suffixes = ([x[i] for x in held] for i in (1, 2))
    held.clear()
    langs, suffixes = pa.concat_arrays(langs), pa.concat_arrays(suffixes)
    for k in range(0, len(first), OUT_ROWS):
        at = pa.array(first[k : k + OUT_ROWS])
        yield pa.RecordBatch.from_arrays(
            [langs.take(at), suffixes.take(at).cast(pa.string()), pa.array(total[k : k + OUT_ROWS])], names=["lang", "suffix", "times"])


def _suffixes(batches: Iterable[pa.RecordBatch], shared, bits: int, depth: int) -> Iterator[pa.RecordBatch]:
    """(lang, suffix, times): suffixes that begin with a frequent pair, cut off at ``depth`` or the first other pair.

    Equal suffixes of many blocks are counted together, FLUSH rows at a time.
    """
    flags = shared.value
    held: list[tuple] = []
    for batch in batches:
        for w, lang in _blocks(batch):
            n = len(w)
            at = np.flatnonzero(w.piece[:-1] == w.piece[1:])
            pair = np.zeros(n, bool)  # words i and i + 1 stand in one piece and are frequent together
            pair[at] = _held(w.spans(at, at + 2) >> SHORTER, flags, bits)
            size = np.ones(n, np.int64)
            goes_on = np.ones(n, bool)
            for k in range(1, depth):
                goes_on[: max(n - k + 1, 0)] &= pair[k - 1 :]
                goes_on[max(n - k + 1, 0) :] = False
                size += goes_on
            at = np.flatnonzero(size >= 2)
            h, first, times = np.unique(w.spans(at, at + size[at]), return_index=True, return_counts=True)
            at = at[first]
            held.append((h, lang.take(pa.array(at)), w.strings(at, at + size[at]), times))
            if sum(len(x[0]) for x in held) > FLUSH:
                yield from _merged(held)
    if held:
        yield from _merged(held)


def _prefix(depth: int):
    return F.substring_index("suffix", " ", depth)


def _extended(suffixes: DataFrame, words: DataFrame, depth: int) -> DataFrame:
    """Suffix rows with ``depth``, the number of words of the prefix that decides their group.

    A word's own count bounds the suffixes that begin with it; longer prefixes are counted on the suffix rows.
    """
    most = max(EXTEND_ROWS, (words.agg(F.sum("f")).first()[0] or 0) // MAX_EXTENDED)
    out = suffixes.withColumn("depth", F.lit(1))
    for k in range(1, depth):
        if k == 1:
            counted = words.select("lang", F.rtrim("phrase").alias("prefix"), "f")
        else:
            # rows that are not extended so far fall into one group without a prefix, of count 0
            here = F.col("depth") == k
            counted = out.groupBy("lang", F.when(here, _prefix(k)).alias("prefix")).agg(F.count_if(here).alias("f"))
        # fewer than MAX_EXTENDED prefixes can hold more than 1 / MAX_EXTENDED of all words or suffixes each
        big = cut(counted.where(F.col("f") > most).select("lang", "prefix", F.lit(k + 1).alias("next")), "extended")
        if big.isEmpty():
            break
        out = out.withColumn("prefix", _prefix(k)).join(F.broadcast(big), ["lang", "prefix"], "left")
        out = out.select("lang", "suffix", "times", F.coalesce(F.when(F.col("depth") == k, F.col("next")), F.col("depth")).alias("depth"))
    return out


def _read_counts(batches: Iterable[pa.RecordBatch], depth: int, least: int) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, f) of the nodes of depth 2 and more of the subtrees in a group's sorted suffixes.

    A node whose prefix was extended lies in several groups, so its count here may be partial and is always
    given; others are given from ``least`` on. The last node of each depth stays open over the end of a batch.
    """
    opened: dict[int, tuple[int, str, str, int, int]] = {}  # depth -> (hash, lang, phrase, count, prefix depth)
    for batch in batches:
        if not batch.num_rows:
            continue
        codes, langs = _language(batch.column("lang"))
        times = batch.column("times").to_numpy()
        route = batch.column("depth").to_numpy()
        out: list[tuple[str, str, int]] = []
        for texts in blocks(batch.column("suffix"), 1 << 31):
            part = slice(texts.first, texts.first + len(texts))
            code, weight, way = codes[part], times[part], route[part]
            hasher = Hasher(texts.data)
            blanks = np.flatnonzero(texts.data == 0x20)
            before = np.searchsorted(blanks, texts.starts)
            n_words = np.diff(before)
            for d in range(2, depth + 1):
                rows = np.flatnonzero(n_words >= d)
                if not len(rows):
                    continue
                end = blanks[before[rows] + d - 1] + 1
                start = texts.starts[rows]
                h = mix(hasher.of(start, end) ^ code[rows])
                # rows below one node are neighbours
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                counts = np.add.reduceat(weight[rows], first)
                given = (counts >= least) | (way[rows[first]] > d)
                given[[0, -1]] = True  # may go on from the batch before, or in the next
                for j in np.flatnonzero(given).tolist():
                    f, count, last = int(first[j]), int(counts[j]), j == len(counts) - 1
                    node = opened.get(d)
                    same = j == 0 and node is not None and node[0] == int(h[f])
                    if same:
                        count += node[3]
                    elif j == 0 and node is not None:
                        _close(node, d, least, out)
                    r = rows[f]
                    phrase = node[2] if same else texts.data[start[f] : end[f] - 1].tobytes().decode()
                    node = (int(h[f]), langs[texts.first + r], phrase, count, int(way[r]))
                    if last:
                        opened[d] = node
                    else:
                        _close(node, d, least, out)
        yield _phrases(out)
    out = []
    for d, node in opened.items():
        _close(node, d, least, out)
    yield _phrases(out)


def _close(node: tuple, d: int, least: int, out: list) -> None:
    if node[3] >= least or node[4] > d:
        out.append((node[1], node[2], node[3]))


def _phrases(rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "f"])


def phrase_counts(docs: DataFrame, least: int = 30, depth: int = DEPTH, lang_col: str = "lang", text_col: str = "text",
                  group_rows: int = GROUP_ROWS, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of every phrase of 1 to ``depth`` words with f >= ``least``, and (lang, n) of all words.

    Edge cases as in ``collocations``.
    """
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = src.mapInArrow(_count_words, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    with text_batches(docs.sparkSession):
        words = cut(counted, "words")
    totals = cut(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    frequent = words.where(F.col("f") >= least)
    one = sc.broadcast(_bloom(frequent.select("lang", "phrase").mapInArrow(_word_hashes, "h long"), filter_bits))
    # counted by the million already: most pairs are rare, so another count before the shuffle would merge next to nothing
    pairs = src.mapInArrow(partial(_count_pairs, shared=one, bits=filter_bits), "h long, f long").repartition("h")
    pairs = pairs.groupBy("h").agg(F.sum("f").alias("f"))
    with text_batches(docs.sparkSession):
        shared = sc.broadcast(_bloom(pairs.where(F.col("f") >= least).select("h"), filter_bits))
        one.unpersist()
        suffixes = cut(src.mapInArrow(partial(_suffixes, shared=shared, bits=filter_bits, depth=depth), "lang string, suffix string, times long"), "suffixes", codec="zstd")
    routed = _extended(suffixes, words, depth)
    groups = max(1, -(-suffixes.count() // group_rows))
    dealt = routed.repartition(groups, "lang", F.expr("substring_index(suffix, ' ', depth)"))
    # any order of the two-word subtrees will do: a number first, as languages hardly tell rows apart
    ordered = dealt.withColumn("two", F.xxhash64("lang", _prefix(2))).sortWithinPartitions("two", "lang", "suffix").drop("two")
    nodes = ordered.mapInArrow(partial(_read_counts, depth=depth, least=least), "lang string, phrase string, f long")
    nodes = nodes.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    single = frequent.select("lang", F.rtrim("phrase").alias("phrase"), "f")
    return cut(single.unionByName(nodes), "phrases"), totals


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, depth: int = DEPTH, lang_col: str = "lang",
                 text_col: str = "text", group_rows: int = GROUP_ROWS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` collocations of every language.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces, and pieces at blanks and tabs into words. A
    candidate is a phrase of 2 to ``depth`` words with a = f(phrase) >= ``least``. Cut after k words it scores
    floor(2000000 a / (f(first) + f(rest))); its lowest cut counts, the smallest k on ties. Candidates whose words lie
    within a longer candidate of at least 80 % of their count are dropped. Products are decimals of 38 digits.

    Edge cases: null texts are empty, a null language is ``und``; a very long text is a block of its own; every
    row counts, repeated rows each; equal scores go by a, then by the phrase's UTF-8 bytes; an empty table gives
    an empty result. Other columns are not read, whatever their names.
    """
    phrases, totals = phrase_counts(docs, least, depth, lang_col, text_col, group_rows, filter_bits)
    parts = phrases.withColumn("w", F.split("phrase", " "))
    several = parts.where(F.size("w") > 1).select("lang", "phrase", F.col("f").alias("a"), "w")
    f = lambda name, out: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(out))
    cuts = several.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("head"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("rest"))
    cuts = join_counted(join_counted(cuts, cut(f("head", "l"), "heads"), ["lang", "head"]), cut(f("rest", "r"), "rests"), ["lang", "rest"])
    score = F.expr("cast((cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0))) as bigint)")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner = F.expr("""flatten(transform(sequence(2, size(w) - 1), m ->
        transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))""")
    within = several.where(F.size("w") > 2).select("lang", "a", F.explode(inner).alias("phrase"))
    within = cut(within.groupBy("lang", "phrase").agg(F.max("a").alias("longer")), "within")
    kept = join_counted(scored, within, ["lang", "phrase"], "left").where(
        F.expr("longer is null or cast(longer as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * 80"))
    kept = join_counted(kept.select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r"), totals, ["lang"])
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = kept.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALT))).orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
