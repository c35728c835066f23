r"""Secret scans: fixed patterns, and a battery of randomness tests on strings that look encoded.

Base patterns (kinds ``assign``, ``access``, ``hex``) are found by their rules alone. The battery
looks at every other run of ``[A-Za-z0-9+/_-]`` of ``MIN_LENGTH`` or more, words and numbers too (of a run with
base patterns, what stands beside them; a run that holds both ``+/`` and ``-_`` in its parts between
them): it infers the encoding (digits, hex, letters, base32, alphanumeric, base64), and asks three questions of the run's symbols.

* Chi-squared: are the symbols of the alphabet equally frequent?
* Runs: does the order of symbols above and below the middle of the alphabet look like coin tosses?
* Serial correlation: does a symbol foretell the next?

Each answer is a z score that grows with the distance from a random string. Written language fails
the questions the more clearly the longer a string is, so the combined statistic is
compared with what text of the *same length* gives: its p-value is the chance that text of that
length looks as random. Text's own statistics are counted over all word text of the corpus, as 26 symbols
for runs of letters or digits alone and as 36 for the others. A Benjamini-Hochberg threshold for each band of lengths, from
counts of p-values over the whole corpus, holds the share of false finds below ``FDR``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import tokens

# The base patterns, on UTF-8 bytes (their letters are ASCII).
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KEYWORDS = re.compile(rb"(?i:passw|secret|token|api_?key)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

#: Shortest run that the battery tests.
MIN_LENGTH = 20
#: Share of false finds that the battery accepts.
FDR = 0.02
#: Bands of run lengths (upper bounds) with thresholds of their own.
BANDS = (24, 32, 48, 64, 128, 1 << 62)
#: Stretches of word text in the last band.
WIDEST = 256
#: Histogram cells of -log10(p), ten to a decade.
CELLS = 400

_HEX = np.zeros(256, bool)
_HEX[[*range(0x30, 0x3A), *range(0x61, 0x67)]] = True
_RUN = np.zeros(256, bool)
_RUN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *b"+/_-"]] = True


#: Part of a run of which no alphabet holds all symbols.
_PART = re.compile(rb"[A-Za-z0-9]{%d,}" % MIN_LENGTH)


def _alphabet(symbols: str) -> np.ndarray:
    table = np.full(256, -1, np.int64)
    table[list(symbols.encode())] = np.arange(len(symbols))
    return table


_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings from the narrowest on; a run has the first whose alphabet holds all its symbols. Last: the number of
#: symbols of the word text that it is compared with (more symbols make word text look less random).
ENCODINGS = (
    ("digits", _alphabet(_DIGITS), 10, 26),
    ("hex", _alphabet(_DIGITS + "abcdef"), 16, 36),
    ("HEX", _alphabet(_DIGITS + "ABCDEF"), 16, 36),
    ("lower letters", _alphabet(_LOWER), 26, 26),
    ("upper letters", _alphabet(_UPPER), 26, 26),
    ("base32", _alphabet(_UPPER + "234567"), 32, 36),
    ("lower", _alphabet(_LOWER + _DIGITS), 36, 36),
    ("upper", _alphabet(_UPPER + _DIGITS), 36, 36),
    ("letters", _alphabet(_LOWER + _UPPER), 52, 36),
    ("alnum", _alphabet(_LOWER + _UPPER + _DIGITS), 62, 36),
    ("base64", _alphabet(_UPPER + _LOWER + _DIGITS + "+/"), 64, 36),
    ("base64url", _alphabet(_UPPER + _LOWER + _DIGITS + "-_"), 64, 36),
)
#: Numbers of symbols for which word text is measured.
SIZES = (26, 36)


def statistics(x: np.ndarray, k: int) -> np.ndarray:
    """Root mean square of the three z scores of each row of symbols (numbers below ``k``)."""
    return _statistics(x, (k,))[0]


def _statistics(x: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """The statistic for each number of symbols; all of ``x`` lies below the first."""
    m, n = x.shape
    rows = np.arange(m)[:, None]
    count = np.bincount((rows * sizes[0] + x).ravel(), minlength=m * sizes[0]).reshape(m, sizes[0])
    squares = (count * count).sum(axis=1)
    c = x - x.mean(axis=1, keepdims=True)
    power = (c * c).sum(axis=1)
    z_serial = np.where(power > 0, (c[:, 1:] * c[:, :-1]).sum(axis=1) / np.maximum(power, 1e-9), 1.0) * math.sqrt(n)
    out = []
    for k in sizes:
        chi = np.maximum(squares * k / n - n, 0.0)
        # Wilson-Hilferty
        z_chi = np.maximum(((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1))), 0.0)
        high = 2 * x >= k
        n1 = high.sum(axis=1).astype(float)
        runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
        mean = 2 * (n - n1) * n1 / n + 1
        spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        z_runs = np.where((n1 > 0) & (n1 < n), (runs - mean) / spread, math.sqrt(n))
        out.append(np.sqrt((z_chi**2 + z_runs**2 + z_serial**2) / 3))
    return out


def battery(run: bytes) -> tuple[int, float] | None:
    """(encoding, statistic) of a run; None if no encoding fits, as of a run with both + or / and - or _."""
    raw = np.frombuffer(run, np.uint8)
    for e, (_, table, k, _) in enumerate(ENCODINGS):
        x = table[raw]
        if x.min() >= 0:
            return e, float(statistics(x[None, :], k)[0])
    return None


def _band(n: int) -> int:
    return next(i for i, top in enumerate(BANDS) if n <= top)


def text_p(statistic: float, length: int, mean: np.ndarray) -> float:
    """Chance that written text of this length looks as random as ``statistic``.

    ``mean`` gives, by band, the mean and deviation of the statistic of the corpus' word text.
    """
    mu, sd = mean[_band(length)]
    return max(0.5 * math.erfc((mu - statistic) / (sd * math.sqrt(2))), 1e-40)


def _base_spans(text: bytes, hexes: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(begin, kind, end) of the base finds, in bytes."""
    spans = [(a, 2, b) for a, b in hexes]
    if KEYWORDS.search(text):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= MIN_ASSIGN]
    if b"AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return sorted(spans)


def _runs_by_text(texts: tokens.Texts, member: np.ndarray, least: int) -> dict[int, list[tuple[int, int]]]:
    begin, end, owner = tokens.runs(texts, member)
    long = end - begin >= least
    out: dict[int, list[tuple[int, int]]] = {}
    for a, b, of in zip(begin[long].tolist(), end[long].tolist(), owner[long].tolist()):
        start = int(texts.starts[of])
        out.setdefault(of, []).append((a - start, b - start))
    return out


def _beside(begin: int, end: int, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What the base spans leave of a run, in pieces of MIN_LENGTH or more."""
    for a, _, b in [*base, (end, 0, end)]:
        if a >= end or b > begin:
            if min(a, end) - begin >= MIN_LENGTH:
                yield begin, min(a, end)
            begin = max(begin, b)
        if begin >= end:
            return


def _scan(column: pa.Array) -> Iterator[tuple[bytes, list[tuple[int, int, int]], list[tuple[int, int, int, float]]]]:
    """Per text: its bytes, base spans, and (begin, end, encoding, statistic) of the other tested runs."""
    for texts in tokens.blocks(column):
        hexes = _runs_by_text(texts, _HEX, MIN_HEX)
        runs = _runs_by_text(texts, _RUN, MIN_LENGTH)
        raw = texts.data.tobytes()
        for i in range(len(texts)):
            text = raw[texts.starts[i] : texts.starts[i + 1]]
            base = _base_spans(text, hexes.get(i, []))
            tested = []
            for a, b in runs.get(i, []):
                for x, y in _beside(a, b, base):
                    if found := battery(text[x:y]):
                        tested.append((x, y, *found))
                        continue
                    for part in _PART.finditer(text, x, y):
                        tested.append((*part.span(), *battery(part[0])))
            yield text, base, tested


def _measure(letters: np.ndarray, band: int, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """By size, number, sum and sum of squares of the statistic of all stretches of the band's length; the letters left."""
    n = min(BANDS[band], WIDEST)
    whole = len(letters) // n * n
    if not whole:
        return np.zeros((len(sizes), 3)), letters
    found = _statistics(letters[:whole].reshape(-1, n), sizes)
    return np.array([(len(x), x.sum(), (x * x).sum()) for x in found]), letters[whole:]


def _text_moments(batches: Iterator[pa.RecordBatch], sizes: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """By band and size of alphabet: number, sum and sum of squares of the statistic of word text of such lengths, and the letters left.

    Word text is what all texts give when the letters of their words are run together; for every band, all of
    it is cut into stretches of the band's length, over the bounds of blocks. Less than a stretch is left.
    """
    total = np.zeros((len(BANDS), len(sizes), 3))
    rest = [np.empty(0, np.int64)] * len(BANDS)
    table = _alphabet(_LOWER + _DIGITS)
    for batch in batches:
        for texts in tokens.blocks(batch.column("text")):
            letters = table[texts.data | 0x20]
            letters = letters[(letters >= 0) & (letters < 26) & (texts.data < 0x80)]
            for band in range(len(BANDS)):
                sums, rest[band] = _measure(np.concatenate([rest[band], letters]), band, sizes)
                total[band] += sums
    at = [(band, i) for band in range(len(BANDS)) for i in range(len(sizes))]
    yield pa.RecordBatch.from_arrays(
        [pa.array([band for band, _ in at]), pa.array([i for _, i in at]),
         *(pa.array([total[band, i, j] for band, i in at]) for j in range(3)),
         pa.array([b"" if i else rest[band].astype(np.uint8).tobytes() for band, i in at], pa.binary())],
        names=["band", "size", "n", "s", "q", "rest"],
    )


def text_moments(texts: DataFrame, sizes: tuple[int, ...] = (36,)) -> np.ndarray:
    """By band: mean and deviation of the statistic of all word text for each size, whatever its partitions.

    What the tasks leave (less than a stretch each) is joined and measured too. One stretch of deviation 1 is
    added to the squares, so few stretches give no deviation near 0; a band longer than all
    word text has the moments of the band below, and only text without a stretch of the first band (4, 1).
    """
    seen = texts.mapInArrow(partial(_text_moments, sizes=sizes), "band long, size long, n double, s double, q double, rest binary")
    # each task's row has less than WIDEST bytes of rest
    seen = seen.groupBy("band", "size").agg(F.sum("n"), F.sum("s"), F.sum("q"), F.array_sort(F.collect_list("rest")))
    found = {(r[0], r[1]): r[2:] for r in seen.collect()}
    moments = np.tile([4.0, 1.0], (len(BANDS), len(sizes)))
    for band in range(len(BANDS)):
        moments[band] = moments[max(band - 1, 0)]
        if (band, 0) not in found:
            continue
        more, _ = _measure(np.frombuffer(b"".join(found[band, 0][3]), np.uint8).astype(np.int64), band, sizes)
        for i in range(len(sizes)):
            n, s, q = np.array(found[band, i][:3]) + more[i]
            if n:
                moments[band, 2 * i : 2 * i + 2] = s / n, max(math.sqrt((max(q - s * s / n, 0.0) + 1) / n), 0.25)
    return moments


def _cell_of(length: int, encoding: int, statistic: float, moments: np.ndarray) -> int:
    """Cell of the p-value of a tested run."""
    i = SIZES.index(ENCODINGS[encoding][3])
    return _cell(text_p(statistic, length, moments[:, 2 * i : 2 * i + 2]))


def _p_counts(batches: Iterator[pa.RecordBatch], moments: np.ndarray) -> Iterator[pa.RecordBatch]:
    cells = np.zeros(len(BANDS) * CELLS, np.int64)
    for batch in batches:
        for _, _, tested in _scan(batch.column("text")):
            for a, b, e, statistic in tested:
                cells[_band(b - a) * CELLS + _cell_of(b - a, e, statistic, moments)] += 1
    at = np.flatnonzero(cells)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[at])], names=["cell", "n"])


def _cell(p: float) -> int:
    return min(int(-10 * math.log10(p)), CELLS - 1)


def thresholds(counts: np.ndarray, fdr: float = FDR) -> list[int]:
    """By band: the lowest cell of -log10(p) that is accepted (Benjamini-Hochberg on cell bounds)."""
    out = []
    for cells in counts.reshape(len(BANDS), CELLS):
        m, rank, least = cells.sum(), 0, CELLS
        for cell in range(CELLS - 1, -1, -1):
            rank += cells[cell]
            # every p in the cell is at most 10 ** (-cell / 10)
            if cells[cell] and 10 ** (-cell / 10) * m <= fdr * rank:
                least = cell
        out.append(least)
    return out


def _find(batches: Iterator[pa.RecordBatch], moments: np.ndarray, least: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts, ends, kinds = [], [], []
        for text, base, tested in _scan(batch.column("text")):
            spans = base + [
                (a, 3, b) for a, b, e, statistic in tested if _cell_of(b - a, e, statistic, moments) >= least[_band(b - a)]
            ]
            spans.sort()
            points = _code_points(text, spans)
            starts.append([points[a] for a, _, _ in spans])
            ends.append([points[b] for _, _, b in spans])
            kinds.append([KINDS[k] for _, k, _ in spans])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(kinds, pa.list_(pa.string())), pa.array(starts, pa.list_(pa.int64())),
             pa.array(ends, pa.list_(pa.int64()))],
            names=["id", "kinds", "starts", "ends"],
        )


def _code_points(text: bytes, spans: list[tuple[int, int, int]]) -> dict[int, int]:
    """Byte offsets of the spans as code point offsets."""
    out, at, points = {}, 0, 0
    for place in sorted({x for a, _, b in spans for x in (a, b)}):
        points += len(text[at:place].decode("utf-8", "replace"))
        out[place] = points
        at = place
    return out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """(id, kinds, starts, ends): parallel arrays of the finds of each whole text, by start, then kind.

    Offsets count code points, ends are exclusive. The kinds are assign, access, hex and random;
    a random find never overlaps another one. The driver receives a few numbers a length band, and under 256
    letters a band of each task.

    Edge cases: null and empty texts have no finds; null and repeated ids keep their rows; an empty
    table gives an empty result. Other columns are not read, so their names cannot clash.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = src.select("text")
    moments = text_moments(texts, SIZES)
    cells = texts.mapInArrow(partial(_p_counts, moments=moments), "cell long, n long")
    counts = np.zeros(len(BANDS) * CELLS, np.int64)
    for cell, n in cells.groupBy("cell").agg(F.sum("n")).collect():
        counts[cell] = n
    found = src.mapInArrow(
        partial(_find, moments=moments, least=thresholds(counts, fdr)),
        f"id {src.schema['id'].dataType.simpleString()}, kinds array<string>, starts array<long>, ends array<long>",
    )
    return found.withColumnRenamed("id", id_col)
