r"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a predicate that rejects a text. On a small sample every rule is timed and its
rejections are counted; the cascade then asks the rules in the order of rejections per
cost, and a row stops at the first rule that rejects it. The order decides the work, never
the verdict: a row is kept when no rule rejects it.

Words are maximal runs of ``[^\x20\x09-\x0D]``.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows, and characters of each, that costs and selectivities are estimated on, and how often each row is
#: asked for a time that can be measured. The estimate orders the rules and changes no result.
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_TIMES = 200, 2_000, 4
#: Seconds up to twice which costs are equal.
LEAST_S = 0.05

# Character classes of the base counts, as Java patterns.
WORD = r"[^\\x20\\x09-\\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"


@dataclass(frozen=True)
class Rule:
    """A named predicate, true for texts to reject. It may use the text and the base counts."""

    name: str
    reject: Column


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (long).

    * word_chars: code points in words; n_symbols: characters of ``#*$%&|<>``;
    * n_lines: lines with a word; n_dup_lines: those equal to an earlier line;
    * n_repeat_words: words inside 3-word windows that occur twice or more in the text.

    A null text counts as empty. Repeats are found by sorting window hashes with their
    positions (linear space, whatever the text's length); equal hashes are compared as words, so
    the count is exact. Input columns of these names are replaced.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    kept = [c for c in docs.columns if c not in own]
    d = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    base = [f"c{i}" for i in range(len(kept))]
    d = d.select(
        *base,
        F.expr(f"regexp_extract_all(t, '{WORD}+', 0)").alias("w"),
        F.expr(f"filter(split(t, '\\n'), l -> l rlike '{WORD}')").alias("l"),
        F.expr(f"length(t) - length(regexp_replace(t, '{WORD}+', ''))").alias("chars"),
        F.length(F.regexp_replace("t", NOT_SYMBOL, "")).alias("symbols"),
    )
    d = d.select(
        *base, "w", F.size("w").alias("n"), "chars", "symbols",
        F.size("l").alias("lines"), (F.size("l") - F.size(F.array_distinct("l"))).alias("again"),
        F.expr("int(floor(log2(greatest(size(w), 1)))) + 1").alias("b"),
    )
    # hash of each window in the upper bits, its position in the lower ones
    d = d.select(
        *base, "w", "n", "chars", "symbols", "lines", "again", "b",
        F.expr("""sort_array(slice(transform(w, (x, i) -> shiftleft(xxhash64(x, get(w, i + 1), get(w, i + 2)), b) | i),
                                   1, greatest(n - 2, 0)))""").alias("s"),
    )
    d = d.select(
        *base, "w", "n", "chars", "symbols", "lines", "again", "b",
        F.expr("""transform(filter(s, (x, i) -> shiftright(x, b) = shiftright(get(s, i + 1), b)
                                             or shiftright(x, b) = shiftright(get(s, i - 1), b)),
                            x -> int(x & (shiftleft(1L, b) - 1)))""").alias("p"),
    )
    # windows of equal hashes, in the order of their words
    d = d.select(
        *base, "n", "chars", "symbols", "lines", "again",
        F.expr("sort_array(transform(p, i -> struct(get(w, i) as x, get(w, i + 1) as y, get(w, i + 2) as z, i as i)))").alias("g"),
    )
    same = "(a.x = b.x and a.y = b.y and a.z = b.z)"
    d = d.select(
        *base, "n", "chars", "symbols", "lines", "again",
        F.expr(f"""sort_array(transform(filter(g, (a, i) -> exists(array(get(g, i - 1), get(g, i + 1)), b -> {same})), a -> a.i))""").alias("r"),
    )
    repeats = """aggregate(r, struct(0 as until, 0 as total),
        (a, p) -> struct(p + 3 as until, a.total + p + 3 - greatest(p, a.until) as total), a -> a.total)"""
    # adding nothing, but not deterministic: a filter on a count is not pushed below the steps above, where
    # their expressions would be put into one another and evaluated again for every element
    nothing = F.monotonically_increasing_id().bitwiseAND(F.lit(0))
    return d.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)],
        *[(F.expr(e).cast("long") + nothing).alias(c) for c, e in zip(own, ("n", "chars", "symbols", "lines", "again", repeats))],
    )


def base_rules() -> tuple[Rule, ...]:
    """Rules of the base verdict."""
    return (
        Rule("few_words", F.expr("n_words < 50")),
        Rule("repeated_windows", F.expr("100 * n_repeat_words > 50 * n_words")),
    )


def text_rules(text_col: str = "text") -> tuple[Rule, ...]:
    """Further rules: signs, repeated lines, word lengths, shouting."""
    return (
        Rule("symbols", F.expr("4 * n_symbols > n_words")),
        Rule("repeated_lines", F.expr("n_lines >= 4 and 2 * n_dup_lines > n_lines")),
        Rule("word_length", F.expr("word_chars < 2 * n_words or word_chars > 15 * n_words")),
        # at least half of the ASCII letters are capitals
        Rule("capitals", F.expr(
            f"2 * length(regexp_replace(`{text_col}`, '[^A-Z]+', '')) > length(regexp_replace(`{text_col}`, '[^A-Za-z]+', ''))")),
        # at least one word in four ends in an exclamation or question mark
        Rule("exclamations", F.expr(f"4 * regexp_count(`{text_col}`, '[!?][!?]+') > n_words")),
    )


def rule_costs(sample: DataFrame, rules: tuple[Rule, ...], text_col: str = "text", runs: int = 2) -> list[int]:
    """Cost of each rule on the texts ``sample``, as the power of two in ``LEAST_S``.

    A rule is charged for all it needs from the raw text on, so for its counts too: the columns that
    it does not read are pruned. Rules take turns, the shortest of ``runs`` times less that of a job that only
    reads the texts counts, and only its power of two is kept, so that the noise of a job seldom decides.
    """
    asked = [F.col(f"`{text_col}`").isNull(), *(r.reject for r in rules)]
    best = [float("inf")] * len(asked)
    for turn in range(runs + 1):
        for i, predicate in enumerate(asked):
            # a new plan each time: one that has run keeps its shuffled rows
            job = (base_counts(sample, text_col) if i else sample).agg(F.count(F.when(predicate, 1)))
            began = time.perf_counter()
            job.collect()
            # the first turn only compiles
            best[i] = min(best[i], time.perf_counter() - began if turn else best[i])
    return [int(math.log2(max(t - best[0], LEAST_S) / LEAST_S)) for t in best[1:]]


def order_rules(patterns: dict[tuple[bool, ...], int], costs: list[int]) -> list[int]:
    """Places of the rules by rejections per cost, best first; equal ones keep their order.

    ``patterns`` counts sample rows by what each rule says of them. After each choice only rows that no
    chosen rule rejects are counted: a rule that rejects what another already does goes late.
    """
    left, order = dict(patterns), []
    while len(order) < len(costs):
        hits = {i: sum(n for said, n in left.items() if said[i]) for i in range(len(costs)) if i not in order}
        best = max(hits, key=lambda i: (hits[i] / 2 ** costs[i], -i))
        order.append(best)
        left = {said: n for said, n in left.items() if not said[best]}
    return order


def measured_order(sample: DataFrame, rules: tuple[Rule, ...], text_col: str = "text") -> list[Rule]:
    """``rules`` in the order of their rejections per cost on the texts ``sample``."""
    if len(rules) < 2:
        return list(rules)
    said = [F.coalesce(r.reject, F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules)]
    rows = base_counts(sample, text_col).select(*said).groupBy(*[f"r{i}" for i in range(len(rules))]).count().collect()
    patterns = {tuple(r[:-1]): r[-1] for r in rows}
    return [rules[i] for i in order_rules(patterns, rule_costs(sample, rules, text_col))]


def cascade(rules: list[Rule]) -> Column:
    """True when a rule rejects the row; rules after the first that does are not evaluated."""
    verdict = F.lit(False)
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.reject, F.lit(False)), True).otherwise(verdict)
    return verdict


def apply_rules(docs: DataFrame, text_col: str = "text", base: tuple[Rule, ...] | None = None,
                further: tuple[Rule, ...] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All rows and columns of ``docs`` with the base counts, base_failed and kept.

    base_failed is a result of its own, so every row pays for the base rules whatever the order: they are
    asked first and once, further rules only of rows that they leave. Each part is ordered by
    rejections per cost on the first ``sample_rows`` rows that a scan gives, cut to ``SAMPLE_CHARS``
    (so the driver passes on a bounded sample, and only as many partitions are read as hold it); the
    further rules are measured on sample rows that the base rules leave. The counts are results too and are
    made for every row. An empty table, or a sample that the base rules reject whole, keeps the declared order.

    Null and empty texts have zero words and fail the base rules. Very long texts are counted whole. Null ids and
    repeated rows are kept. Columns of ``docs`` named like a count, base_failed or kept are replaced.
    """
    base = base_rules() if base is None else base
    further = text_rules(text_col) if further is None else further
    taken = docs.select(F.left(F.col(f"`{text_col}`").cast("string"), F.lit(SAMPLE_CHARS))).where(F.col(f"`{text_col}`").isNotNull()).take(sample_rows)
    if taken:
        texts = F.split(F.lit("\x01".join(r[0].replace("\x01", " ") for r in taken)), "\x01")
        sample = docs.sparkSession.range(0, SAMPLE_TIMES, 1, 4).select(F.explode(texts).alias(text_col)).persist()
        passed = None
        try:
            base = measured_order(sample, tuple(base), text_col)
            passed = base_counts(sample, text_col).where(~cascade(list(base))).select(F.col(f"`{text_col}`")).persist()
            further = measured_order(passed, tuple(further), text_col)
        finally:
            sample.unpersist()
            if passed is not None:
                passed.unpersist()
    counted = base_counts(docs, text_col).withColumn("base_failed", cascade(list(base)))
    return counted.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(~cascade(list(further))))
