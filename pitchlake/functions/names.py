"""Abbreviated player/team name resolution as native array expressions.

The sorted per-match list of full names is turned once, at aggregation time,
into a *name index*: parallel arrays of the names, their upper-case forms,
initials, upper-case-word initials, last words and word lists. Resolving a
short name then costs a handful of ``array_position`` scans (native loops,
no lambda) plus two guarded ``transform`` scans for the prefix and multi-word
rules: no Python worker and no per-candidate string splitting.

Resolution of ``short`` against the list:

* NULL/empty short name, NULL/empty list, exact (case-sensitive) member of the
  list, or text containing "Super Over" -> ``short`` unchanged;
* a known team abbreviation whose full name is in the list (case-insensitive)
  -> that list element;
* otherwise the first name, in list order, meeting any of
  (a) all initials equal the short name, (b) the initials of the upper-case
  words equal it when they differ from (a), (c) one-word short name of length
  >= 2 that prefixes the name, (d) one-word short name equal to the last word,
  (e) a short name of N >= 2 words equal to the last N of more words.
  Each rule yields the position of its first matching name; the smallest
  position wins, which is exactly "first name meeting any rule";
* no match -> ``short`` unchanged.

All comparisons after the exact-member test are upper-cased. Lists are sorted,
so the result is a function of the list's content, not of arrival order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake import constants as K

# Characters matched by \s in the parsing patterns.
_WS = " \t\n\r\f\u000b"


def _abbreviations() -> Column:
    return F.create_map(*[F.lit(x) for kv in K.TEAM_ABBREVIATIONS.items() for x in kv])


def strip_ws(c: Column) -> Column:
    """Remove leading/trailing whitespace (no regex)."""
    return F.btrim(c, F.lit(_WS))


def words(c: Column) -> Column:
    """Whitespace-separated words, without empty tokens."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != F.lit(""))


def _first_char(w: Column) -> Column:
    return F.substring(w, 1, 1)


def _is_upper(ch: Column) -> Column:
    return (F.upper(ch) == ch) & (F.lower(ch) != ch)


def name_index(names: Column) -> Column:
    """Match keys of a sorted array of names, as parallel arrays (built once per match)."""
    parts = F.transform(names, words)
    initials = F.transform(parts, lambda p: F.upper(F.array_join(F.transform(p, _first_char), "")))
    upper_initials = F.transform(parts, lambda p: F.upper(F.array_join(
        F.transform(F.filter(p, lambda w: _is_upper(_first_char(w))), _first_char), "")))
    return F.struct(
        names.alias("names"),
        F.transform(names, F.upper).alias("upper"),
        initials.alias("initials"),
        # rule (b) only counts where it differs from rule (a): NULL never matches
        F.zip_with(upper_initials, initials,
                   lambda u, i: F.when(u != i, u)).alias("upper_initials"),
        F.transform(parts, lambda p: F.upper(F.get(p, F.size(p) - 1))).alias("last_word"),
        F.transform(parts, lambda p: F.transform(p, F.upper)).alias("words"),
    )


def collect_name_index(name: Column) -> Column:
    """Aggregate expression: sorted distinct names of a group, indexed."""
    return name_index(F.sort_array(F.collect_set(name)))


def index_names(index: Column) -> Column:
    return index.getField("names")


def _position(arr: Column, key: Column) -> Column:
    """1-based position of ``key`` in ``arr``; NULL when absent."""
    return F.nullif(F.array_position(arr, key), F.lit(0)).cast("int")


def resolve_name(short: Column, index: Column) -> Column:
    """Full name for ``short`` from a name index (see module docstring)."""
    stripped = strip_ws(short)
    key = F.upper(stripped)
    # word count of stripped text: no empty tokens except for "" itself (no lambda needed)
    n_words = F.when(stripped == "", F.lit(0)).otherwise(F.size(F.split(stripped, r"\s+")))
    one_word = n_words == 1
    names = index.getField("names")

    by_abbreviation = F.try_element_at(
        names, _position(index.getField("upper"), F.upper(F.try_element_at(_abbreviations(), key))))

    # The two rules that need a per-candidate test get the row's keys bound
    # once (array_repeat), so the lambdas never re-evaluate them per candidate.
    def per_candidate(arr: Column, keys: Column, test) -> Column:
        return _position(F.zip_with(arr, F.array_repeat(keys, F.size(arr)), test), F.lit(True))

    prefix = F.when(one_word & (F.length(stripped) >= 2), per_candidate(
        index.getField("upper"), key, lambda u, k: F.startswith(u, k)))
    tail = F.when(n_words >= 2, per_candidate(
        index.getField("words"), F.struct(key.alias("k"), n_words.alias("n")),
        lambda w, kn: (F.size(w) > kn["n"])
        & (F.array_join(F.slice(w, -kn["n"], kn["n"]), " ") == kn["k"])))
    first_hit = F.least(
        _position(index.getField("initials"), key),
        _position(index.getField("upper_initials"), key),
        prefix,
        F.when(one_word, _position(index.getField("last_word"), key)),
        tail,
    )
    by_pattern = F.try_element_at(names, first_hit)

    return (
        F.when(short.isNull() | (short == ""), short)
        .when(index.isNull() | (F.size(names) == 0), short)
        .when(F.array_contains(names, short) | short.contains(K.SUPER_OVER), short)
        .otherwise(F.coalesce(by_abbreviation, by_pattern, short))
    )


def resolve_columns(df: DataFrame, targets: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds ``out = resolve_name(short, index)`` for each ``out -> (short, index)``."""
    return df.withColumns({
        out: resolve_name(F.col(short), F.col(index)) for out, (short, index) in targets.items()
    })


def resolve_in_list(short: Column, names: Column) -> Column:
    """Convenience form taking a plain array of names (index built on the fly)."""
    return resolve_name(short, F.when(names.isNotNull(), name_index(F.sort_array(names))))
