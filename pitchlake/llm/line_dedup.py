"""Line dedup by site-relative frequency, in DataFrame functions.

A line is boilerplate of a host when it stands on more than a share of the host's pages.
Lines are compared without white space at their ends; blank lines are never boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.scratch import BROADCAST_ROWS, cut

#: A line on more than this share of its host's pages goes.
MAX_RATIO = 0.05
#: A line on fewer pages than this never goes, however few pages the host has.
MIN_PAGES = 5

_LINES = "split(t, '\\n')"


def _key(line: str) -> str:
    """128-bit key of a line."""
    return f"unhex(md5(trim(BOTH ' \\t\\r' FROM {line})))"


def boilerplate_lines(pages: DataFrame, host: Column, text_col: str, max_ratio: float = MAX_RATIO,
                      min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, keys): keys of the lines that stand on more than ``max_ratio`` of a host's pages.

    A page counts a line once, and pages of the same text count as one page: copies of a page are no
    sign of boilerplate. A host has at most (lines a page) / ratio such lines. Counts are
    combined before each shuffle, so neither a large host nor a frequent line meets in one task.
    """
    p = pages.select(host.alias("host"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    keys = F.expr(f"array_distinct(transform(filter({_LINES}, l -> l rlike '[^ \\t\\r]'), l -> {_key('l')}))")
    lines = p.select("host", F.xxhash64("t").alias("page"), F.explode(keys).alias("key"))
    lines = lines.groupBy("host", "key").agg(F.count_distinct("page").alias("n"))
    total = p.select("host", F.xxhash64("t").alias("page")).groupBy("host").agg(F.count_distinct("page").alias("pages"))
    common = lines.where(F.col("n") >= min_pages).join(total, "host").where(F.col("n") > max_ratio * F.col("pages"))
    return common.groupBy("host").agg(F.collect_set("key").alias("keys"))


def dedup_lines(pages: DataFrame, host: Column, text_col: str = "text", max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """All rows and columns of ``pages``, the text without its host's boilerplate lines, and n_lines, n_dropped (long).

    The keys of a host are joined to its pages: broadcast if their counted number is within
    the bound of ``scratch.BROADCAST_ROWS``, else by a shuffle that adaptive execution may split.

    Edge cases: pages of a null host are left as they are; null and empty texts stay; a page all of
    whose lines go keeps its row with an empty text; equal texts of a host count as one page; an empty table gives
    an empty result. Input columns named n_lines or n_dropped are replaced.
    """
    found = cut(boilerplate_lines(pages, host, text_col, max_ratio, min_pages).where("host is not null"), "boilerplate")
    n = found.agg(F.sum(F.size("keys"))).first()[0] or 0
    found = F.broadcast(found) if n <= BROADCAST_ROWS else found.hint("merge")
    kept = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    d = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], host.alias("host"),
                     F.col(f"`{text_col}`").cast("string").alias("t")).join(found, "host", "left")
    stay = F.expr(f"filter({_LINES}, l -> not array_contains(keys, {_key('l')}))")
    d = d.withColumn("stay", F.when(F.col("keys").isNotNull() & F.col("t").isNotNull(), stay))
    text = F.when(F.col("stay").isNull(), F.col("t")).otherwise(F.array_join("stay", "\n"))
    n_lines = F.coalesce(F.size(F.expr(f"if(t is null, array(), {_LINES})")), F.lit(0)).cast("long")
    return d.select(
        *[(text if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(kept)],
        n_lines.alias("n_lines"),
        F.when(F.col("stay").isNull(), F.lit(0)).otherwise(n_lines - F.size("stay")).cast("long").alias("n_dropped"),
    )


def host_of(url: Column) -> Column:
    """Host of a URL, lower-cased; null for text that is none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))
