"""From raw documents to packed training sequences: five stages, each on all rows that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes each stage's result as Parquet under the shared
folder and reads it back for the next, so a lost executor costs the tasks of one stage.

In every stage repeated rows and rows with a null or shared ``doc_id`` are rows of their own, texts are taken
whole whatever their length, further columns travel along whatever their names, and an empty table gives an
empty result. What a null or empty text means is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.decontamination import decontaminate
from pitchlake.llm.line_dedup import dedup_lines
from pitchlake.llm.linear import crc_mod
from pitchlake.llm.ngram_join import ngram_jaccard_components
from pitchlake.llm.packing import best_fit_pack, word_count
from pitchlake.llm.quality_classifier import train_quality, with_quality
from pitchlake.llm.scratch import byte_batches, cut, join_counted, table, text_batches

#: Documents below this quality score go.
GOOD = 0.3
#: A line on more than this share of a source's documents is boilerplate (5 % is the share of the query op4_line_dedup).
BOILERPLATE = 0.01
#: Near duplicates: five-word shingles, Jaccard similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels outside the held-out fifth.

    Null, empty and wordless texts all have the score of the bias alone, so they stay or go together; equal texts
    have equal scores.
    """
    source = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = train_quality(source, table(spark, sf_dir, "labels"), train=lambda c: crc_mod(c, 5) != 0)
    good = with_quality(docs, weights).where(F.col("score") >= GOOD).select(docs.columns)
    with text_batches(spark):  # whole texts go to Python and back: written here, in small batches
        return cut(good, "good")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on too many documents of a source go; every document stays.

    Null and empty texts and documents without a source stay as they are; equal texts of a source count as one
    page. ``n_chars`` follows the texts that lose a line; further columns named n_lines or n_dropped get the counts of this stage.
    """
    kept = dedup_lines(docs, F.col("source"), max_ratio=BOILERPLATE)
    return _counted(kept, F.col("n_dropped") > 0).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest id; documents without words all stay.

    Every row is a document of its own: rows that share an id or have none are grouped by their texts like
    others, one row of a group stays, and a row without an id only where none of its group has one.
    """
    # written, so that all passes see the same keys
    docs = cut(docs.withColumn("row_key", F.monotonically_increasing_id()), "keyed")
    with byte_batches(spark):  # whole texts go to Python, and many more narrow rows
        groups = ngram_jaccard_components(docs, id_col="row_key", k=SHINGLE, percent=PERCENT)
    linked = groups.where("component_id <> row_key").select("row_key", "component_id")
    first = linked.select(F.col("component_id").alias("row_key"), "component_id").distinct()
    members = join_counted(docs.select("row_key", "doc_id"), cut(linked.union(first), "linked"), ["row_key"])
    members = cut(members, "members")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    stay = cut(members.groupBy("component_id").agg(F.min(order)["row_key"].alias("row_key")).select("row_key"), "stay")
    gone = cut(join_counted(members, stay, ["row_key"], "left_anti").select("row_key"), "near-duplicates")
    return join_counted(docs, gone, ["row_key"], "left_anti").drop("row_key")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; from the others the spans that benchmark items share are cut out.

    Null and empty texts have no words and stay; an empty benchmark changes nothing.
    """
    kept = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    kept = _counted(kept, F.col("n_chars") != F.length("text")).select(docs.columns)
    with text_batches(spark):  # as in the first stage
        return cut(kept, "clean")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of all documents in training sequences of several permitted lengths.

    One row a piece (doc_id, first, n_tokens, bin_id, position, capacity), no texts: joined by ``doc_id`` to the stage's
    input, a piece is the ``n_tokens`` words from number ``first`` on. Documents without words (null, empty) have
    one row of 0 tokens without a bin. Pieces of rows that share an id cannot be told apart by it.
    """
    return best_fit_pack(docs, word_count(F.col("text")))


def _counted(docs: DataFrame, changed) -> DataFrame:
    """n_chars follows the texts that were changed."""
    return docs.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: The classifier's training has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
