"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from pitchlake.llm import oracle
from pitchlake.llm.arc import pages_to_warc
from pitchlake.llm.collocations import collocations
from pitchlake.llm.decontamination import benchmark_hits, with_verdict
from pitchlake.llm.language_id import predict_language, train_language
from pitchlake.llm.lexical_search import ranked_search
from pitchlake.llm.line_dedup import dedup_lines
from pitchlake.llm.linear import crc_mod
from pitchlake.llm.ngram_join import ngram_jaccard_components
from pitchlake.llm.packing import best_fit_pack, word_count
from pitchlake.llm.quality_classifier import score_quality, train_quality
from pitchlake.llm.quality_rules import apply_rules
from pitchlake.llm.scratch import table
from pitchlake.llm.secrets import scan_secrets
from pitchlake.llm.toxicity import toxicity_scores
from pitchlake.llm.window_packing import pack_windows, with_crc32

#: A document counts as good from this score on.
GOOD = 0.3


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = train_quality(docs, table(spark, sf_dir, "labels"), train=lambda c: crc_mod(c, 5) != 0)
    return score_quality(docs, weights).select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of the rule cascade for every document."""
    docs = apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets reach a Jaccard similarity of 0.9."""
    return ngram_jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return dedup_lines(docs, F.col("source")).select("doc_id", "n_lines", "n_dropped", "text")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words in bins of several permitted lengths."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return best_fit_pack(docs, word_count(F.col("text")))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base counts, a digest of the base spans, and all spans."""
    found = scan_secrets(table(spark, sf_dir, "documents"))
    spans = F.arrays_zip("kinds", "starts", "ends")
    listed = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kinds"], x["starts"], x["ends"])), ",")
    count = lambda kind: F.size(F.filter("kinds", lambda k: k == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(listed(F.filter(spans, lambda x: x["kinds"] != "random")), 256).alias("base_sha256"),
        listed(spans).alias("spans"), count("random").alias("n_random"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the two thirds that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train_language(docs, train=lambda c: crc_mod(c, 3) != 1)
    return predict_language(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score"
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = toxicity_scores(docs, table(spark, sf_dir, "labels"), train=lambda c: crc_mod(c, 5) != 0)
    return scores.select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 13 words in every document, and the verdict at one hit word in 20."""
    hits = with_verdict(benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op10_legacy_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through an ARC archive and its WARC conversion, as read back."""
    found = pages_to_warc(spark, table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of every language."""
    return collocations(table(spark, sf_dir, "documents"))


def op13_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in windows of 1,024."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    return with_crc32(pack_windows(docs, files[0], ranks=files[1], as_bytes=True))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_quality_classifier, op2_quality_rules, op3_ngram_jaccard_join, op4_line_dedup, op5_best_fit_packing,
            op6_secret_scan, op7_language_id, op8_toxicity, op9_decontamination, op10_legacy_archives, op11_ranked_search, op12_collocations, op13_window_packing,
        )
    } | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that have one; corpus_pipeline.ORACLE_SQL would join them if the pipeline had one."""
    return oracle.oracle_sql() | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
