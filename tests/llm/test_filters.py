"""Quality classifier, quality rules, language identification, toxicity."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.llm import language_id, linear, queries, toxicity
from pitchlake.llm.language_id import UNKNOWN, predict_language, train_language
from pitchlake.llm.quality_classifier import score_quality, train_quality, with_quality
from pitchlake.llm.quality_rules import (
    Rule,
    apply_rules,
    base_counts,
    base_rules,
    cascade,
    measured_order,
    order_rules,
    text_rules,
)

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "x"), (4, "x"), (None, "one two three"), (5, "é " * 70_000), (6, "a b c a b c a b c")]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    # columns whose names an operator could use itself
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(("id", "score", "key", "c0", "t", "n", "w", "n_words", "label", "node"))])


def _auc(y, s):
    y, rank = np.array(y), np.argsort(np.argsort(s)) + 1
    p = y.sum()
    return (rank[y == 1].sum() - p * (p + 1) / 2) / (p * (len(y) - p))


def test_held_out_quality(spark):
    got = queries.op1_quality_classifier(spark, SF)
    assert got.count() == 1000 and got.where("score < 0 or score > 1 or score is null").count() == 0
    rows = got.where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert _auc([r.quality for r in rows], [r.score for r in rows]) > 0.85
    assert all(r.predicted == 1 for r in rows if r.quality == 1)
    assert got.where("predicted <> if(score >= 0.3, 1, 0)").count() == 0


def test_quality_edge_cases(spark, odd):
    labels = spark.createDataFrame([(4, 1), (6, 0), (6, 1), (None, 1), (9, None)], "doc_id long, quality int")
    w = train_quality(odd, labels)
    got = score_quality(odd, w)
    assert got.count() == len(ODD) and set(got.columns) == set(odd.columns) - {"text"}
    empty = {r.score for r in got.where("doc_id in (1, 2, 3)").collect()}
    assert len(empty) == 1
    assert with_quality(odd, w).where("text = 'x'").select("score").distinct().count() == 1
    nothing = odd.limit(0)
    assert score_quality(nothing, train_quality(nothing, labels.limit(0))).count() == 0
    assert not train_quality(odd, labels.limit(0)).any()


def test_training_is_bounded_and_leaves_ids_out(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    keep = lambda c: linear.crc_mod(c, 5) != 0
    sample = linear.labelled_sample(docs, labels, "doc_id", "text", "quality", keep, 30)
    assert sample.count() == 30
    assert sample.where(linear.crc_mod(F.col("key"), 5) == 0).count() == 0


def test_ftrl_learns_and_stays_sparse():
    cfg = linear.Ftrl(bits=6, l1=0.05, epochs=5)
    rng = np.random.default_rng(1)
    examples = []
    for _ in range(400):
        y = int(rng.random() < 0.5)
        idx = np.unique(np.append(rng.integers(10, 60, 5), 1 if y else 2))
        examples.append((idx, np.ones(len(idx)), y))
    w = linear.train_examples(examples, cfg)
    assert w[1] > 1 and w[2] < -1 and (w == 0).sum() > 4


def _base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    times = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_base_counts_match_brute_force(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    for r in base_counts(docs).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == _base(r.text), r.doc_id


def test_rules_edge_cases_and_order(spark, odd):
    got = apply_rules(odd)
    assert got.count() == len(ODD) and got.where("kept is null or base_failed is null").count() == 0
    assert got.where("base_failed and kept").count() == 0
    assert apply_rules(odd.limit(0)).count() == 0
    sample = spark.range(20_000).select(F.concat(F.lit("w "), F.col("id")).alias("text"))
    slow = Rule("slow", F.length(F.regexp_replace(F.repeat("text", 200), "[aeiou]+", "")) < 0)
    fast = Rule("fast", F.col("n_words") > 1)
    assert [r.name for r in measured_order(sample, (slow, fast))] == ["fast", "slow"]
    both = base_counts(sample).select(cascade([slow, fast]).alias("a"), cascade([fast, slow]).alias("b"))
    assert both.where("a <> b").count() == 0
    unknown = spark.createDataFrame([(None,)], "n_words long")
    assert unknown.select(cascade([base_rules()[0]]).alias("x")).first().x is False


def test_order_by_rejections_per_cost():
    # the second rule rejects what the first does, and less; the third is dear
    patterns = {(True, True, False): 6, (True, False, False): 2, (False, False, True): 5, (False, False, False): 9}
    assert order_rules(patterns, [0, 0, 0]) == [0, 2, 1]
    assert order_rules(patterns, [3, 0, 0]) == [1, 2, 0]
    assert order_rules(patterns, [0, 0, 9]) == [0, 2, 1]
    assert order_rules({}, [2, 0, 1]) == [0, 1, 2]


def test_costs_include_the_counts(spark):
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: F.concat(F.lit("word"), i * F.col("id"))), " ")
    sample = spark.range(2_000).select(text.alias("text")).persist()
    dear = Rule("dear", F.expr("n_repeat_words >= 0"))
    cheap = Rule("cheap", F.expr("n_symbols >= 0"))
    orders = [[r.name for r in measured_order(sample, (dear, cheap))] for _ in range(3)]
    assert orders == [["cheap", "dear"]] * 3


def test_later_rules_are_not_asked_of_rejected_rows(spark):
    long_text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, "short"), (2, long_text), (3, long_text + " #"), (4, None)], "doc_id long, text string")
    asked = lambda reason: F.raise_error(F.lit(reason)).cast("boolean")
    late = Rule("late", F.when(F.col("n_words") < 50, asked("asked of a row that the base rules reject")).otherwise(F.col("n_symbols") > 0))
    got = {r.doc_id: (r.base_failed, r.kept) for r in apply_rules(docs, further=(late,)).collect()}
    assert got == {1: (True, False), 2: (False, True), 3: (False, False), 4: (True, False)}
    got = {r.doc_id: r.kept for r in apply_rules(docs, further=(*text_rules(), late)).collect()}
    assert got[1] is False and got[2] is True


def test_no_python_in_the_rules_plan(spark):
    plan = queries.op2_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rules_keep_good_documents(spark):
    got = queries.op2_quality_rules(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    assert got.where("quality = 1 and not base_failed and not kept").count() == 0


def test_language_held_out(spark):
    got = queries.op7_language_id(spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_batches_equal_single_texts(monkeypatch):
    """N-grams and sums of a batch are those of each text alone, at any chunk size."""
    texts = ["", "12 !", "Straße und Weg.", " a", "İI ΣΑΣ", "x" * 50, "--", "le 3 la\x00les", "é", ""]
    rng = np.random.default_rng(3)
    model = language_id.Model(["a", "b", "c"], rng.normal(size=(1 << language_id.BITS, 3)).astype(np.float32), np.log([0.5, 0.3, 0.2]))
    buckets, owner = language_id.ngram_buckets(texts)
    alone = [language_id.ngram_buckets([t])[0] for t in texts]
    for i, one in enumerate(alone):
        plain = " " + re.sub(r"[^a-zßéσςαi̇]+", " ", texts[i].lower().replace("\u0307", " ")).strip() + " "
        assert len(one) == (0 if not plain.strip() else sum(len(plain) - n + 1 for n in language_id.SIZES))
        assert sorted(one) == sorted(buckets[owner == i])
    for chunk in (1 << 17, 7):
        monkeypatch.setattr(language_id, "CHUNK", chunk)
        got = language_id._log_likelihoods(model, buckets, owner, len(texts))
        for i, one in enumerate(alone):
            assert np.allclose(got[i], model.prior + model.ngram[one].sum(axis=0, dtype=float))


def test_language_training_is_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text"), F.when(F.col("id") < 2990, "xx").otherwise("yy").alias("lang"))
    model = train_language(docs, max_train=100)
    prior = np.exp(model.prior)
    assert model.languages == ["xx", "yy"] and np.allclose(prior, np.array([101, 11]) / 112)
    # the documents of smallest id hash are learned, so other rows change nothing
    again = train_language(docs.where("doc_id >= 0").repartition(7), max_train=100)
    assert np.array_equal(again.ngram, model.ngram) and train_language(docs.limit(0)).languages == []


def test_language_edge_cases(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = train_language(docs)
    extra = spark.createDataFrame([(7, "12345 !?"), (8, "ß" * 10)], "doc_id long, text string")
    got = predict_language(odd.select("doc_id", "text").union(extra), model)
    by = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(ODD) + 2
    assert all(by[i].lang_pred == UNKNOWN for i in (1, 2, 3, 7)) and by[8].lang_pred == "de"
    assert predict_language(docs.limit(0), model).count() == 0
    none = train_language(docs.withColumn("lang", F.lit(None).cast("string")))
    assert predict_language(extra, none).where(f"lang_pred <> '{UNKNOWN}'").count() == 0


def test_deobfuscation(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text")
    model = toxicity.character_model(docs)
    for seen, meant in {"m0r0n": "moron", "s t u p i d": "stupid", "s.c.u.m": "scum", "cl0wnnnn": "clown", "d1sgu5ting": "disgusting"}.items():
        assert toxicity.decode(seen, model) == meant
    import pyarrow as pa

    from pitchlake.llm import tokens
    plain = ["The good words stay. Änd Zwölf!!!", "a", "", "x m0r0n y s t u p i d z", "nothing here"]
    (block,) = tokens.blocks(pa.array(plain))
    out = toxicity.restored(block, model, {})
    texts = [out.data[out.starts[i] : out.starts[i + 1]].tobytes().decode() for i in range(len(plain))]
    assert texts[0] == plain[0] and texts[1:3] == plain[1:3] and texts[4] == plain[4]
    assert "moron" in texts[3] and "stupid" in texts[3].replace("  ", " ")
    shapes = ["id-iot", "stuupid", "iddiot", "i/d/i/o/t", "stu.pid", "s\nt\nu\np\ni\nd", "m\to\tr\to\tn", "MOROON"]
    (block,) = tokens.blocks(pa.array([f"they {s} went" for s in shapes]))
    out = toxicity.restored(block, model, {})
    read = [out.data[out.starts[i] : out.starts[i + 1]].tobytes().decode().split() for i in range(len(shapes))]
    assert read == [["they", w, "went"] for w in ("idiot", "stupid", "idiot", "idiot", "stupid", "stupid", "moron", "moron")]


def test_tokens_left_out_read_as_written(spark):
    """What the array test leaves out, the search would leave as it is."""
    import pyarrow as pa

    from pitchlake.llm import tokens
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text")
    model = toxicity.character_model(docs)
    words = sorted({w for r in docs.collect() for w in (r.text or "").split() if w.isalpha() and w.isascii()})
    joined = [f"{a}-{b}" for a, b in zip(words, words[7:]) if len(a) > 1 < len(b)][:400]
    for word in words[:3000] + joined:
        (block,) = tokens.blocks(pa.array([word]))
        if not toxicity._suspects(block, model):
            assert toxicity.decode(word, model) == word.lower()


def test_toxicity_held_out_and_disguised(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    clean = docs.join(labels.where("toxic = 0"), "doc_id").where("length(text) between 500 and 900").select("text").orderBy("doc_id").limit(20)
    planted = clean.select(F.concat("text", F.lit(" m0r0n and 1d1ot and s t u p i d and cl0wnnn")).alias("text"))
    planted = planted.select((-1 - F.monotonically_increasing_id()).alias("doc_id"), "text")
    got = toxicity.toxicity_scores(docs.union(planted), labels, train=lambda c: linear.crc_mod(c, 5) != 0)
    rows = got.join(labels, "doc_id").where(linear.crc_mod(F.col("doc_id"), 5) == 0).collect()
    assert _auc([r.toxic for r in rows], [r.score for r in rows]) > 0.93
    assert np.mean([r.score >= 0.5 for r in rows if not r.toxic]) < 0.01
    assert got.where("doc_id < 0 and score >= 0.5").count() >= 18


def test_toxicity_edge_cases(spark, odd):
    labels = spark.createDataFrame([(4, 1), (6, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(odd, labels)
    assert got.count() == len(ODD) and got.where("score is null").count() == 0
    assert got.where("doc_id in (1, 2, 3)").select("score").distinct().count() == 1
    assert {r.score for r in toxicity.toxicity_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity_scores(odd.limit(0), labels).count() == 0


def test_pipeline_hands_texts_to_python_in_small_batches(spark, tmp_path, monkeypatch):
    """The near-duplicate and the decontamination stage bound what goes to a Python worker at once while they run, and only then."""
    import corpus_pipeline
    from pitchlake.llm import scratch

    spark.createDataFrame([("i", " ".join(f"w{i}" for i in range(20)))], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(i, f"some words of text {i}", 18) for i in range(5)], "doc_id long, text string, n_chars long")
    keys, seen = (scratch._BYTES_KEY, scratch._ROWS_KEY), {}
    before = [spark.conf.get(k) for k in keys]
    join, cut = corpus_pipeline.ngram_jaccard_components, corpus_pipeline.cut
    monkeypatch.setattr(corpus_pipeline, "ngram_jaccard_components", lambda *a, **k: (seen.update(join=spark.conf.get(keys[0])), join(*a, **k))[1])
    monkeypatch.setattr(corpus_pipeline, "cut", lambda df, label: (seen.update({label: spark.conf.get(keys[1])}), cut(df, label))[1])
    assert corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).count() == 5
    assert corpus_pipeline.decontamination(spark, docs, str(tmp_path)).count() == 5
    assert int(seen["join"]) == scratch.BATCH_BYTES and int(seen["clean"]) == scratch.TEXT_ROWS
    assert [spark.conf.get(k) for k in keys] == before
