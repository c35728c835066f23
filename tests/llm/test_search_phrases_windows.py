"""Ranked search, collocations, window packing: brute force, SQL, exact round trips and edge cases."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitchlake.llm import oracle, queries
from pitchlake.llm.collocations import collocations, phrase_counts
from pitchlake.llm.lexical_search import ranked_search
from pitchlake.llm.window_packing import Encoder, Room, best_fit_decreasing, pack_windows, pour, with_crc32

SF = "/root/testdata/sf0.001"
TOKENS, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
CLASHES = ("row", "id", "n", "item", "terms", "rank", "score", "lang_", "suffix", "times", "depth", "start", "length", "ids", "shard", "bin", "offset")


def clashing(df):
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES) if c not in df.columns])


def by_sql(name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con.execute(oracle.oracle_sql()[name])


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_collocations"])
def test_equals_sql(spark, name):
    got = queries.registry()[name](spark, SF)
    want = by_sql(name)
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want.fetchall())


# --------------------------------------------------------------------------- ranked search

def brute_search(docs, items, k):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    held = [(i, Counter(split(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in split(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def _random_docs(seed, n, words, odd=()):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 60)))) for i in range(n)] + list(odd)


ODD = [(900, None), (901, ""), (902, " .,\n"), (None, "w1 W2 é"), (None, "w3"), (5, "w1 w1 w2"), (5, "w1 w1 w2"), (903, "é-w7 " * 30_000)]


@pytest.mark.parametrize("blocks", [{}, {"max_postings": 20, "max_items": 3}])
def test_search_equals_brute_force(spark, blocks):
    docs = _random_docs(1, 300, 60, ODD)
    items = [(i, t) for i, t in _random_docs(2, 12, 80)] + [(3, "W1 w1 w2 w2 w2"), (50, None), (51, ""), (52, "nowhere"), (None, "é")]
    got = ranked_search(clashing(spark.createDataFrame(docs, "doc_id long, text string")).repartition(5),
                        clashing(spark.createDataFrame(items, "item_id long, text string")), k=7, **blocks)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == brute_search(docs, items, 7)


def test_search_string_ids_ties_and_empty_tables(spark):
    docs = spark.createDataFrame([(c, "same text") for c in "dbca"] + [("e", "other")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "same")], "item_id string, text string")
    assert [r.doc_id for r in ranked_search(docs, items, k=3).orderBy("rank").collect()] == ["a", "b", "c"]
    assert ranked_search(docs.limit(0), items).count() == 0
    assert ranked_search(docs, items.limit(0)).count() == 0


def test_search_length_factor_beyond_64_bits():
    from pitchlake.llm.lexical_search import _m

    assert _m([10**12], 10**11, 10**13).tolist() == [75 + 25 * 10**10]


# --------------------------------------------------------------------------- collocations

def brute_counts(docs, depth):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, depth + 1):
                f.update((lang, " ".join(w[i : i + k])) for i in range(len(w) - k + 1))
    return f, n


def brute_collocations(docs, least, top, depth=4):
    f, n = brute_counts(docs, depth)
    a = {p: x for p, x in f.items() if x >= least and " " in p[1]}
    out = defaultdict(list)
    for (lang, phrase), x in a.items():
        w = phrase.split(" ")
        cuts = []
        for k in range(1, len(w)):
            left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((2_000_000 * x // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        longer = [y for (g, p), y in a.items() if g == lang and len(p) > len(phrase) and f" {phrase} " in f" {p} "]
        if not any(100 * y >= 80 * x for y in longer):
            out[lang].append((-score, -x, phrase.encode(), phrase, left, right))
    return Counter((lang, r, p, -x, left, right, n[lang], -s)
                   for lang, rows in out.items() for r, (s, x, _, p, left, right) in enumerate(sorted(rows)[:top], 1))


@pytest.fixture(scope="module")
def phrase_docs():
    rng = random.Random(5)
    words = ["a", "b", "c\x01", "c", "\x00", "é", "A", "long" * 20, "~"]
    seps = [" ", "  ", "\t", " . ", ",", "\n", " "]
    docs = [(rng.choice(["en", "de", None, "und", ""]),
             "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, 150)))) for _ in range(300)]
    return docs + [("en", None), ("en", ""), (None, " .\n"), ("fr", "x y z " * 20_000)] + [("de", "New York is big")] * 40


@pytest.mark.parametrize("group_rows,extend,bits", [(1 << 19, 1 << 14, 1 << 26), (500, 20, 1 << 10), (50, 1, 32)])
def test_collocations_equal_brute_force(spark, phrase_docs, monkeypatch, group_rows, extend, bits):
    """Whatever the groups, the extended prefixes and the filter's false positives."""
    from pitchlake.llm import collocations as c

    monkeypatch.setattr(c, "EXTEND_ROWS", extend)
    monkeypatch.setattr(c, "FLUSH", 10 * group_rows)
    monkeypatch.setattr(c, "BLOCK", max(group_rows // 2, 100))
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(phrase_docs)], "doc_id long, lang string, text string").repartition(4)
    got = collocations(clashing(df), least=30, top=25, group_rows=group_rows, filter_bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert Counter(map(tuple, got.collect())) == brute_collocations(phrase_docs, 30, 25)


def test_phrase_counts_over_batches(spark, phrase_docs):
    """A node that goes on over the end of an Arrow batch is counted once."""
    df = spark.createDataFrame(phrase_docs, "lang string, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = {(r.lang, r.phrase): r.f for r in phrase_counts(df, least=10)[0].collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {p: x for p, x in brute_counts(phrase_docs, 4)[0].items() if x >= 10}


def test_collocation_scores_beyond_64_bits(spark):
    """2,000,000 a passes 64 bits from a = 4.7e12 on."""
    a = 10**13
    row = spark.range(1).select(F.lit(a).alias("a"), F.lit(a + 7).alias("l"), F.lit(2 * a).alias("r"))
    got = row.select(F.expr("cast((cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0))) as bigint)")).first()[0]
    assert got == 2_000_000 * a // (3 * a + 7)


def test_collocations_empty_table(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert collocations(df).count() == 0


# --------------------------------------------------------------------------- window packing

def test_room_finds_the_tightest_window():
    rng = random.Random(9)
    room, open_ = Room(100), []
    for b in range(3000):
        need = rng.randint(1, 100)
        got = room.take(need)
        fit = [f for f, _ in open_ if f >= need]
        assert (got is None) == (not fit)
        if got:
            assert got[0] == min(fit) and got in open_
            open_.remove(got)
        if rng.random() < 0.6:
            free = rng.randint(1, 100)
            room.add(free, b)
            open_.append((free, b))


@pytest.mark.parametrize("seed", range(20))
def test_packing_covers_every_piece_and_pads_less_than_a_window(seed):
    rng = random.Random(seed)
    window = rng.choice([8, 100, 1024])
    sizes = sorted((rng.randint(1, window - 1) for _ in range(rng.randint(0, 400))), reverse=True)
    place = best_fit_decreasing(sizes, window)
    # brute force: the tightest of all open windows
    free = []
    for size, (b, offset) in zip(sizes, place):
        fit = [f for f in free if f >= size]
        if fit:
            assert free[b] == min(fit)
        else:
            assert b == len(free)
            free.append(window)
        assert offset == window - free[b]
        free[b] -= size
    rows = pour(sizes, place, window)
    parts, bins = defaultdict(list), defaultdict(list)
    for k, first, size, b, offset in rows:
        parts[k].append((first, size))
        bins[b].append((offset, size))
    assert sorted(parts) == list(range(len(sizes)))
    for group, total in [(parts[k], s) for k, s in enumerate(sizes)] + [(v, None) for v in bins.values()]:
        at = 0
        for first, size in sorted(group):
            assert first == at and size > 0
            at += size
        assert at == total if total is not None else at <= window
    assert sum(window - sum(s for _, s in v) for v in bins.values()) < window


def check_windows(rows, texts, window=1024):
    """Every id of every document in one piece, sequences without gaps; returns the padding."""
    model = Tokenizer.from_file(TOKENS)
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(docs) == set(texts)
    for d, pieces in docs.items():
        ids = np.array(model.encode(texts[d] or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        padding += window - at if at & (at - 1) else 0
    return padding


def test_both_encoders_agree_on_every_code_point():
    one, two = Encoder(TOKENS, None), Encoder(TOKENS, RANKS)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4096):
        text = "".join(f"a{c}b 1{c}{c}2 {c} x  {c}' {c}\n" for c in map(chr, points[at : at + 4096]))
        assert one.ids(text) == two.ids(text)
    assert two.ids("a <|endoftext|> b") == one.ids("a <|endoftext|> b") and 50256 in two.ids("<|endoftext|>")


def test_window_packing_round_trip(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op13_window_packing(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert check_windows(got.collect(), texts) < 1024


def test_window_packing_edge_cases_and_shards(spark):
    odd = {1: None, 2: "", 3: " \n", 4: "x", 5: "é " * 70_000, 6: "<|endoftext|> and more", 7: "a" * 5000, None: "no id"}
    odd |= {i: "word " * (i % 90) for i in range(10, 400)}
    df = clashing(spark.createDataFrame(list(odd.items()), "doc_id long, text string"))
    got = with_crc32(pack_windows(df, TOKENS, shard=50, ranks=RANKS))
    assert check_windows(got.collect(), odd) < 1024 * 8
    twice = with_crc32(pack_windows(df.where("doc_id = 5").unionAll(df.where("doc_id = 5")), TOKENS)).collect()
    assert sum(r.length for r in twice) == 2 * twice[0].doc_tokens
    assert len({(r.sequence_id, r.offset) for r in twice}) == len(twice)
    assert pack_windows(df.limit(0), TOKENS).count() == 0
    names = with_crc32(pack_windows(spark.createDataFrame([("a", "b")], "key string, body string"), TOKENS, id_col="key", text_col="body"))
    assert names.first().key == "a"


def test_merged_suffixes_leave_in_small_batches(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from pitchlake.llm import collocations as C

    monkeypatch.setattr(C, "OUT_ROWS", 3)
    block = lambda ids: (np.array(ids, np.uint64), pa.array(["en"] * len(ids)),
                         pa.array([f"s{i} " for i in ids], pa.large_string()), np.ones(len(ids), np.int64))
    held = [block([1, 2, 3, 4]), block([2, 4, 5, 6, 7])]
    out = C._merged(held)
    first = next(out)
    assert held == [] and first.num_rows == 3                 # the blocks are let go before rows leave
    rows = [r for b in [first, *out] for r in b.to_pylist()]
    assert {r["suffix"]: r["times"] for r in rows} == {"s1 ": 1, "s2 ": 2, "s3 ": 1, "s4 ": 2, "s5 ": 1, "s6 ": 1, "s7 ": 1}


def test_texts_reach_python_in_small_batches(spark):
    from pitchlake.llm.scratch import _ROWS_KEY, TEXT_ROWS, text_batches

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    before = spark.conf.get(_ROWS_KEY)
    rows = spark.range(0, 3 * TEXT_ROWS, 1, 1).mapInArrow(sizes, "n long")
    with text_batches(spark):
        seen = [r.n for r in rows.collect()]
    assert max(seen) <= TEXT_ROWS and sum(seen) == 3 * TEXT_ROWS and spark.conf.get(_ROWS_KEY) == before


def test_window_ids_as_bytes(spark):
    """Ids as bytes and as arrays are the same pieces; the digests of both agree."""
    texts = {1: "one two three " * 900, 2: "", 3: None, 4: "é 中 　 word"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    raw, lists = (pack_windows(df, TOKENS, ranks=RANKS, as_bytes=b) for b in (True, False))
    key = lambda r: (r.doc_id, r.start)
    a, b = sorted(raw.collect(), key=key), sorted(lists.collect(), key=key)
    assert [np.frombuffer(r.ids, "<i4").tolist() for r in a] == [r.ids for r in b] and len(b) > len(texts)
    digests = with_crc32(raw)
    assert digests.columns == with_crc32(lists).columns and digests.schema["ids_crc32"].dataType.simpleString() == "bigint"
    check_windows(digests.collect(), texts)
