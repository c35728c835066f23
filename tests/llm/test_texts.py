"""Text kernels, secret scan, decontamination, archives."""

import gzip
import hashlib
import random
import re
import string
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitchlake.llm import arc, decontamination, queries, secrets, tokens
from pitchlake.llm.decontamination import benchmark_hits, decontaminate, with_verdict

SF = "/root/testdata/sf0.01"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB1 é\n\t-", max_size=30), max_size=8), st.integers(1, 40))
def test_words_match_regex(texts, block):
    for column in (pa.array(texts, pa.string()), pa.array(["zz", *texts], pa.large_string())[1:]):
        for member, pattern in ((tokens.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (tokens.ALNUM_WORD, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|[A-Z]+")):
            if member is tokens.ALNUM_WORD:
                pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
            got = [[] for _ in texts]
            for t in tokens.blocks(column, block):
                b, e, o = tokens.runs(t, member)
                for x, y, z in zip(b, e, o):
                    got[t.first + z].append(t.data[x:y].tobytes().decode())
            assert got == [re.findall(pattern, t) for t in texts]


def test_hashes_depend_on_the_bytes_alone():
    rng = random.Random(0)
    ws = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    (t,) = tokens.blocks(pa.array([" ".join(ws)]), 1 << 20)
    h, _ = tokens.words(t, tokens.NOT_SPACE)
    by = defaultdict(set)
    for w, x in zip(ws, h.tolist()):
        by[w].add(x)
    assert all(len(x) == 1 for x in by.values()) and len({min(x) for x in by.values()}) == len(by)
    (u,) = tokens.blocks(pa.array([" ".join(ws).upper()]), 1 << 20)
    assert (tokens.words(u, tokens.NOT_SPACE, lower=True)[0] == tokens.words(t, tokens.NOT_SPACE, lower=True)[0]).all()


def test_secrets_base_matches_regex(spark):
    rows = [(1, None), (2, ""), (None, "token=abcdef"), (3, 'PassWord : "hunter22" and api-key=1 apikey=xy.z-=/ api_key = \'a+b/c_d\''),
            (4, "é€😀 secret=" + "f" * 40), (5, "AKIA" + "A" * 16 + " AKIAX AKIAAKIA" + "B" * 12), (5, "passwd=12345 token=  "),
            (6, "x " * 200_000 + "token=abcdef0123456789abcdef0123")]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    docs = docs.select("*", F.lit(1).alias("id"), F.lit(1).alias("kinds"))
    pattern = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)

    def spans(t):
        t = t or ""
        s = [(m.start(), 0, m.end()) for m in pattern.finditer(t) if len(m[2]) >= 6]
        s += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        s += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        return sorted(s)

    want = sorted((r.doc_id or -1, *[x for a, k, b in spans(r.text) for x in (("assign", "access", "hex")[k], a, b)]) for r in docs.collect())
    found = secrets.scan_secrets(docs)
    got = sorted((r.doc_id or -1, *[x for k, a, b in zip(r.kinds, r.starts, r.ends) if k != "random" for x in (k, a, b)]) for r in found.collect())
    assert got == want
    assert secrets.scan_secrets(docs.limit(0)).count() == 0


def test_battery_finds_random_strings_only(spark):
    rng = random.Random(4)
    pick = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    b64, low = string.ascii_letters + string.digits, string.ascii_lowercase + string.digits
    planted = [(i, f"see {pick(b64 if i % 2 else low, 48)} here") for i in range(40)]
    words = ["alpha", "report", "value", "page2", "item1", "section", "2024", "draft"]
    plain = [(1000 + i, "see " + "_".join(rng.choice(words) for _ in range(8)) + " here") for i in range(40)]
    plain += [(2000 + i, f"id {'0' * 20}{i:04d}abcabcabcabc") for i in range(20)]
    docs = spark.createDataFrame(planted + plain, "doc_id long, text string").union(
        spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    got = secrets.scan_secrets(docs).where(F.array_contains("kinds", "random")).select("doc_id").collect()
    ids = {r.doc_id for r in got}
    assert len(ids & set(range(40))) >= 30 and not ids & set(range(1000, 10_000))
    assert len([i for i in ids if i >= 10_000]) <= 2


def test_battery_tests_every_run():
    rng = random.Random(5)
    pick = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    key = pick(string.ascii_letters + string.digits, 40)
    texts = ["see " + pick(string.ascii_lowercase, 40), pick("0123456789", 22), "x internationalization_of words", f"my-app/a+b/{key} end",
             "AKIA" + "A" * 16 + "_" + pick(string.ascii_lowercase, 24) + "-", "f" * 24 + "x" * 19, "short a-b/c"]
    got = [[(text[a:b].decode(), secrets.ENCODINGS[e][0]) for a, b, e, _ in tested] for text, _, tested in secrets._scan(pa.array(texts))]
    assert got == [[(texts[0][4:], "lower letters")], [(texts[1], "digits")], [("internationalization_of", "base64url")], [(key, "alnum")],
                   [(texts[4][20:], "base64url")], [], []]


def test_random_letters_are_found_and_words_are_not(spark):
    rng = random.Random(6)
    pick = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    alphabets = (string.ascii_letters, string.ascii_lowercase, string.ascii_letters + string.digits)
    rows = [(i, ("see my-app/", "see ", "see ")[i % 3] + pick(alphabets[i % 3], 64) + " here") for i in range(60)]
    words = ["alpha", "report", "value", "section", "draft", "nation", "where", "with", "under"]
    rows += [(1000 + i, "see " + "".join(rng.choice(words) for _ in range(12))[:64] + " here") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(
        spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    ids = {r.doc_id for r in secrets.scan_secrets(docs).where(F.array_contains("kinds", "random")).select("doc_id").collect()}
    assert all(len([i for i in ids if i < 1000 and i % 3 == k]) >= 17 for k in range(3))
    assert len([i for i in ids if i >= 1000]) <= 2


def test_every_band_measures_all_word_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text")
    letters = np.frombuffer("".join(re.sub("[^a-z]", "", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")) for r in docs.collect()).encode(), np.uint8) - 97
    seen = spark.createDataFrame([("".join(map(chr, letters + 97)),)], "text string")
    whole = secrets.text_moments(seen)
    for band, top in enumerate(secrets.BANDS):
        n = min(top, 256)
        x = secrets.statistics(letters[: len(letters) // n * n].reshape(-1, n).astype(np.int64), 36)
        assert whole[band] == pytest.approx((x.mean(), max(x.std(), 0.25)), rel=1e-3)
    # partitions of under one stretch, and of many small texts, measure the same
    parts = secrets.text_moments(docs.repartition(64))
    assert parts == pytest.approx(whole, rel=0.02)
    tiny = secrets.text_moments(docs.limit(12).repartition(12))
    assert (np.diff(tiny[:, 0]) > 0).all() and not (tiny == (4.0, 1.0)).all(axis=1).any()
    assert (secrets.text_moments(docs.limit(0)) == (4.0, 1.0)).all()


def test_statistics_grow_with_structure():
    rng = np.random.default_rng(0)
    flat = secrets.statistics(rng.integers(0, 36, (500, 64)), 36)
    runs = secrets.statistics(np.tile(np.arange(64) // 2 % 36, (2, 1)), 36)
    assert flat.mean() < 1.3 and runs.min() > 2.5
    counts = np.zeros(len(secrets.BANDS) * secrets.CELLS, np.int64)
    counts[0], counts[90] = 1000, 5
    least = secrets.thresholds(counts, 0.01)
    assert least[0] == 90 and least[1] == secrets.CELLS


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=9), max_size=5), st.lists(st.integers(0, 4), max_size=40), st.integers(1, 5))
def test_automaton_matches_brute_force(items, text, window):
    vocabulary = np.arange(4, dtype=np.uint64)
    sam = decontamination.build([(f"i{k}", w) for k, w in enumerate(items)], window, vocabulary)
    hit, who = set(), set()
    for k, w in enumerate(items):
        m = min(window, len(w))
        for j in range(len(w) - m + 1):
            for p in range(len(text) - m + 1):
                if m and text[p : p + m] == w[j : j + m]:
                    hit.update(range(p, p + m))
                    who.add(f"i{k}")
    found = list(decontamination.matches(sam, np.array(text, np.uint64), np.zeros(len(text), np.int64)))
    got = {x for _, spans, _ in found for a, b in spans for x in range(a, b)}
    assert got == hit and (found[0][2] if found else set()) == who


def _sql_hits(docs, items):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("benchmark", items.toPandas())
    return sorted(con.execute(queries.oracle_sql()["op9_decontamination"]).fetchall(), key=str)


def test_hits_match_sql_in_one_and_several_blocks(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").union(
        spark.createDataFrame([(900, "Se QUE os"), (901, "the"), (902, None), (903, " - ")], "item_id long, text string")).cache()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").cache()
    want = _sql_hits(docs, items)
    for max_words in (10**6, 900):
        hits = with_verdict(benchmark_hits(docs, items, max_words=max_words))
        got = hits.select("doc_id", "n_words", "n_hit", F.size("items").alias("n_items"),
                          F.sha2(F.array_join("items", ","), 256).alias("h"), "contaminated").collect()
        assert sorted((tuple(r) for r in got), key=str) == want


def test_decontaminate_cuts_spans(spark):
    span = " ".join(f"q{i}" for i in range(13))
    items = spark.createDataFrame([(1, span + " tail"), (None, "filler"), (1, span)], "item_id long, text string")
    filler = " ".join(["filler é"] * 200)
    rows = [(1, f"{filler}, {span.upper()}! {filler}"), (2, f"x {span} y"), (3, None), (None, ""), (4, "clean text"), (4, "clean text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(7).alias(c) for c in ("id", "items", "spans", "n_words")])
    got = decontaminate(docs, items)
    assert got.columns == docs.columns
    by = sorted(((r.doc_id or 0), r.text) for r in got.where("doc_id is null or doc_id <> 3").collect())
    assert by == [(0, ""), (1, f"{filler}, ! {filler}"), (4, "clean text"), (4, "clean text")]
    assert got.where("doc_id = 3 and text is null").count() == 1
    assert decontaminate(docs, items.limit(0)).count() == len(rows) and decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate(docs, items, max_words=10).count() == len(rows) - 1


def _pages(spark):
    big = "<p>" + "ü" * 200_000 + "</p>"
    rows = [(5, "http://a.b/x y", "same " * 30), (3, "http://a.b/2", "same " * 30), (4, None, "same " * 30), (9, "u", None), (8, "", ""),
            (7, "http://c/\n", "short"), (6, "http://c/", "short"), (None, "http://n", "same " * 30), (11, "v", big), (12, "v", big),
            (13, "w", "a\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\nb" * 5), (2, "x", "same " * 30), (2, "x", "same " * 30)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("page", F.lit(1)).withColumn("body", F.lit(2))


def test_archives_round_trip(spark):
    pages = _pages(spark)
    want = []
    for r in pages.collect():
        body = (r.html or "").encode()
        same = [p.page_id for p in pages.collect() if (p.html or "").encode() == body and p.page_id is not None]
        of = min(same) if r.page_id is not None and len(body) >= 100 and min(same) != r.page_id else None
        want.append((r.page_id or 0, len(body), hashlib.sha256(body).hexdigest(), "response" if of is None else "revisit", of))
    for records in (4, 5000):
        got = arc.pages_to_warc(spark, pages.repartition(2), records=records)
        assert sorted(((r.page or 0), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()) == sorted(want)
    assert arc.pages_to_warc(spark, pages.limit(0)).count() == 0


def test_archive_files_are_well_formed(spark, tmp_path):
    arc_path, warc_path = str(tmp_path / "arc"), str(tmp_path / "warc")
    arc.write_arc(_pages(spark).coalesce(1), arc_path, records=4)
    files = arc.read_archives(spark, arc_path)
    assert files.count() == 5  # three pages a file, each behind a version block
    versions = []
    for r in files.collect():
        records = list(arc.parse_arc(gzip.decompress(bytes(r.content))))
        assert records[0]["url"].startswith("filedesc://") and all(x["whole"] for x in records)
        versions.append(2 if records[1]["status"] else 1)
    assert set(versions) == {1, 2}
    arc.arc_to_warc(spark, files, warc_path)
    ids, refers = set(), set()
    for r in arc.read_archives(spark, warc_path).collect():
        raw = gzip.decompress(bytes(r.content))
        assert raw.endswith(b"\r\n\r\n")
        for fields, body in arc.parse_warc(raw):
            assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"])
            assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", fields["WARC-Record-ID"]) and len(body) == int(fields["Content-Length"])
            if "WARC-Block-Digest" in fields:
                assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(body).hexdigest()
            ids.add(fields["WARC-Record-ID"])
            refers |= {fields["WARC-Refers-To"]} if "WARC-Refers-To" in fields else set()
    assert refers and refers <= ids


def test_foreign_arc_records():
    v1 = b"filedesc://f.arc 0.0.0.0 19970101 text/plain 70\n1 0 Org\nURL IP-address Archive-date Content-type Archive-length\n\n"
    size = len(v1.split(b"\n", 1)[1])
    v1 = v1.replace(b" 70\n", b" %d\n" % size)
    data = v1 + b"\ndns:a.b 1.2.3.4 199701011200 text/dns 9\n123 4.3.2\nbad line\nhttp://a/ 1.2.3.4 19970101120000 text/html 30\nHTTP/1.0 200 OK\r\n\r\n<b>x</b>123\n"
    records = list(arc.parse_arc(data))
    assert [r["url"] for r in records] == ["filedesc://f.arc", "dns:a.b", "http://a/"]
    kinds = [arc.to_warc(r)[0] for r in records]
    assert kinds == ["warcinfo", "resource", "response"]
    assert b"WARC-Date: 1997-01-01T12:00:00Z" in arc.to_warc(records[1])[1] and b"1997-01-01T00:00:00Z" in arc.to_warc(records[0])[1]
    assert arc.payload_of(records[2])[1] == b"<b>x</b>123"


@pytest.mark.parametrize("name", ["op2_quality_rules", "op4_line_dedup", "op9_decontamination", "op10_legacy_archives"])
def test_queries_match_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.registry()[name](spark, sf)
    cur = con.execute(queries.oracle_sql()[name])
    order = [d[0] for d in cur.description]
    assert sorted(order) == sorted(df.columns)
    assert sorted(map(str, (tuple(r) for r in df.select(order).collect()))) == sorted(map(str, cur.fetchall()))
