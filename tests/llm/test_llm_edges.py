"""Every operator on odd rows: nulls in any column, empty and long texts,
ties, repeated rows, empty tables, extra columns with clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import (byte_bpe, embedding_forest, mixing, ngram_join, quality, spotsigs,
                          token_files, toxicity, url_filter, warc)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "`row` string, size string, score string, `key` string, _key string, text_ string, "
          "digest string, ids string, `rid` string")
EXTRA = ("r", "s", "c", "k", "u", "t", "d", "i", None)


def _long_text(n, seed=5):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
                    for _ in range(n))


LONG = _long_text(30_000)
COPY = _long_text(60, 6)
ROWS = [
    (1, COPY, "en", "a", 5), (2, COPY, "en", "b", 5), (2, COPY, "en", "b", 5),
    (3, COPY.replace(COPY.split()[30], "other", 1), "en", None, 5),
    (4, None, None, "a", None), (5, "", "en", "a", 0), (5, "", "en", "a", 0),
    (6, LONG, "en", "c", len(LONG)), (None, "a text without a key, of some words", "en", "a", 1),
    (7, "one", None, None, None), (8, " \n\t ", "de", "b", 4), (9, "!!! ,,, ...", "fr", "c", 3),
    (10, _long_text(40, 7), "en", "c", 9), (10, _long_text(41, 8), "en", "c", 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([r + EXTRA for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (3, None)],
                                   "doc_id long, quality int")
    model = quality.train(docs, labels)
    rows = quality.score_quality(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert rows[0].row.asDict().keys() == set(docs.columns)
    by = {}
    for r in rows:
        by.setdefault(r.row.text or "", set()).add(round(r.score, 9))
    assert all(len(s) == 1 for s in by.values())
    assert quality.score_quality(none, model).count() == 0
    constant = quality.train(none, labels)
    assert {r.score for r in quality.score_quality(docs, constant).collect()} == {0.5}


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1)],
                                   "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    rows = toxicity.score_toxicity(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_toxicity(none, model).count() == 0
    nothing = toxicity.train(none, labels)
    assert all(r.score < 0.3 and not r.spans
               for r in toxicity.score_toxicity(docs, nothing).collect())


def test_ngram_join(docs, none):
    rows = ngram_join.join_ngrams(docs).collect()
    assert len(rows) == len(ROWS)
    copies = [r for r in rows if r.class_id == 1]
    assert sorted(r.row.doc_id for r in copies) == [1, 2, 2, 3]
    assert all(r.n_links == 3 for r in copies) and sum(r.kept for r in copies) == 1
    rest = [r for r in rows if r.class_id != 1]
    assert all(r.kept and r.n_links == 0 and r.class_id == r.row.doc_id for r in rest)
    assert rows[0].row.asDict().keys() == set(docs.columns)
    assert ngram_join.join_ngrams(none).count() == 0


def test_mixing(docs, none):
    rows = mixing.mix_sources(docs, carry=docs.columns).collect()
    assert len(rows) == len(ROWS)
    size = {s: sum(r.size for r in rows if r.row.source == s) for s in ("a", "b", "c", None)}
    assert all(r.source_size == size[r.row.source] for r in rows)
    assert all(r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0 for r in rows)
    assert abs(sum({r.row.source: r.target for r in rows}.values()) - sum(size.values())) < 1e-6
    assert mixing.mix_sources(none).count() == 0 and mixing.mixed_rows(none).count() == 0
    assert mixing.mixed_rows(docs).columns == docs.columns
    half = mixing.mix_sources(docs, budget=sum(size.values()) // 2).agg(F.sum("taken")).first()[0]
    assert half <= sum(size.values()) // 2


def test_byte_bpe(docs, none):
    P = pytest.importorskip("public_tokenizers")
    path = P.path("byte_bpe_multi_50k.tiktoken")
    enc = byte_bpe.encode(docs, path, P.PATTERN)
    rows = byte_bpe.decode(enc, path).collect()
    assert len(rows) == len(ROWS)
    assert all(bytes(r.decoded).decode() == (r.row.text or "") for r in rows)
    assert all(len(r.ids) == 4 * r.n_tokens for r in rows)
    assert byte_bpe.encode(none, path, P.PATTERN).count() == 0


def test_token_files(docs, none, scratch):
    P = pytest.importorskip("public_tokenizers")
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    m = token_files.write_token_files(docs, definition, f"file://{scratch}/a", end_id=1, files=3,
                                      length=64)
    rows = sorted(token_files.read_token_files(m).collect(), key=lambda r: r.start)
    keys = [r.key for r in rows]
    assert len(rows) == len(ROWS) and keys == sorted(keys, key=lambda k: (k is not None, k))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert [r.n_tokens for r in rows if r.key in (4, 5)] == [1, 1, 1]
    empty = token_files.write_token_files(none, definition, f"file://{scratch}/b", end_id=1)
    assert token_files.read_token_files(empty).count() == 0


def test_spotsigs(docs, none):
    rows = spotsigs.compare_along_order(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    copies = {r.fingerprint for r in rows if r.key in (1, 2)}
    assert len(copies) == 1
    assert sorted(r.n_chars for r in rows) == sorted(len(r[1] or "") for r in ROWS)
    assert spotsigs.compare_along_order(none).count() == 0
    one = spotsigs.compare_along_order(docs.where("doc_id = 7")).first()
    assert one.near_next == 1.0
    near = {(r.key, r.class_id) for r in spotsigs.near_duplicates(docs).collect()}
    assert {(1, 1), (2, 1), (4, 4), (5, 4)} <= near
    assert spotsigs.near_duplicates(none).count() == 0


def test_url_filter(spark):
    model = url_filter.train(url_filter.labelled_urls(spark))
    urls = [None, "", "no scheme", "://", "http://", "HTTP://A.Example.NET/en/x?y#z", "x://net/",
            "http://subnet/", "http://sub.net/", "http://a.example.com/de/", "http://example.com/den",
            "ftp://org/fr/1", "http://h#f/de/", "http://h?q=://x/", "http://ÄÖ.net/Ä", "a" * 20000,
            "http://win-casino-bets.zone/slots"] + ["http://dup.net/1"] * 2
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, `row` string")
    got = {r.row.page_id: r for r in url_filter.judge_urls(pages, url_filter.RULES, model).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
            path = rest[cut:].split("?")[0].split("#")[0]
        fits = [r for r in url_filter.RULES
                if (host == r.rule.split("/")[0] or host.endswith("." + r.rule.split("/")[0]))
                and path.startswith("/" + r.rule.partition("/")[2])]
        best = max(fits, key=lambda r: len(r.rule), default=None)
        assert (got[i].host, got[i].path) == (host, path)
        assert got[i].rule == (best.rule if best else None)
        assert got[i].verdict == (best.verdict if best else got[i].verdict)
        assert got[i].verdict in ("allow", "block")
    assert got[urls.index("http://win-casino-bets.zone/slots")].verdict == "block"
    assert url_filter.judge_urls(pages.limit(0), url_filter.RULES, model).count() == 0


def test_warc(spark, scratch):
    rows = [(1, "http://a", "x"), (2, "http://b", "x"), (2, "http://b", "x"), (3, None, None),
            (4, "u\r\nv", ""), (None, "http://c", "x"), (5, "http://d", "é" * 70000),
            (None, None, "lone"), (None, None, "lone"), (6, "http://e", "é")]
    pages = spark.createDataFrame([r + ("z", "w") for r in rows],
                                  "page_id long, url string, html string, sha1 string, file string")
    index = warc.write_archives(pages, f"file://{scratch}/w")
    got = warc.read_records(index).collect()
    assert len(got) == len(rows)
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in got)
    assert kinds == sorted([
        ("1", "response", None, 1), ("2", "revisit", 1, 1), ("2", "revisit", 1, 1),
        ("3", "response", None, 0), ("4", "revisit", 3, 0), ("None", "revisit", 1, 1),
        ("5", "response", None, 140000), ("None", "response", None, 4),
        ("None", "response", None, 4), ("6", "response", None, 2)])
    some = index.where("page_id IN (5, 6)")
    assert {r.page_id: bytes(r.payload).decode() for r in warc.read_records(some).collect()} == \
        {5: "é" * 70000, 6: "é"}
    small = warc.write_archives(pages, f"file://{scratch}/v", least_bytes=2)
    assert {r.record_type for r in warc.read_records(small).where("page_id < 5").collect()} == \
        {"response"}
    assert warc.read_records(warc.write_archives(pages.limit(0), f"file://{scratch}/e")).count() == 0


def test_embedding_forest(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.1], 1),
            (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [0.0, 0.0], 1),
            (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [], 1),
            (12, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (13, [0.0, 1.0], 1),
            (14, [-1e300, 1e300], 3), (15, [-1e-300, 1e-300], 3)]
    v = spark.createDataFrame([r + ("a", "b") for r in rows],
                              "vec_id long, embedding array<double>, label int, `key` string, node string")
    got = embedding_forest.near_duplicates(v).collect()
    assert len(got) == len(rows)
    assert {(r.n_links, r.component_id) for r in got if r.key in (14, 15)} == {(1, 14)}
    linked = [r for r in got if r.n_links and r.key not in (14, 15)]
    assert sorted(str(r.key) for r in linked) == ["1", "2", "2", "3", "None"]
    assert all(r.n_links == 4 and r.component_id == 1 for r in linked)
    assert all(r.component_id == r.key and r.kept for r in got if not r.n_links)
    assert embedding_forest.near_duplicates(v.limit(0)).count() == 0
