"""The methods against brute force, exact round trips or held-out rows."""

import collections
import hashlib
import itertools
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from tidemark.llm import (byte_bpe, embedding_forest, ngram_join, quality, spotsigs, token_files,
                          toxicity, warc)
from tidemark.llm.components import connected_components
from tidemark.llm.common import Scratch

SF = "/root/testdata/sf0.01"


def _read(table):
    return duckdb.sql(f"SELECT * FROM '{SF}/{table}.parquet'").fetchall()


@pytest.fixture(scope="module")
def documents():
    return {r[0]: r[1] or "" for r in _read("documents")}


def _groups(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    degree = collections.Counter()
    for a, b in linked:
        degree[a] += 1
        degree[b] += 1
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {i: (root(i), degree[i]) for i in ids}


def _similar(sets, threshold):
    held = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            held[g].append(i)
    common = collections.Counter()
    for ids in held.values():
        common.update(itertools.combinations(sorted(ids), 2))
    return [p for p, c in common.items()
            if c >= threshold * (len(sets[p[0]]) + len(sets[p[1]]) - c) - 1e-9]


def test_op3_against_brute_force(spark, documents):
    rows = E.queries()["op3_ngram_join"](spark, SF).collect()
    marks = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
    sets = {}
    for i, t in documents.items():
        w = [x for x in (y.strip(marks).lower() for y in t.split()) if x]
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else ()
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == _groups(sets, _similar(sets, 0.8))
    assert all(r.kept == (r.doc_id == r.class_id) for r in rows)


def test_ngram_join_in_blocks(spark):
    """A group of near copies larger than a block, and a long chain."""
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(200)]
    texts = {}
    for i in range(60):
        words = list(base)
        words[rng.randrange(200)] = f"x{i}"
        texts[i] = " ".join(words)
    for i in range(60, 90):
        texts[i] = " ".join(base[: 0]) + " ".join(f"c{k}" for k in range(i * 3, i * 3 + 80))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.row.doc_id: (r.class_id, r.n_links) for r in
           ngram_join.join_ngrams(df, carry=["doc_id"], block=7).collect()}
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)}
            for i, t in texts.items()}
    assert got == _groups(sets, _similar(sets, 0.8))


def test_ngram_join_under_dissimilar_heads(spark):
    """Few lightly and many heavily edited copies of a short text: the least
    members of most buckets resemble none of the light ones."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(100)]
    texts, held = {}, []
    for i in range(2000):
        words = list(base)
        for k in rng.sample(range(100), rng.randint(8, 10) if i < 1940 else 1):
            words[k] = f"x{i}y{k}"
        texts[i] = " ".join(words)
        held.append([words[k:k + 5] == base[k:k + 5] for k in range(96)])
    # edits are unique, so only n-grams of the base are common
    held = np.array(held, np.int64)
    common = held @ held.T
    linked = common >= 0.8 * (2 * 96 - common)
    np.fill_diagonal(linked, False)
    pairs = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(linked)))]
    assert len(pairs) > 1000
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    got = {r.row.doc_id: (r.class_id, r.n_links) for r in
           ngram_join.join_ngrams(df, carry=["doc_id"]).collect()}
    assert got == _groups(texts, pairs)


def test_bands():
    for threshold, recall, rows in ((0.8, 0.99, 6), (0.8, 0.9999, 6), (0.5, 0.9, 3)):
        b = ngram_join.bands_for(threshold, recall, rows)
        assert 1 - (1 - threshold ** rows) ** b >= recall
        assert b == 1 or 1 - (1 - threshold ** rows) ** (b - 1) < recall


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + rng.randint(1, 200)) for _ in range(150)]
    edges += [(rng.randint(3000, 3400), rng.randint(3000, 3400)) for _ in range(300)] + [(7, 7)]
    got = {r.id: r.root for r in connected_components(
        spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    ids = {x for e in edges for x in e}
    want = _groups(ids, [e for e in edges if e[0] != e[1]])
    assert got == {i: want[i][0] for i in ids if i in got}
    assert set(got) == {x for e in edges if e[0] != e[1] for x in e}


def _clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for k in range(0, n, 5):  # groups of near copies around the threshold, and equal ones
        x[k + 1:k + 4] = x[k] + rng.normal(size=(3, dim)) * np.array([[0.1], [0.2], [0.28]])
        x[k + 4] = x[k]
    x[:150] = x[0] + rng.normal(size=(150, dim)) * 0.12
    return x


def test_forest_recall(spark):
    """Recall of links against brute force, with small leaves, several
    rounds and a dense leaf in blocks; nothing below the threshold."""
    x = _clustered(1500, 16, 4)
    df = spark.createDataFrame([(i, [float(a) for a in v], int(i % 7 == 0)) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>, label int")
    got = {r.key: r for r in embedding_forest.near_duplicates(df, leaf=64, sample=256, trees=6).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.arange(len(x)) % 7 == 0
    true = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(true, False)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= true.sum(1)).all()
    assert found.sum() >= 0.9 * true.sum()


def test_forest_on_a_hot_group(spark):
    """20,000 unequal vectors around one, with the query's parameters."""
    n, dim, rng = 20_000, 64, np.random.default_rng(7)
    x = rng.normal(size=(n, dim)) * np.sqrt(0.06 / dim)
    x[:, 0] += np.sqrt(0.94)
    flat = pa.array(x.ravel())
    rows = pa.table({"vec_id": np.arange(n), "label": np.zeros(n, np.int64),
                     "embedding": pa.ListArray.from_arrays(
                         pa.array(np.arange(0, n * dim + 1, dim), pa.int32()), flat)})
    got = {r.key: r.n_links for r in
           embedding_forest.near_duplicates(spark.createDataFrame(rows)).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = np.concatenate([(u[a:a + 1000] @ u.T >= 0.93).sum(axis=1) - 1
                           for a in range(0, n, 1000)])
    found = np.array([got[i] for i in range(n)])
    assert (found <= true).all()
    assert found.sum() >= embedding_forest.RECALL * true.sum()


def test_op2_against_brute_force(spark):
    rows = _read("embeddings")
    got = {r.vec_id: r for r in E.queries()["op2_embedding_forest"](spark, SF).collect()}
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = np.array([[a[2] == b[2] for b in rows] for a in rows])
    linked = (x @ x.T >= 0.93) & same
    np.fill_diagonal(linked, False)
    ids = [r[0] for r in rows]
    want = _groups(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(np.triu(linked)))])
    assert {i: (got[i].component_id, got[i].n_links) for i in ids} == want


def test_chain_marginals():
    rng = np.random.default_rng(0)
    for _ in range(30):
        n = int(rng.integers(1, 9))
        odds = np.exp(rng.normal(0, 2, n))
        chain = toxicity.Chain(*np.exp(rng.normal(0, 1, 5)))
        cuts = np.array(sorted({0, n, *(int(k) for k in rng.integers(0, n, 2))}))
        p, _, _ = toxicity.marginals(odds, cuts, chain)
        table = ((chain.cc, chain.ct), (chain.tc, chain.tt))
        for a, b in zip(cuts[:-1], cuts[1:]):
            total, sums = 0.0, np.zeros(b - a)
            for tags in itertools.product((0, 1), repeat=int(b - a)):
                w = chain.first if tags[0] else 1.0
                for i, t in enumerate(tags):
                    w *= (odds[a + i] if t else 1.0) * (table[tags[i - 1]][t] if i else 1.0)
                total, sums = total + w, sums + w * np.array(tags)
            assert np.allclose(p[a:b], sums / total)


def test_spans_mark_the_offence():
    clean = ["the quiet garden was full of roses and birds near the old mill"] * 30
    rng = random.Random(2)
    clean = [" ".join(rng.sample(t.split(), 10)) for t in clean]
    toxic = [" ".join(rng.sample(t.split(), 6) + ["vilebrute,"] + rng.sample(t.split(), 3)) for t in clean]
    model = toxicity.fit(pa.array(clean + toxic), np.array([0.0] * 30 + [1.0] * 30))
    text = "roses and\nvilebrute, vilebrutish birds"
    words = toxicity.words_of(pa.array([text]))
    odds = np.exp([model.emission(w) for w in words.distinct])[words.place]
    p, _, _ = toxicity.marginals(odds, words.cuts, model.chain)
    chars = np.array([len(w) for w in words.distinct])[words.place]
    spans = toxicity._spans(words, chars, p >= 0.5).to_pylist()[0]
    assert [text[s["start"]:s["end"]] for s in spans] == ["vilebrute, vilebrutish"]


@pytest.mark.parametrize("white", ["\t", "\r", "\r\n", "\f", "\u00a0", "\u2028", "\x85"])
def test_words_end_at_white_space(white):
    """An offence beside any white space is tagged at its own offsets."""
    rng = random.Random(2)
    plain = "the quiet garden was full of roses and birds near old mill".split()
    clean = [" ".join(rng.sample(plain, 10)) for _ in range(30)]
    toxic = [" ".join(rng.sample(plain, 6) + ["vilebrute"] + rng.sample(plain, 3)) for _ in range(30)]
    model = toxicity.fit(pa.array(clean + toxic), np.array([0.0] * 30 + [1.0] * 30))
    text = f"roses{white}vilebrute{white}birds"
    words = toxicity.words_of(pa.array([text]))
    odds = np.exp([model.emission(w) for w in words.distinct])[words.place]
    p, _, _ = toxicity.marginals(odds, words.cuts, model.chain)
    chars = np.array([len(w) for w in words.distinct])[words.place]
    spans = toxicity._spans(words, chars, p >= 0.5).to_pylist()[0]
    assert [text[s["start"]:s["end"]] for s in spans] == ["vilebrute"]

    def held(t):
        f = quality.features(pa.array([t]))
        return {i for i in f.index.tolist() if i < quality.BUCKETS}
    assert held(text) == held("roses vilebrute birds")


@pytest.mark.parametrize("name,label,at,least", [("op7_quality", 1, 0.7, 0.95),
                                                 ("op4_toxicity", 2, 0.3, 0.85)])
def test_held_out_accuracy(spark, name, label, at, least):
    rows = {r.doc_id: r for r in E.queries()[name](spark, SF).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= at) for r in rows.values())
    held = [(rows[r[0]], r[label]) for r in _read("labels") if rows[r[0]].held_out]
    right = sum(r.predicted == y for r, y in held) / len(held)
    assert right >= least


def test_factorisation_identity():
    """The sum-of-squares identity against the pairs written out."""
    rng = np.random.default_rng(1)
    model = quality.FactorisationMachine(0.3, rng.normal(size=quality.DIMENSIONS),
                                         rng.normal(size=(quality.DIMENSIONS, quality.FACTORS)))
    f = quality.features(pa.array(["one two two three", "", "ÄÖ 12 %%% x\ny"]))
    for i, margin in enumerate(model.margin(f)):
        j, x = f.index[f.starts[i]:f.starts[i + 1]], f.value[f.starts[i]:f.starts[i + 1]]
        want = 0.3 + (model.linear[j] * x).sum()
        for a, b in itertools.combinations(range(len(j)), 2):
            want += (model.factors[j[a]] * model.factors[j[b]]).sum() * x[a] * x[b]
        assert abs(margin - want) < 1e-9


def test_op9_against_tiktoken(spark, documents):
    P, tiktoken = pytest.importorskip("public_tokenizers"), pytest.importorskip("tiktoken")
    raw = open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read()
    codec = byte_bpe.ByteBPE(raw, P.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    for r in E.queries()["op9_byte_bpe"](spark, SF).collect():
        ids = enc.encode_ordinary(documents[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(documents[r.doc_id].encode()).hexdigest()
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab '\n\t  slé中1 2 !?\u3000\x1c") for _ in range(rng.randint(0, 14)))
             for _ in range(3000)] + ["a" * 5000, " " * 3000, "é" * 2500 + "x", "ab" * 1500]
    for t, ids in zip(texts, codec.encode(pa.array(texts))):
        assert ids.tolist() == enc.encode_ordinary(t)
        assert codec.decode(ids.tolist()).decode() == t


def test_op5_against_the_library(spark, documents):
    P, tokenizers = pytest.importorskip("public_tokenizers"), pytest.importorskip("tokenizers")
    definition = open(P.path("word_bpe_49k.json"), encoding="utf-8").read()
    lib = tokenizers.Tokenizer.from_str(definition)
    start = 0
    for r in sorted(E.queries()["op5_token_files"](spark, SF).collect(), key=lambda r: r.doc_id):
        ids = lib.encode(documents[r.doc_id], add_special_tokens=False).ids + [1]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    own, rng = token_files.WordTokenizer(definition), random.Random(1)
    parts = ["a", "B", "'s", " ", "  ", "\n", "\t", "é", "e\u0301", "Σ", "İ", "1", "!?", "|", "a|b",
             "<|endoftext|>", "\x1c", "\u3000", "中", "ﬁ", "word,", "Word.", ".,"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    for t, ids in zip(texts, own.encode(pa.array(texts))):
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_added_tokens_keep_their_case():
    P, tokenizers = pytest.importorskip("public_tokenizers"), pytest.importorskip("tokenizers")
    definition = open(P.path("word_bpe_49k.json"), encoding="utf-8").read()
    lib, own = tokenizers.Tokenizer.from_str(definition), token_files.WordTokenizer(definition)
    texts = ["<|ENDOFTEXT|>", "A <|EndOfText|>. b", "X<|endoftext|>Y", "<|STARTOFTEXT|>, Z|<|ENDOFTEXT|>"]
    for t, ids in zip(texts, own.encode(pa.array(texts))):
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_sequences_are_views(tmp_path):
    path = str(tmp_path / "x.arrow")
    with pa.OSFile(path, "wb") as sink:
        w = token_files.SequenceWriter(sink, np.dtype("<u2"), 8, batch=4)
        ids = np.arange(1, 100)
        for at in range(0, 99, 7):
            w.add(ids[at:at + 7])
        w.close()
    r = token_files.SequenceReader(f"file://{path}")
    got = [r.sequence(i, batch=4) for i in range(13)]
    flat = np.concatenate([a[np.array(m.to_pylist())] for a, m in got])
    assert flat.tolist() == ids.tolist() and all(len(a) == 8 for a, _ in got)
    assert got[0][0].base is not None
    assert np.concatenate(list(r.span(30, 45, batch=4))).tolist() == list(range(31, 76))


def test_op8_against_brute_force(spark, documents):
    rows = {r.doc_id: r for r in E.queries()["op8_spotsigs"](spark, SF).collect()}
    order = sorted(documents, reverse=True)
    for i, nxt in zip(order, order[1:] + order[:1]):
        t, cut = documents[i], len(documents[i]) // 3
        edited = t[:len(t) - cut] + documents[nxt][:cut]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b, e = (set(spotsigs.parse(f).tolist()) for f in
                   (r.fingerprint, rows[nxt].fingerprint, r.edited_fingerprint))
        assert abs(r.near_next - len(a & b) / len(a | b)) < 1e-9
        assert abs(r.near_edited - len(a & e) / len(a | e)) < 1e-9
    near = [r.near_edited - r.near_next for r in rows.values()]
    assert np.mean(np.array(near) > 0.05) > 0.95


def test_spotsigs_near_duplicates(spark, documents):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    texts = list(documents.items())
    sets = {i: set(s.tolist()) for (i, _), s in
            zip(texts, spotsigs.signatures(pa.array([t for _, t in texts])))}
    got = {r.key: (r.class_id, r.n_links) for r in spotsigs.near_duplicates(df, block=16).collect()}
    assert got == _groups(sets, _similar(sets, 0.8))


def test_op6_against_brute_force(spark):
    import base64
    pages = {r[0]: (r[2] or "").encode() for r in _read("pages")}
    first = {}
    for i in sorted(pages, reverse=True):
        first[pages[i]] = i
    for r in E.queries()["op6_warc"](spark, SF).collect():
        body = pages[r.page_id]
        assert r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (r.record_type, r.refers_to) == (
            ("response", None) if first[body] == r.page_id else ("revisit", first[body]))


def test_coalesced_ranges():
    ranges = [(0, 10), (10, 5), (40, 5), (1000, 10), (1005, 50), (3000, 5000)]
    got = list(warc.coalesced(ranges, gap=30, most=2000))
    assert [(a, b) for a, b, _ in got] == [(0, 45), (1000, 1055), (3000, 8000)]
    assert [r for _, _, g in got for r in g] == ranges


def test_pipeline_stages(spark):
    """Every stage against a plain version over its own input."""
    import corpus_pipeline as C
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, scratch = docs.columns, Scratch(spark, "t-pipeline")
    kept = [docs]
    for i, (_, stage) in enumerate(C.STAGES):
        out = scratch.keep(stage(spark, kept[-1], SF), f"s{i}")
        if i < 4:
            assert out.columns == columns
        kept.append(out)
    ids = [[r[0] for r in k.select("doc_id").collect()] for k in kept]
    good = {r.doc_id for r in E.queries()["op7_quality"](spark, SF).where("predicted = 1").collect()}
    assert sorted(ids[1]) == sorted(good)
    clean = {r.doc_id for r in E.queries()["op4_toxicity"](spark, SF).where("predicted = 0").collect()}
    assert sorted(ids[2]) == sorted(good & clean)
    of = {r.row.doc_id: r.class_id for r in ngram_join.join_ngrams(kept[2], carry=["doc_id"]).collect()}
    assert sorted(ids[3]) == sorted(set(of.values()))
    taken = {r.row.doc_id: r.taken // max(1, r.size)
             for r in __import__("tidemark.llm.mixing", fromlist=["x"]).mix_sources(kept[3]).collect()}
    assert collections.Counter(ids[4]) == collections.Counter({i: n for i, n in taken.items() if n})
    assert sorted(ids[5]) == sorted(ids[4])
    whole = C.run(spark, SF)
    assert sorted(tuple(r) for r in whole.collect()) == sorted(tuple(r) for r in kept[5].collect())


def test_pipeline_reads_its_ids_back(spark, documents):
    import corpus_pipeline as C
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = C.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in documents.items()}
