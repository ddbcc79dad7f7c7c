"""Encoders against their libraries where words and marks meet, and the
bounded table of known segments."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import byte_bpe, token_files
from tidemark.llm.common import SegmentTable


@pytest.fixture(scope="module")
def words():
    P, tokenizers = pytest.importorskip("public_tokenizers"), pytest.importorskip("tokenizers")
    definition = open(P.path("word_bpe_49k.json"), encoding="utf-8").read()
    return token_files.WordTokenizer(definition), tokenizers.Tokenizer.from_str(definition)


def _same(words, texts):
    own, lib = words
    want = lib.encode_batch(texts, add_special_tokens=False)
    return [t for t, a, b in zip(texts, own.encode(pa.array(texts)), want) if a.tolist() != b.ids]


LETTERS = [chr(c) for c in range(0x110000) if not 0xd800 <= c < 0xe000 and chr(c).isalpha()]


def test_marks_behind_every_letter(words):
    """Letters whose normal form ends in a combining mark keep the mark that
    follows them in one piece."""
    assert _same(words, [letter + m for letter in LETTERS for m in ".,"]) == []
    assert _same(words, ["ŞİRKETİ.", "İ,", "क़.", "ȧ.", "한."]) == []


def test_words_with_combining_marks(words):
    rng = random.Random(5)
    pool = (list("abcXYZ.,.,!?' \n|") + LETTERS[:1500] + list("İŞक़ড়יִ각한")
            + [chr(c) for c in range(0x300, 0x350)] + list("़়゙ּཱ"))
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for _ in range(60_000)]
    assert _same(words, texts) == []


@pytest.mark.parametrize("limit", [1, 5_000, 1 << 30])
def test_segment_table_forgets_without_a_trace(limit):
    calls = []

    def encode_many(keys):
        calls.append(len(keys))
        ids = [[ord(c) for c in (k if type(k) is str else k[0] * 2)] for k in keys]
        return (np.array([len(x) for x in ids], np.int64),
                np.array([i for x in ids for i in x], np.int32))

    table, rng = SegmentTable(encode_many, limit), random.Random(limit)
    vocabulary = ["".join(rng.choices("abcdef", k=rng.randint(0, 6))) for _ in range(60)]
    for _ in range(200):
        docs = [[(w,) if rng.random() < 0.2 else w for w in rng.choices(vocabulary, k=rng.randint(0, 9))]
                for _ in range(4)]
        index = table.indices([w for d in docs for w in d])
        out = table.encode(index, np.cumsum([0] + [len(d) for d in docs]))
        assert ["".join(map(chr, x)) for x in out] == [
            "".join(w if type(w) is str else w[0] * 2 for w in d) for d in docs]
    assert sum(calls) <= 2 * len(set(vocabulary)) if limit > 1 << 20 else True


def test_decoder_gathers_what_the_tokens_hold(monkeypatch):
    P = pytest.importorskip("public_tokenizers")
    ranks = byte_bpe.read_ranks(open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
    decoder, of = byte_bpe.Decoder(ranks), {r: t for t, r in ranks.items()}
    rng = np.random.default_rng(3)
    monkeypatch.setattr(byte_bpe, "DECODE_IDS", 37)
    lens = [0, 5, 0, 400, 1, 36, 38, 0]
    ids = rng.choice(np.array(sorted(of)), sum(lens))
    found = decoder.decode_many(ids, np.cumsum([0] + lens)).to_pylist()
    at = np.cumsum([0] + lens)
    assert found == [b"".join(of[i] for i in ids[a:b].tolist()) for a, b in zip(at[:-1], at[1:])]
    assert decoder.decode([]) == b""
    for wrong in ([max(of) + 1], [256, 10 ** 9]):
        with pytest.raises(KeyError):
            decoder.decode(wrong)
