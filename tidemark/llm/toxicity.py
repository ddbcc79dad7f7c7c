"""Toxicity: a linear-chain conditional random field over words.

Every word of a text is tagged toxic or not.  Words emit by hashed
features (the word, its first 3 to 6 and last 3 letters), tags follow each
other by a 2 x 2 table.  Labels exist for documents only, so the training
tokens are labelled through a lexicon: features that keep to toxic
documents.  Forward-backward marginals give each word's probability of
being toxic; their sum gives the document's score through a logistic link,
and words above one half give the offending offsets.

With two tags, forward and backward messages are ratios that each word
maps by a Moebius transform (a 2 x 2 matrix); chains of all documents of a
slice are concatenated, cut into rows, and run in two passes (products of
rows, then messages), which is exact and vectorised whatever the lengths.

Fitted in one task from a bounded labelled sample (``PER_CLASS``
documents of each label); scoring is one narrow pass with the model
(``DIMENSIONS`` floats) broadcast.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import Lookup, map_texts, spaced, split_distinct
from tidemark.llm.labelled import fit_in_task, fitting_sample

DIMENSIONS = 1 << 18
PER_CLASS = 1000
#: A lexicon feature's least share of the toxic training documents beyond
#: those that cover a document no other feature covers, and its least
#: share of toxic among the documents that hold it (labels weighed alike).
LEAST_SHARE, LEAST_PURITY = 0.02, 0.98
#: Lexicon features that chance alone may let in, in expectation.
CHANCE = 0.05
#: Expected toxic words that say nothing: added before the logarithm.
LEAST_MASS = 0.1
EMPTY = -30.0
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def normal(word: str) -> str:
    return word.strip(_EDGES).lower()


def word_features(word: str) -> list[str]:
    """Features of a normal form; the first is the word itself."""
    return ["w" + word, *[f"p{n}{word[:n]}" for n in (3, 4, 5, 6) if len(word) >= n],
            "s" + word[-3:]]


def feature_ids(word: str) -> list[int]:
    return [zlib.crc32(f.encode()) % DIMENSIONS for f in word_features(word)]


class Words(NamedTuple):
    """Words of some texts: distinct surface words, the place of each word
    of each text among them, where texts start and end."""
    distinct: list[str]
    place: np.ndarray
    cuts: np.ndarray


def words_of(texts: pa.Array) -> Words:
    return Words(*split_distinct(spaced(texts)))


# -- chain ------------------------------------------------------------------

class Chain(NamedTuple):
    """Transition weights (4 potentials: from clean/toxic to clean/toxic)
    and the odds of a first word being toxic."""
    cc: float
    ct: float
    tc: float
    tt: float
    first: float


def _messages(e, to_clean_c, to_clean_t, to_toxic_c, to_toxic_t):
    """Ratios r_t = e_t (to_toxic_c + to_toxic_t r) / (to_clean_c +
    to_clean_t r), r the ratio before (arrays per word, r = 1 before the
    first).  Exact scan over rows of about the root of the length."""
    n = len(e)
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)

    def grid(x, fill):
        g = np.full(rows * width, fill)
        g[:n] = x
        return np.ascontiguousarray(g.reshape(rows, width).T)

    a, b = grid(e * to_toxic_t, 1.0), grid(e * to_toxic_c, 0.0)   # r' = (a r + b) / (c r + d)
    c, d = grid(to_clean_t, 0.0), grid(to_clean_c, 1.0)
    pa_, pb, pc, pd = a[0].copy(), b[0].copy(), c[0].copy(), d[0].copy()
    for i in range(1, width):
        pa_, pb, pc, pd = (a[i] * pa_ + b[i] * pc, a[i] * pb + b[i] * pd,
                           c[i] * pa_ + d[i] * pc, c[i] * pb + d[i] * pd)
        if i % 8 == 0:
            s = 1 / (pa_ + pb + pc + pd)
            pa_, pb, pc, pd = pa_ * s, pb * s, pc * s, pd * s
    enter, r = np.empty(rows), 1.0
    for k in range(rows):
        enter[k] = r
        r = (pa_[k] * r + pb[k]) / (pc[k] * r + pd[k])
    out, r = np.empty((width, rows)), enter
    for i in range(width):
        r = (a[i] * r + b[i]) / (c[i] * r + d[i])
        out[i] = r
    return out.T.ravel()[:n]


def marginals(odds: np.ndarray, cuts: np.ndarray, chain: Chain):
    """(P(toxic) per word, forward ratios, backward ratios).  ``odds``:
    exponentials of the emissions; ``cuts``: where texts start and end."""
    n = len(odds)
    starts = np.zeros(n, bool)
    starts[cuts[:-1][np.diff(cuts) > 0]] = True
    ends = np.zeros(n, bool)
    ends[cuts[1:][np.diff(cuts) > 0] - 1] = True
    # at a text's start the message ignores what came before
    fwd = _messages(odds, np.where(starts, 1.0, chain.cc), np.where(starts, 0.0, chain.tc),
                    np.where(starts, chain.first, chain.ct), np.where(starts, 0.0, chain.tt))
    # backwards: s_t = (tc + tt e s) / (cc + ct e s) of the next word
    nxt = np.concatenate([odds[1:], [1.0]])
    bwd = _messages(np.ones(n), np.where(ends, 1.0, chain.cc)[::-1],
                    np.where(ends, 0.0, chain.ct * nxt)[::-1],
                    np.where(ends, 1.0, chain.tc)[::-1],
                    np.where(ends, 0.0, chain.tt * nxt)[::-1])[::-1]
    joint = fwd * bwd
    return joint / (1 + joint), fwd, bwd


# -- model ------------------------------------------------------------------

class Tagger(NamedTuple):
    weights: np.ndarray  # (DIMENSIONS,) emission weights
    chain: Chain
    slope: float
    offset: float

    def emission(self, word: str) -> float:
        w = normal(word)
        if not w:
            return EMPTY
        return float(np.clip(sum(self.weights[i] for i in feature_ids(w)), -30, 30))

    def link(self, mass: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * np.log(mass + LEAST_MASS), -40, 40)))


def _mass(p: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Expected number of toxic words of each text."""
    run = np.concatenate([[0.0], np.cumsum(p)])
    return np.maximum(run[cuts[1:]] - run[cuts[:-1]], 0.0)


class Vocabulary(NamedTuple):
    """Normal forms of some words: each surface word's place among them,
    and the hashed features of each (``feature`` holds those of word i
    from ``starts[i]`` up to ``starts[i + 1]``; full 32-bit hashes)."""
    normals: list[str]
    place: np.ndarray
    feature: np.ndarray
    starts: np.ndarray


def vocabulary(distinct: list[str]) -> Vocabulary:
    at: dict[str, int] = {}
    place = np.fromiter((at.setdefault(normal(w), len(at)) for w in distinct), np.int32,
                        len(distinct))
    lens, feature = np.zeros(len(at), np.int32), []
    for i, w in enumerate(at):
        if w:
            f = [zlib.crc32(x.encode()) for x in word_features(w)]
            lens[i] = len(f)
            feature.extend(f)
    return Vocabulary(list(at), place, np.array(feature, np.uint32),
                      np.concatenate([[0], np.cumsum(lens)]))


def lexicon(words: Words, vocab: Vocabulary, toxic: np.ndarray) -> np.ndarray:
    """Features (of words and of 4 to 6 first letters) that keep to toxic
    documents, as 32-bit hashes.  ``words`` are places in ``vocab``.

    Chosen greedily, each for the toxic documents that it alone covers so
    far, so words that merely share a document with an offence stay out;
    then every feature as pure that is frequent enough of its own.  Copies
    count once: documents with the same two least word hashes are one.
    """
    n = len(words.cuts) - 1
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(words.cuts))
    held = np.unique(doc * len(vocab.normals) + words.place)
    doc, word = held // len(vocab.normals), held % len(vocab.normals)
    lens = np.diff(vocab.starts)
    # copies: documents with equal least hashes
    hashes = np.fromiter((zlib.crc32(w.encode()) for w in vocab.normals), np.int64,
                         len(vocab.normals))
    first = np.searchsorted(doc, np.arange(n))
    least = np.minimum.reduceat(hashes[word], first)
    second = np.minimum.reduceat((hashes * 2654435761 % (1 << 32))[word], first)
    groups, group = np.unique(np.stack([least, second, toxic.astype(np.int64)]), axis=1,
                              return_inverse=True)
    group, is_toxic = group.ravel(), groups[2].astype(bool)
    # the features of interest of every word of every document
    use = np.ones(len(vocab.feature), bool)
    use[vocab.starts[1:][lens > 0] - 1] = False              # the last letters
    use[vocab.starts[:-1][lens > 2] + 1] = False             # the first three
    short = np.fromiter((len(w) < 3 for w in vocab.normals), bool, len(vocab.normals))
    use &= ~np.repeat(short, lens)
    feature, owner = vocab.feature[use], np.repeat(np.arange(len(lens)), lens)[use]
    lens = np.bincount(owner, minlength=len(lens))
    starts = np.cumsum(lens) - lens
    reps = lens[word]
    at = np.arange(reps.sum()) + np.repeat(starts[word] - (np.cumsum(reps) - reps), reps)
    held = np.unique((feature[at].astype(np.int64) << 24) | np.repeat(group[doc], reps))
    feature, group = held >> 24, held & ((1 << 24) - 1)
    names, feature = np.unique(feature, return_inverse=True)
    a = np.bincount(feature, is_toxic[group], minlength=len(names))
    c = np.bincount(feature, minlength=len(names)) - a

    # evidence against chance: n KL(share of toxic | share of toxic overall)
    # for n documents with the feature, beyond what the best of all
    # candidates would show by chance
    n_toxic, n_clean = max(1, is_toxic.sum()), max(1, (~is_toxic).sum())
    prior, q = n_toxic / (n_toxic + n_clean), a / (a + c)
    with np.errstate(divide="ignore", invalid="ignore"):
        evidence = (a + c) * (np.where(q > 0, q * np.log(q / prior), 0)
                              + np.where(q < 1, (1 - q) * np.log((1 - q) / (1 - prior)), 0))
        pure = (a >= 2) & (a / n_toxic >= LEAST_PURITY * (a / n_toxic + c / n_clean))
    if not pure.any():
        return names[:0]
    needed = np.log(max(1, (a >= 2).sum()) / CHANCE)
    # too few labels for certainty: the most certain there are
    pure &= evidence >= min(needed, evidence[pure].max())
    keep = pure[feature] & is_toxic[group]
    covers: dict[int, set[int]] = defaultdict(set)
    for f, g in zip(feature[keep].tolist(), group[keep].tolist()):
        covers[f].add(g)
    least_docs = max(2, int(np.ceil(LEAST_SHARE * n_toxic)))
    chosen, covered = [], set()
    while covers:
        best = max(covers, key=lambda f: (len(covers[f] - covered), -f))
        if len(covers[best] - covered) < max(2, least_docs // 2):
            break
        chosen.append(best)
        covered |= covers.pop(best)
    chosen += [f for f, held in covers.items() if len(held) >= least_docs]
    return names[np.array(sorted(chosen), np.int64)]


def fit(texts: pa.Array, toxic: np.ndarray, *, steps: int = 40, rate: float = 0.5,
        decay: float = 1e-3) -> Tagger:
    """Conditional likelihood of the lexicon's tags by Adagrad, then the
    logistic link from expected toxic words to the documents' labels.
    Without both labels nothing is toxic."""
    weights, chain = np.zeros(DIMENSIONS), Chain(1.0, 0.01, 0.5, 0.5, 0.01)
    if len(toxic) == 0 or toxic.min() == toxic.max():
        return Tagger(weights - 6.0, chain, 1.0, -3.0)
    toxic = toxic.astype(bool)
    words = words_of(texts)
    vocab = vocabulary(words.distinct)
    place = vocab.place[words.place]
    words = Words([], place, words.cuts)
    size = len(vocab.normals)
    owner = np.repeat(np.arange(size), np.diff(vocab.starts))
    listed = np.zeros(size, bool)
    listed[owner[np.isin(vocab.feature, lexicon(words, vocab, toxic))]] = True
    flat = (vocab.feature % DIMENSIONS).astype(np.int64)
    tags = listed[place].astype(np.float64)
    empty = np.diff(vocab.starts) == 0
    n = len(words.place)
    first = np.zeros(n, bool)
    first[words.cuts[:-1]] = True
    inner = np.flatnonzero(~first)
    trans = np.log(np.array([1.0, 0.01, 0.5, 0.5]))  # cc, ct, tc, tt
    seen_w, seen_t = np.full(DIMENSIONS, 1e-6), np.full(4, 1e-6)
    weights -= 1.5  # a word of unseen features is clean
    count = np.zeros(4)
    for k, (i, j) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
        count[k] = ((tags[inner - 1] == i) & (tags[inner] == j)).sum()
    for _ in range(steps):
        chain = Chain(*np.exp(trans), float(np.exp(trans[1])))
        emission = np.clip(np.bincount(owner, weights[flat], minlength=size), -30, 30)
        emission[empty] = EMPTY
        odds = np.exp(emission)[words.place]
        p, fwd, bwd = marginals(odds, words.cuts, chain)
        grad = np.bincount(words.place, p - tags, minlength=size)
        g = (np.bincount(flat, grad[owner], minlength=DIMENSIONS) + decay * weights)
        seen_w += g * g
        weights -= rate * g / np.sqrt(seen_w)
        before, e_s = fwd[inner - 1], odds[inner] * bwd[inner]
        pairs = np.stack([np.full(len(inner), chain.cc), chain.ct * e_s,
                          before * chain.tc, before * chain.tt * e_s])
        g_t = (pairs / pairs.sum(axis=0)).sum(axis=1) - count + decay * trans
        seen_t += g_t * g_t
        trans -= 0.3 * rate * g_t / np.sqrt(seen_t)
        trans -= trans[0]
    chain = Chain(*np.exp(trans), float(np.exp(trans[1])))
    emission = np.clip(np.bincount(owner, weights[flat], minlength=size), -30, 30)
    emission[empty] = EMPTY
    p, _, _ = marginals(np.exp(emission)[words.place], words.cuts, chain)
    x = np.log(_mass(p, words.cuts) + LEAST_MASS)
    slope, offset = 1.0, 0.0
    for _ in range(50):  # Newton steps, ridge 0.01
        q = 1 / (1 + np.exp(-np.clip(offset + slope * x, -40, 40)))
        r, h = q - toxic, q * (1 - q) + 1e-6
        gradient = np.array([(r * x).sum() + 0.01 * slope, r.sum() + 0.01 * offset])
        hessian = np.array([[(h * x * x).sum() + 0.01, (h * x).sum()],
                            [(h * x).sum(), h.sum() + 0.01]])
        step = np.linalg.solve(hessian, gradient)
        slope, offset = slope - np.clip(step[0], -1, 1), offset - np.clip(step[1], -2, 2)
    return Tagger(weights.astype(np.float32), chain, float(max(slope, 0.0)), float(offset))


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic",
          per_class: int = PER_CLASS) -> Tagger:
    """Fit on at most ``per_class`` labelled documents of each label,
    held-out rows excluded."""
    return fit_in_task(fitting_sample(docs, labels, label, per_class=per_class), fit)


def _spans(words: Words, lengths: np.ndarray, toxic: np.ndarray) -> pa.Array:
    """Character offsets [start, end) of runs of toxic words, per text."""
    ends = np.cumsum(lengths + 1)
    starts = ends - lengths - 1
    base = np.concatenate([[0], ends])[words.cuts[:-1]]
    doc = np.searchsorted(words.cuts, np.arange(len(toxic)), side="right") - 1
    at = np.flatnonzero(toxic)
    spans: list[list] = [[] for _ in range(len(words.cuts) - 1)]
    last = -2
    for i in at:
        d = doc[i]
        s, e = int(starts[i] - base[d]), int(ends[i] - 1 - base[d])
        if i == last + 1 and spans[d]:
            spans[d][-1]["end"] = e
        else:
            spans[d].append({"start": s, "end": e})
        last = i
    return pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))


def score_toxicity(docs: DataFrame, model: Tagger, *, text: str = "text",
                   carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``carry`` columns, all by default), ``score``
    (0 to 1, higher: toxic likelier) and ``spans`` (character offsets of
    the offending words, runs merged).

    Null and empty texts have no toxic words; repeated rows score alike;
    no rows give no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def make():
        own = Tagger(*shared.value)
        weights = own.weights

        def emission(word):
            w = normal(word)
            return min(30.0, max(-30.0, float(weights[feature_ids(w)].sum()))) if w else EMPTY

        known = Lookup(emission, 300_000)

        def work(texts):
            words = words_of(texts)
            odds = np.exp(np.fromiter(map(known.__getitem__, words.distinct), np.float64,
                                      len(words.distinct)))[words.place]
            p, _, _ = marginals(odds, words.cuts, own.chain)
            chars = pa.compute.utf8_length(pa.array(words.distinct, pa.string())).to_numpy(
                zero_copy_only=False)
            return [pa.array(own.link(_mass(p, words.cuts)), pa.float64()),
                    _spans(words, chars[words.place].astype(np.int64), p >= 0.5)]
        return work

    return map_texts(docs, text, docs.columns if carry is None else carry,
                     "score double, spans array<struct<start:long,end:long>>", make, max_bytes=2 << 20)
