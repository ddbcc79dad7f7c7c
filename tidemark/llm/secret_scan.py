"""Secret scans: rules first, then a linear-chain conditional random field.

Three rules find spans of known forms (``RULES``).  A chain tags every
token of a text as begin, inside or outside of a secret, from the token's
shape, its neighbouring words and features of the whole file, and is
decoded by Viterbi; its spans that touch no rule's span are added to those.

Tokens are runs between white space, quotes, brackets and the marks that
assign or separate.  A token whose shape keeps it outside whatever its
neighbours and its file (an exchange bound on the weights) cuts the chain
there, so Viterbi runs over the few stretches between such tokens and
still returns the best path of the whole text.

The chain learns from the rules' own matches in a bounded sample of
documents (``SAMPLE``), cut to windows in tasks.  Each match is also shown
with a plain word for its keyword, whole and shortened (a shape must
convince alone), and with a plain word for its value (a keyword must not).

Scale: one narrow pass, no shuffle; the model (``GROUPS`` tables of
``DIMENSIONS`` x 2 floats) is broadcast.
"""

from __future__ import annotations

import pickle
import re
import zlib
from bisect import bisect_right
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WHITE_SPACE, Lookup, map_texts, split_distinct

#: The rules by kind, in the order of their kinds, with the
#: group that is measured and its least length.
RULES = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     re.IGNORECASE | re.ASCII, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", re.ASCII, 0, 20),
    ("hex", r"[0-9a-f]+", re.ASCII, 0, 24),
]
#: The kind of the chain's spans.
CHAIN_KIND = "chain"
_KINDS = {k: i for i, k in enumerate([*(r[0] for r in RULES), CHAIN_KIND])}
_COMPILED = [(kind, re.compile(pattern, flags), group, least)
             for kind, pattern, flags, group, least in RULES]
#: A text that no rule's match of sufficient length can be in lacks this.
_MAY_MATCH = (r"(?i:password|passwd|secret|token|api_?key)[\x22']?\x20*[:=]\x20*[\x22']?[A-Za-z0-9+/_.=-]{6}"
              r"|AKIA[A-Z0-9]{16}|[0-9a-f]{24}")
#: White space and the other characters that part tokens.
_PARTS = WHITE_SPACE[:-1] + r"=:\"'`,;()<>\[\]{}|]"
_EDGES = ".!?*#-"

DIMENSIONS = 1 << 15
#: Tables of weights: of shapes, plain words, the token before, the one
#: behind, the file; and how far each is held to nothing while fitting.
SHAPE, WORD, BEFORE, AFTER, FILE = range(5)
GROUPS, HELD = 5, (0.02, 0.02, 1.0, 1.0, 1.0)
#: Documents that the chain is fitted on, at most, of at most so many
#: characters; matches of a document that give windows, of so many tokens to
#: both sides.
SAMPLE, LONGEST_FITTED, MATCHES, REACH = 8000, 60_000, 4, 5
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
#: Lengths of tokens that are told apart, and what secrets are shortened to.
LENGTHS, SHORTENED = (8, 12, 16, 24), 18


class Span(NamedTuple):
    start: int
    kind: str
    end: int


def rule_spans(text: str) -> list[Span]:
    """Matches of the rules, leftmost and non-overlapping within a kind."""
    found = [Span(m.start(), kind, m.end()) for kind, pattern, group, least in _COMPILED
             for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(found, key=lambda s: (s.start, _KINDS[s.kind]))


def written(spans) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


# -- tokens -------------------------------------------------------------------

class Tokens(NamedTuple):
    """Tokens of some texts: distinct ones, the place of each among them,
    its first character, and where each text's tokens start and end."""
    distinct: list[str]
    place: np.ndarray
    start: np.ndarray
    cuts: np.ndarray


def tokens_of(texts: pa.Array) -> Tokens:
    flat = pa.compute.replace_substring_regex(texts, _PARTS, " ")
    distinct, place, cuts = split_distinct(flat)
    lens = pa.compute.utf8_length(pa.array(distinct, pa.string())).to_numpy(zero_copy_only=False)
    run = np.cumsum(lens[place].astype(np.int64) + 1)
    start = run - lens[place] - 1
    start -= np.repeat(np.concatenate([[0], run])[cuts[:-1]], np.diff(cuts))
    real = lens[place] > 0
    kept = np.concatenate([[0], np.cumsum(real)])
    return Tokens(distinct, place[real], start[real], kept[cuts])


def _word_hash(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % DIMENSIONS


def _hash(group: int, feature: str) -> int:
    return group * DIMENSIONS + _word_hash(feature)


_SORTS = str.maketrans({**{chr(c): "a" for c in range(97, 123)}, **{chr(c): "A" for c in range(65, 91)},
                        **{chr(c): "0" for c in range(48, 58)}})
_DIGIT, _TURNS = re.compile("[0-9]").search, re.compile("(?<=0)[^0]|(?<=[^0])0").findall


class Shape(NamedTuple):
    """What a token looks like, apart from its letters and its neighbours:
    how many of ``LENGTHS`` it reaches, counts by powers of two."""
    length: int
    kinds: int
    foreign: bool
    plain: bool = True
    letters: bool = True
    digits: bool = False
    turns: int = 0
    odd: int = 0
    at: bool = False


def shape_of(word: str) -> Shape:
    length, kinds = bisect_right(LENGTHS, len(word)), min(len(set(word)).bit_length(), 4)
    if word.isalpha():
        return Shape(length, kinds, not word.isascii())
    sorts = word.translate(_SORTS)
    ascii_letters, digits = sorts.count("a") + sorts.count("A"), sorts.count("0")
    foreign = sum(c.isalnum() for c in sorts) - ascii_letters - digits
    return Shape(length, kinds, foreign > 0, False, ascii_letters + foreign > 0, digits > 0,
                 min(len(_TURNS(sorts)).bit_length(), 3),
                 min(len(word) - ascii_letters - digits - foreign, 2), "@" in word)


def features_of_shape(s: Shape) -> list[int]:
    # one feature for each length, reached or not: what holds of long secrets
    # holds of shorter ones as far as these share them
    mixed = s.letters and s.digits
    return [_hash(SHAPE, x) for x in (
        f"m{s.letters:d}{s.digits:d}", f"t{s.turns}", f"o{s.odd}{s.at:d}{s.foreign:d}",
        f"k{s.kinds}", f"w{s.plain:d}",
        *(f"n{n}{s.length > n:d}{mixed:d}" for n in range(len(LENGTHS))))]


#: In place of the word of a token that is not one.
_NO_WORD = _hash(WORD, "")


def token_features(token: str) -> list[int]:
    """Features of a token's own."""
    word = token.strip(_EDGES)
    shape = shape_of(word)
    return [*features_of_shape(shape), _hash(WORD, word.lower()) if shape.plain else _NO_WORD]


def before_feature(token: str) -> int:
    return _hash(BEFORE, token.strip(_EDGES).lower())


def after_feature(token: str) -> int:
    return _hash(AFTER, token.strip(_EDGES).lower())


_NOTHING_BEFORE, _NOTHING_AFTER = _hash(BEFORE, ""), _hash(AFTER, "")


def file_features(n_tokens: int, n_digits: int) -> list[int]:
    """Length of a text, and its share of tokens with a digit."""
    share = int(256 * n_digits / max(1, n_tokens))
    return [_hash(FILE, f"f{min(n_tokens.bit_length(), 14)}"),
            _hash(FILE, f"d{min(share.bit_length(), 8)}")]


def _has_digit(token: str) -> bool:
    return _DIGIT(token) is not None


# -- model --------------------------------------------------------------------

class Chain(NamedTuple):
    """Weights of features for begin and inside (outside is 0), and of
    transitions from row to column; texts begin and end outside."""
    weights: np.ndarray   # (GROUPS * DIMENSIONS, 2)
    moves: np.ndarray     # (3, 3)


def viterbi(emission: np.ndarray, moves: np.ndarray) -> list[int]:
    """Best tags of a stretch between two outside tokens; ties to the least."""
    e = emission.tolist()
    m = moves.tolist()
    score, back = [m[OUTSIDE][b] + x for b, x in enumerate((0.0, *e[0]))], []
    for x in e[1:]:
        step = [max(range(3), key=lambda a: (score[a] + m[a][b], -a)) for b in range(3)]
        score = [score[a] + m[a][b] + y for b, (a, y) in enumerate(zip(step, (0.0, *x)))]
        back.append(step)
    tag = max(range(3), key=lambda a: (score[a] + m[a][OUTSIDE], -a))
    tags = [tag]
    for step in reversed(back):
        tag = step[tag]
        tags.append(tag)
    return tags[::-1]


def outside_bound(moves: np.ndarray) -> np.ndarray:
    """For begin and inside, the most that transitions can favour it over
    outside, whatever the tags beside: where an emission stays below minus
    this, outside is better on every path."""
    x, y = moves[:, 1:], moves[1:, :]           # into the tag, out of the tag
    into = (x - moves[:, :1]).max(axis=0)       # against outside, by neighbour
    out = (y - moves[:1, :]).max(axis=1)
    return into + out


def expectations(emission: np.ndarray, mask: np.ndarray, moves: np.ndarray):
    """Forward-backward over padded windows (n, length, 3): (tag marginals,
    expected transitions).  Short windows, so plain products do."""
    n, length, _ = emission.shape
    e, m = np.exp(np.clip(emission, -25, 25)), np.exp(moves)
    forward, backward = np.empty((n, length, 3)), np.empty((n, length, 3))
    forward[:, 0] = m[OUTSIDE] * e[:, 0]
    for t in range(1, length):
        step = (forward[:, t - 1] @ m) * e[:, t]
        forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
    backward[:, -1] = m[:, OUTSIDE]
    for t in range(length - 2, -1, -1):
        step = (e[:, t + 1] * backward[:, t + 1]) @ m.T
        backward[:, t] = np.where(mask[:, t + 1, None], step, backward[:, t + 1])
    total = forward[:, -1] @ m[:, OUTSIDE]
    tags = forward * backward / total[:, None, None] * mask[:, :, None]
    ahead = (e * backward)[:, 1:] * mask[:, 1:, None] / total[:, None, None]
    expected = np.einsum("nta,ntb->ab", forward[:, :-1], ahead) * m
    expected[OUTSIDE] += tags[:, 0].sum(axis=0)
    expected[:, OUTSIDE] += tags[np.arange(n), mask.sum(axis=1) - 1].sum(axis=0)
    return tags, expected


def fit(features: np.ndarray, tags: np.ndarray, *, steps: int = 100, rate: float = 0.5) -> Chain:
    """Conditional likelihood by Adagrad.  ``features``: (windows, length,
    k) hashed features, -1 behind a window's end; ``tags``: (windows,
    length), -1 there.  Without a secret nothing is one."""
    weights = np.zeros((GROUPS * DIMENSIONS, 2))
    moves = np.array([[0.0, -2.0, -4.0], [0.0, -3.0, -1.0], [0.0, -3.0, -1.0]])
    if not len(tags) or not (tags > 0).any():
        weights[WORD * DIMENSIONS:BEFORE * DIMENSIONS] = -8.0
        return Chain(weights, moves)
    mask = tags >= 0
    # rows of features of the tokens alone, each feature by its place
    used, place = np.unique(features[mask], return_inverse=True)
    place = place.reshape(-1, features.shape[2])
    held = np.array(HELD)[used // DIMENSIONS][:, None]
    w, start = np.zeros((len(used), 2)), np.zeros((len(used), 2))
    gold = np.stack([tags[mask] == BEGIN, tags[mask] == INSIDE], axis=1).astype(float)
    before = np.concatenate([np.zeros((len(tags), 1), int), np.where(mask, tags, 0)[:, :-1]], axis=1)
    count = np.zeros((3, 3))
    np.add.at(count, (before[mask], tags[mask]), 1)
    np.add.at(count, (tags[np.arange(len(tags)), mask.sum(axis=1) - 1], OUTSIDE), 1)
    seen_w, seen_m = np.full(w.shape, 1e-6), np.full((3, 3), 1e-6)
    emission = np.zeros((*tags.shape, 3))
    for _ in range(steps):
        emission[mask, 1:] = w[place].sum(axis=1)
        p, expected = expectations(emission, mask, moves)
        error = p[mask][:, 1:] - gold
        g = np.stack([np.bincount(place.ravel(), np.repeat(error[:, c], place.shape[1]),
                                  minlength=len(used)) for c in range(2)], axis=1)
        g += held * (w - start)
        seen_w += g * g
        w -= rate * g / np.sqrt(seen_w)
        g = expected - count + 0.1 * moves
        seen_m += g * g
        moves = moves - 0.2 * rate * g / np.sqrt(seen_m)
    weights[used] = w
    return Chain(weights.astype(np.float32).astype(np.float64), moves)


# -- training windows -----------------------------------------------------------

def _overlaps(start, end, spans) -> bool:
    return any(start < s.end and s.start < end for s in spans)


def _tagged(text: str, start: np.ndarray, words: list[str]) -> list[list[int]]:
    """Tokens of each secret of the rules: a match, with those that it
    overlaps."""
    found: list[list[int]] = []
    for s in rule_spans(text):
        lo = int(np.searchsorted(start, s.start, "right")) - 1
        if lo < 0 or start[lo] + len(words[lo]) <= s.start:
            lo += 1
        inside = list(range(lo, int(np.searchsorted(start, s.end))))
        if inside and found and inside[0] <= found[-1][-1]:
            found[-1] = list(range(found[-1][0], max(found[-1][-1], inside[-1]) + 1))
        elif inside:
            found.append(inside)
    return found


def windows_of(texts: pa.Array, matches: int = MATCHES, reach: int = REACH):
    """(features, tags) of windows around matches, an odd token and the
    middle one; each match also with a plain word for its keyword, shortened
    so, and with a plain word for its value."""
    t = tokens_of(texts)
    odd = np.fromiter((_has_digit(w) or len(w) > 14 for w in t.distinct), bool, len(t.distinct))
    digits = np.fromiter(map(_has_digit, t.distinct), bool, len(t.distinct))
    may = pa.compute.match_substring_regex(texts, _MAY_MATCH).to_pylist()
    width, own = 2 * reach + 1, Lookup(token_features, 100_000)
    out_f, out_t = [], []

    def window(words, tags, at, file):
        lo, hi = max(0, at - reach), min(len(words), at + reach + 1)
        rows = [[*own[words[i]], before_feature(words[i - 1]) if i else _NOTHING_BEFORE,
                 after_feature(words[i + 1]) if i + 1 < len(words) else _NOTHING_AFTER, *file]
                for i in range(lo, hi)]
        pad = width - len(rows)
        out_f.append(rows + [[-1] * len(rows[0])] * pad)
        out_t.append([*tags[lo:hi], *[-1] * pad])

    for d, text in enumerate(texts.to_pylist()):
        a, b = int(t.cuts[d]), int(t.cuts[d + 1])
        if a == b:
            continue
        place, start = t.place[a:b], t.start[a:b]
        words = [t.distinct[i] for i in place.tolist()]
        file = file_features(b - a, int(digits[place].sum()))
        tags, secrets = [OUTSIDE] * len(words), _tagged(text, start, words) if may[d] else []
        for tokens in secrets:
            tags[tokens[0]] = BEGIN
            for i in tokens[1:]:
                tags[i] = INSIDE
        plain = [w for w, g in zip(words[:100], tags) if g == OUTSIDE and w.isalpha()] or ["a"]
        for n, tokens in enumerate(secrets[:matches]):
            at, value = tokens[0], tokens[-1]
            window(words, tags, at, file)
            other = plain[n % len(plain)]
            alone, changed = list(tags), list(words)
            for i in tokens[:-1]:
                alone[i], changed[i] = OUTSIDE, other
            alone[value] = BEGIN
            if len(tokens) > 1:
                window(changed, alone, value, file)
            changed[value] = changed[value].strip(_EDGES)[:SHORTENED]
            window(changed, alone, value, file)
            without, changed = list(tags), list(words)
            changed[value] = other
            for i in tokens:
                without[i] = OUTSIDE
            window(changed, without, at, file)
        rest = [i for i in np.flatnonzero(odd[place]).tolist() if tags[i] == OUTSIDE]
        for at in [*rest[len(rest) // 2:][:1], len(words) // 2]:
            window(words, tags, at, file)
    if not out_t:
        k = len(token_features("")) + 4
        return np.zeros((0, width, k), np.int32), np.zeros((0, width), np.int8)
    return np.array(out_f, np.int32), np.array(out_t, np.int8)


def train(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
          sample: int = SAMPLE, longest: int = LONGEST_FITTED) -> Chain:
    """Fitted on windows of at most ``sample`` documents of at most
    ``longest`` characters (in the order of md5 of the key; null keys and
    texts are left out)."""
    some = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).where(
        F.col("key").isNotNull() & (F.length("text") <= longest))
    order = F.md5(F.concat(F.lit("scan:"), F.col("key").cast("string")))
    chosen = some.select("key", order.alias("order")).distinct().orderBy("order", "key").limit(sample)
    # a key's least text; the chosen keys are at most ``sample``
    texts = (some.join(F.broadcast(chosen), "key").groupBy("key", "order")
             .agg(F.min("text").alias("text")).select("order", "text"))

    def cut(batches):
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                features, tags = windows_of(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column(0)[0].as_py()]), pa.array([pickle.dumps((features, tags))])],
                    ["order", "windows"])

    def learn(batches):
        parts = [pickle.loads(x) for b in batches for x in b.column(1).to_pylist()]
        if parts:
            chain = fit(*(np.concatenate(x) for x in zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(chain)])], ["model"])

    cut_rows = texts.mapInArrow(cut, "order string, windows binary")
    found = (cut_rows.repartition(1).sortWithinPartitions("order")
             .mapInArrow(learn, "model binary").collect())  # one row
    return pickle.loads(found[0]["model"]) if found else fit(*windows_of(pa.array([], pa.string())))


# -- scanning -------------------------------------------------------------------

class Scanner:
    """Spans of texts under a model."""

    def __init__(self, model: Chain):
        self._moves, self._weights = model.moves, model.weights
        self._bound = outside_bound(model.moves)
        self._known = Lookup(self._of_token, 300_000)
        self._shapes: dict[Shape, int] = {}  # bounded by the sorts of shapes
        self._of_shape = np.zeros((0, 3))    # emissions, and whether it is a plain word

    def _of_token(self, token: str) -> int:
        """A token's shape, hash and digit in one number."""
        word = token.strip(_EDGES)
        shape = self._shapes.setdefault(shape_of(word), len(self._shapes))
        return (shape * DIMENSIONS + _word_hash(word.lower())) * 2 + _has_digit(token)

    def _emissions(self, t: Tokens) -> np.ndarray:
        """(tokens, 2) emissions of all texts."""
        code = np.fromiter(map(self._known.__getitem__, t.distinct), np.int64, len(t.distinct))
        new = list(self._shapes)[len(self._of_shape):]
        if new:
            self._of_shape = np.concatenate([self._of_shape, [
                [*self._weights[features_of_shape(s)].sum(axis=0), s.plain] for s in new]])
        shape, word = code // 2 // DIMENSIONS, code // 2 % DIMENSIONS
        own = self._of_shape[shape, :2] + self._weights[np.where(
            self._of_shape[shape, 2] > 0, WORD * DIMENSIONS + word, _NO_WORD)]
        known = np.concatenate([own, self._weights[BEFORE * DIMENSIONS + word],
                                self._weights[AFTER * DIMENSIONS + word], (code % 2)[:, None]], axis=1)
        cuts = t.cuts
        full = np.flatnonzero(np.diff(cuts))
        firsts, lasts = cuts[:-1][full], cuts[1:][full] - 1
        out = known[t.place, 0:2]
        out[1:] += known[t.place[:-1], 2:4]
        out[:-1] += known[t.place[1:], 4:6]
        # over the ends of texts, nothing stands beside a token
        out[firsts[1:]] -= known[t.place[firsts[1:] - 1], 2:4]
        out[lasts[:-1]] -= known[t.place[lasts[:-1] + 1], 4:6]
        out[firsts] += self._weights[_NOTHING_BEFORE]
        out[lasts] += self._weights[_NOTHING_AFTER]
        run = np.concatenate([[0.0], np.cumsum(known[t.place, 6])])
        lens, digits = np.diff(cuts), run[cuts[1:]] - run[cuts[:-1]]
        file = np.array([self._weights[file_features(int(n), int(d))].sum(axis=0)
                         for n, d in zip(lens, digits)]).reshape(-1, 2)
        return out + np.repeat(file, lens, axis=0)

    def chain_spans(self, texts: pa.Array) -> list[list[tuple[int, int]]]:
        """Per text, [start, end) of the chain's spans in characters."""
        t = tokens_of(texts)
        found: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
        if not len(t.place):
            return found
        emission = self._emissions(t)
        at = np.flatnonzero((emission + self._bound).max(axis=1) >= 0)
        if not len(at):
            return found
        owner = np.searchsorted(t.cuts, at, side="right") - 1
        # stretches of tokens that may be inside, within one text
        new = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(owner) > 0)])
        for stretch, d in zip(np.split(at, np.flatnonzero(new)[1:]), owner[new].tolist()):
            begin = None
            for i, tag in zip(stretch.tolist(), viterbi(emission[stretch], self._moves)):
                if tag == OUTSIDE:
                    begin = None
                    continue
                token = t.distinct[t.place[i]]
                s = int(t.start[i]) + len(token) - len(token.lstrip(_EDGES))
                end = int(t.start[i]) + len(token.rstrip(_EDGES))
                if end <= s:
                    continue
                if tag == BEGIN or begin is None:
                    begin = s
                    found[d].append((s, end))
                else:
                    found[d][-1] = (begin, end)
        return found

    def scan(self, texts: pa.Array) -> list[tuple[list[Span], list[Span]]]:
        """Per text (the rules' spans, all spans in order)."""
        may = pa.compute.match_substring_regex(texts, _MAY_MATCH).to_pylist()
        out = []
        for i, chain in enumerate(self.chain_spans(texts)):
            rules = rule_spans(texts[i].as_py()) if may[i] else []
            more = [Span(s, CHAIN_KIND, e) for s, e in chain if not _overlaps(s, e, rules)]
            out.append((rules, sorted([*rules, *more], key=lambda s: (s.start, _KINDS[s.kind]))
                        if more else rules))
        return out


def scan_secrets(docs: DataFrame, model: Chain, *, text: str = "text",
                 carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``carry`` columns, all by default), ``rules``
    and ``spans``: arrays of (kind, start, end) in characters, end exclusive,
    by start, then kind; ``rules`` holds those of the rules alone.

    Null and empty texts hold none; repeated rows have equal spans; no rows
    give no rows; extra columns ride along inside ``row``."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    kind = "array<struct<kind:string,start:long,end:long>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def make():
        scanner = Scanner(Chain(*shared.value))

        def work(texts):
            found = scanner.scan(texts)
            return [pa.array([[{"kind": s.kind, "start": s.start, "end": s.end} for s in x[c]]
                              for x in found], arrow) for c in (0, 1)]
        return work

    return map_texts(docs, text, docs.columns if carry is None else carry,
                     f"rules {kind}, spans {kind}", make, max_bytes=2 << 20)


def joined(spans: str):
    """Column: the spans of an array column, ``kind:start:end``, by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
