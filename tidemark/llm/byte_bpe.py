"""Byte-level BPE encoding and decoding with padded numpy matrices.

Texts are cut into pieces by the vocabulary's pattern; every distinct
piece is encoded once a worker.  Pieces of similar length share a padded
matrix of token ids.  Each round every row merges its leftmost pair of
minimum rank: the ranks of adjacent pairs sit in a second matrix, only the
two pairs beside a merge are looked up again (in an open-addressing hash
table), the merged row is compacted by one column, and finished rows leave
the matrix.

Decoding gathers the bytes of all ids of a slice at once; it needs the
bytes of the tokens and their offsets only.  ``encode(decoded=True)``
decodes the ids in the worker that made them, so that a task holds one
worker.

Scale: one narrow pass, no shuffle; the rank file (under 1 MB) is read on
the driver and broadcast.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.llm.common import SegmentTable, map_texts, split_distinct, text_slices

NO_PAIR = np.int32(2 ** 31 - 1)
#: Pieces longer than this many bytes are merged with a heap instead of in
#: a matrix (whose work grows with the square of the width); same merges.
MATRIX_BYTES = 2048
#: White space beside a space, or at an end of the text (RE2; its own
#: class of white space is ASCII only).
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNEVEN_SPACE = rf" {_SPACE}|{_SPACE} |\A{_SPACE}|{_SPACE}\z"
#: Cells of one matrix at most.
MATRIX_CELLS = 1 << 20
#: Ids whose bytes are gathered at once.
DECODE_IDS = 1 << 16


class PairTable:
    """Hash table from a pair of token ids to the id of their merge."""

    def __init__(self, left, right, merged):
        keys = (np.asarray(left, np.uint64) << np.uint64(32)) | np.asarray(right, np.uint64)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, np.uint64(2 ** 64 - 1))
        self._values = np.full(1 << bits, NO_PAIR, np.int32)
        merged = np.asarray(merged, np.int32)
        todo, self._probes = np.arange(len(keys)), 0
        slot = self._slot(keys)
        while len(todo):
            self._probes += 1
            at = (slot[todo] + self._probes - 1) & self._mask
            free = self._keys[at] == np.uint64(2 ** 64 - 1)
            # of several keys for one free slot, the first takes it
            first = np.zeros(len(todo), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self._keys[at[put]] = keys[todo[put]]
            self._values[at[put]] = merged[todo[put]]
            todo = todo[~put]

    def _slot(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, ``NO_PAIR`` where there is none (also for -1 pads)."""
        out = np.full(left.shape, NO_PAIR, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = ((left.ravel()[todo].astype(np.uint64) << np.uint64(32))
                | right.ravel()[todo].astype(np.uint64))
        slot, flat = self._slot(keys), out.ravel()
        for probe in range(self._probes):
            at = (slot + probe) & self._mask
            found = self._keys[at]
            hit = found == keys
            flat[todo[hit]] = self._values[at[hit]]
            more = ~hit & (found != np.uint64(2 ** 64 - 1))
            if not more.any():
                break
            todo, keys, slot = todo[more], keys[more], slot[more]
        return flat.reshape(left.shape)


def read_ranks(rank_file: bytes) -> dict[bytes, int]:
    """Token -> rank of a rank file (lines of base64 token, rank)."""
    return {base64.b64decode(t): int(r)
            for t, r in (line.split() for line in rank_file.splitlines() if line)}


class Decoder:
    """Bytes of ids: all tokens in one array, and where each one lies."""

    def __init__(self, ranks: dict[bytes, int]):
        self._lens = np.full(max(ranks.values(), default=-1) + 1, -1, np.int32)
        for token, rank in ranks.items():
            self._lens[rank] = len(token)
        self._starts = np.cumsum(np.maximum(self._lens, 0), dtype=np.int64) - np.maximum(self._lens, 0)
        self._bytes = np.frombuffer(b"".join(sorted(ranks, key=ranks.__getitem__)), np.uint8)

    def decode_many(self, ids: np.ndarray, cuts: np.ndarray) -> pa.Array:
        """Binary array: item i holds the bytes of the ids from ``cuts[i]`` up
        to ``cuts[i + 1]``.  KeyError for an id that has none."""
        if len(ids) and (int(ids.max()) >= len(self._lens) or int(self._lens[ids].min()) < 0):
            raise KeyError("an id that no token has")
        lens = self._lens[ids]
        ends = np.concatenate([[0], np.cumsum(lens, dtype=np.int64)])
        found = np.empty(ends[-1], np.uint8)
        for at in range(0, len(ids), DECODE_IDS):
            end = min(at + DECODE_IDS, len(ids))
            shift = self._starts[ids[at:end]] - ends[at:end]
            found[ends[at]:ends[end]] = self._bytes[
                np.arange(ends[at], ends[end]) + np.repeat(shift, lens[at:end])]
        return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [
            None, pa.py_buffer(ends[cuts].astype(np.int64).tobytes()), pa.py_buffer(found.tobytes())]
        ).cast(pa.binary())

    def decode(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        return self.decode_many(ids, np.array([0, len(ids)]))[0].as_py()


class ByteBPE:
    """Encoder and decoder of one rank file."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = read_ranks(rank_file)
        self.decoder = Decoder(self.ranks)
        self._find = regex.compile(pattern).findall
        self._byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self.pairs = PairTable(left, right, merged)
        self._pair_ranks = dict(zip(zip(left, right), merged))
        self._table = SegmentTable(self._encode_segments)

    # -- merging ---------------------------------------------------------
    def _merge_matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token ids of pieces of similar length."""
        lens = np.array([len(p) for p in pieces])
        width = int(lens.max())
        ids = np.full((len(pieces), width), -1, np.int32)
        filled = np.arange(width) < lens[:, None]
        ids[filled] = self._byte[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = self.pairs.get(ids[:, :-1], ids[:, 1:])
        rows = np.arange(len(pieces))
        out: list = [None] * len(pieces)
        while True:
            if ids.shape[1] > 1:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(rows)), at]
                going = best != NO_PAIR
            else:
                going = np.zeros(len(rows), bool)
            for i in np.flatnonzero(~going):
                out[rows[i]] = ids[i][ids[i] >= 0]
            if not going.any():
                return out
            rows, ids, ranks, at, best = (x[going] for x in (rows, ids, ranks, at, best))
            here = np.arange(len(rows))
            ids[here, at] = best
            # compaction: everything right of the merged pair moves one left
            cols = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), axis=1)
            if ids.shape[1] < 2:
                continue
            cols = np.arange(ids.shape[1] - 1)
            ranks = np.take_along_axis(ranks, cols + (cols >= at[:, None]), axis=1)
            for pair in (at - 1, at):
                ok = (pair >= 0) & (pair < ids.shape[1] - 1)
                r, c = here[ok], pair[ok]
                ranks[r, c] = self.pairs.get(ids[r, c], ids[r, c + 1])

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece, from a heap of pairs."""
        ids = [int(x) for x in self._byte[np.frombuffer(piece, np.uint8)]]
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))
        get = self._pair_ranks.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1)
                if (r := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token ids of each piece; a piece that is a token is that token."""
        out: list = [None] * len(pieces)
        todo = []
        for i, p in enumerate(pieces):
            rank = self.ranks.get(p)
            if rank is not None:
                out[i] = np.array([rank], np.int32)
            elif len(p) > MATRIX_BYTES:
                out[i] = self._merge_long(p)
            else:
                todo.append(i)
        todo.sort(key=lambda i: len(pieces[i]))
        at = 0
        while at < len(todo):
            # a bucket: lengths up to a quarter apart, a bounded matrix
            least = len(pieces[todo[at]])
            widest = least + least // 4
            end = at
            while (end < len(todo) and len(pieces[todo[end]]) <= widest
                   and (end - at) * widest < MATRIX_CELLS):
                end += 1
            bucket = todo[at:end]
            for i, ids in zip(bucket, self._merge_matrix([pieces[i] for i in bucket])):
                out[i] = ids
            at = end
        return out

    # -- texts -----------------------------------------------------------
    def _encode_segments(self, keys):
        """Of a str the segment is a space and it, of a 1-tuple its item."""
        cut = [self._find(f" {k}" if type(k) is str else k[0]) for k in keys]
        at: dict[str, int] = {}
        index = [[at.setdefault(p, len(at)) for p in ps] for ps in cut]
        ids = self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in at])
        parts = [ids[i] for ps in index for i in ps]
        lens = np.array([sum(len(ids[i]) for i in ps) for ps in index], np.int64)
        return lens, np.concatenate([*parts, np.zeros(0, np.int32)])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Id arrays of texts (no nulls).  A single space between two other
        characters always starts a piece, so a text is cut there and whole
        segments are looked up; any other white space beside a space sends
        the text through the pattern."""
        uneven = pa.compute.match_substring_regex(texts, UNEVEN_SPACE).to_numpy(
            zero_copy_only=False)
        if uneven.any():
            return self._encode_mixed(texts, uneven)
        chunks, place, cuts = split_distinct(texts)
        index = self._table.indices(chunks)[place]
        first = cuts[:-1]
        index[first] = self._table.indices((chunks[i],) for i in place[first])
        return self._table.encode(index, cuts)

    def _encode_mixed(self, texts: pa.Array, uneven: np.ndarray) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        even = np.flatnonzero(~uneven)
        if len(even):
            for i, ids in zip(even, self.encode(texts.take(pa.array(even)))):
                out[i] = ids
        odd = np.flatnonzero(uneven)
        found = [self._table.indices((p,) for p in self._find(texts[int(i)].as_py()))
                 for i in odd]
        cuts = np.cumsum([0] + [len(x) for x in found])
        for i, ids in zip(odd, self._table.encode(np.concatenate(found), cuts)):
            out[i] = ids
        return out

    def decode(self, ids) -> bytes:
        """Bytes of a sequence of ids; KeyError for an id that has none."""
        return self.decoder.decode(ids)


_CODECS: dict[tuple[int, str], ByteBPE] = {}


def _codec(rank_file: bytes, pattern: str) -> ByteBPE:
    """One codec per worker process and vocabulary."""
    key = (hash(rank_file), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = ByteBPE(rank_file, pattern)
    return _CODECS[key]


def _shared(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, vocabulary: str, pattern: str, *, text: str = "text",
           carry: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """``row`` (struct of the ``carry`` columns, all by default),
    ``n_tokens`` long and ``ids`` (little-endian unsigned 32-bit integers);
    with ``decoded`` also ``decoded``, the bytes that these ids stand for.

    ``vocabulary``: path of a rank file on the driver.  Null and empty
    texts have no tokens; repeated rows are encoded alike; no rows give no
    rows; extra columns ride along inside ``row``.
    """
    ranks = _shared(docs.sparkSession, vocabulary)

    def make():
        codec = _codec(ranks.value, pattern)

        def work(texts):
            ids = codec.encode(texts)
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            packed = [x.astype("<u4").tobytes() for x in ids]
            out = [pa.array(lens), pa.array(packed, pa.binary())]
            if decoded:
                out.append(codec.decoder.decode_many(np.frombuffer(b"".join(packed), "<u4"),
                                                     np.concatenate([[0], np.cumsum(lens)])))
            return out
        return work

    return map_texts(docs, text, docs.columns if carry is None else carry,
                     "n_tokens long, ids binary" + ", decoded binary" * decoded, make)


def decode(encoded: DataFrame, vocabulary: str, *, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of its ids (null ids: null)."""
    ranks = _shared(encoded.sparkSession, vocabulary)
    at = encoded.columns.index(ids)
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches):
        decoder = None
        for part in text_slices(batches, ids):
            decoder = decoder or Decoder(read_ranks(ranks.value))
            packed = part.column(at)
            lens = pa.compute.fill_null(pa.compute.binary_length(packed), 0).to_numpy(
                zero_copy_only=False) // 4
            flat = np.frombuffer(b"".join(pa.compute.fill_null(packed, b"").to_pylist()), "<u4")
            found = decoder.decode_many(flat, np.concatenate([[0], np.cumsum(lens)]))
            found = pa.compute.if_else(packed.is_valid(), found, pa.scalar(None, pa.binary()))
            yield pa.RecordBatch.from_arrays([*part.columns, found], schema.names)

    return encoded.mapInArrow(run, schema)
