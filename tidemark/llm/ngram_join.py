"""Near-duplicate documents: word n-gram Jaccard join by MinHash banding.

1. One pass over the texts hashes the word 5-grams of each document and
   takes ``bands * rows`` minima (counts chosen for a target recall at the
   threshold) and a digest of the n-gram set.  Documents of equal sets
   form a class; only classes go on.
2. Classes that share a band hash are linked to the least class of the
   bucket; connected components of the links hold every candidate pair.
3. Each component is dealt out in pairs of bounded blocks.  A task counts
   the common n-grams of all pairs of its blocks on the full sets and
   returns, per class, its number of links and one link towards its group:
   no pair list leaves a task.
4. Components of the verified links are the groups.

Scale: buckets are pre-aggregated and never gathered; a component holding
a third of all documents becomes many block pairs of at most
``2 * BLOCK`` texts; rounds of the component search are written to the
shared scratch folder.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, map_texts, split_distinct
from tidemark.llm.components import connected_components

NGRAM, THRESHOLD, RECALL, ROWS = 5, 0.8, 0.9999, 6
#: Classes of one block of a component.
BLOCK = 256
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` minima with which a pair at the threshold shares
    one with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)))


def _word_hash(word: str) -> int:
    w = word.strip(_MARKS).lower()
    if not w:
        return 0
    b = w.encode()
    return (zlib.crc32(b) << 32 | zlib.crc32(b, 0x9E3779B9)) or 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, n: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed word n-grams: (hashes, where each text's start and
    end).  Words are runs between white space without marks at their ends,
    in lower case; a text of fewer words is one n-gram, one without words
    has none."""
    flat = pa.compute.replace_substring_regex(texts, r"\s+", " ")
    words, place, cuts = split_distinct(flat)
    hashes = np.fromiter(map(_word_hash, words), np.uint64, len(words))[place]
    doc = np.repeat(np.arange(len(texts)), np.diff(cuts))
    real = hashes != 0
    doc, hashes = doc[real], _mix(hashes[real])
    count = np.bincount(doc, minlength=len(texts))
    start = np.cumsum(count) - count
    at = np.arange(len(doc)) - start[doc]
    grams = np.zeros(len(doc), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            ahead = np.zeros(len(doc), np.uint64)
            ahead[:len(doc) - k] = hashes[k:]
            # a short text is one n-gram: words past its end add nothing
            inside = at + k < count[doc]
            grams += np.where(inside, _mix(ahead + np.uint64(k + 1)), np.uint64(0)) \
                * np.uint64(2 * k + 3)
    keep = at <= np.maximum(count[doc] - n, 0)
    doc, grams = doc[keep], _mix(grams[keep])
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    doc, grams = doc[new], grams[new]
    return grams, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])


class MinHash:
    """Band hashes of n-gram sets."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        self.bands, self.rows = bands, rows
        rng = np.random.default_rng(seed)
        self._a = rng.integers(0, 1 << 32, bands * rows, np.uint32) | np.uint32(1)
        self._b = rng.integers(0, 1 << 32, bands * rows, np.uint32)

    def minima(self, grams: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """(texts, bands * rows) minima; texts without n-grams are zero."""
        out = np.zeros((len(cuts) - 1, len(self._a)), np.uint32)
        full = np.flatnonzero(np.diff(cuts))
        x = (grams >> np.uint64(32)).astype(np.uint32)
        at = 0
        while at < len(full):
            # some texts at a time, so that the buffers stay in cache
            first = cuts[full[at]]
            end = max(at + 1, int(np.searchsorted(cuts[full + 1], first + 16384, side="right")))
            part, starts = x[first:cuts[full[end - 1] + 1]], cuts[full[at:end]] - first
            y = np.empty_like(part)
            rows = full[at:end]
            for k, (a, b) in enumerate(zip(self._a, self._b)):
                np.multiply(part, a, out=y)
                np.add(y, b, out=y)
                out[rows, k] = np.minimum.reduceat(y, starts)
            at = end
        return out

    def band_hashes(self, minima: np.ndarray) -> np.ndarray:
        """(texts, bands) 64-bit hashes, told apart by band."""
        m = minima.reshape(len(minima), self.bands, self.rows).astype(np.uint64)
        h = np.zeros((len(minima), self.bands), np.uint64) + np.arange(
            1, self.bands + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(self.rows):
                h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + m[:, :, k])
        return h.view(np.int64)


def _signatures(docs: DataFrame, text: str, carry: list[str], minhash: MinHash) -> DataFrame:
    """``row``, ``digest`` (of the n-gram set, null without words) and
    ``bands`` (array of long) of each document."""

    def make():
        def work(texts):
            grams, cuts = shingles(texts)
            m = minhash.minima(grams, cuts)
            full = np.diff(cuts) > 0
            digests = [hashlib.md5(grams[a:b].tobytes()).digest() if b > a else None
                       for a, b in zip(cuts[:-1], cuts[1:])]
            bands = minhash.band_hashes(m)
            offsets = np.concatenate([[0], np.cumsum(np.where(full, minhash.bands, 0))])
            return [pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                             pa.array(bands[full].ravel()))]
        return work

    return map_texts(docs, text, carry, "digest binary, bands array<long>", make,
                     max_bytes=2 << 20)


def common_counts(grams: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Matrix of the number of common n-grams of each two texts."""
    n = len(cuts) - 1
    owner = np.repeat(np.arange(n), np.diff(cuts))
    _, col, seen = np.unique(grams, return_inverse=True, return_counts=True)
    shared = seen[col] > 1
    owner, col = owner[shared], col[shared]
    _, col = np.unique(col, return_inverse=True)
    out = np.zeros((n, n), np.float32)
    width = max(1, (1 << 21) // max(1, n))
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    for first in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        a, b = np.searchsorted(col, (first, first + width))
        m = np.zeros((n, width), np.float32)
        m[owner[a:b], col[a:b] - first] = 1
        out += m @ m.T
    return out


def roots_of(linked: np.ndarray) -> np.ndarray:
    """Least index of each one's component of a boolean matrix."""
    root = np.arange(len(linked))
    while True:
        # the least root among neighbours and itself, then jump to its root
        least = np.minimum(root, np.where(linked, root[None, :], len(root)).min(axis=1))
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _verify(threshold: float):
    """Task of one block pair: rows (id, size, block, text)."""
    def verify(key, rows):
        same = key[1].as_py() == key[2].as_py()
        ids = rows["id"].to_numpy()
        size = rows["size"].to_numpy()
        block = rows["block"].to_numpy()
        texts = rows["text"].combine_chunks()
        grams, cuts = shingles(texts.cast(pa.string()))
        common = common_counts(grams, cuts)
        n = np.diff(cuts)
        linked = common >= threshold * (n[:, None] + n[None, :] - common) - 1e-6
        np.fill_diagonal(linked, False)
        if not same:
            linked &= block[:, None] != block[None, :]
        links = linked @ size
        root = ids[roots_of(linked)] if linked.any() else ids
        keep = links > 0
        return pa.table({"id": ids[keep], "links": links[keep], "root": root[keep]})
    return verify


def join_ngrams(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                carry: list[str] | None = None, threshold: float = THRESHOLD,
                recall: float = RECALL, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``row`` (struct of the ``carry``
    columns, all by default), ``class_id`` (least key of its group of
    near-duplicates, its own if it has none), ``n_links`` (other documents
    whose n-gram sets have Jaccard similarity ``threshold`` or more with
    its own, copies included) and ``kept`` (one row of each group).

    Null and empty texts, and texts without words, link with nothing and
    are kept.  Rows with a null key take part like others; a null key is
    the greatest of its group.  Of rows that share text and key one is
    kept.  No rows give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-join")
    minhash = MinHash(bands_for(threshold, recall, rows), rows)
    carry = docs.columns if carry is None else carry
    own = "_key"
    while own in docs.columns:
        own += "_"
    docs = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*carry, text])],
                       F.col(f"`{key}`").cast("bigint").alias(own))
    signed = _signatures(docs, text, docs.columns, minhash)
    signed = scratch.keep(
        signed.select(F.monotonically_increasing_id().alias("rid"), F.col(f"row.`{own}`").alias("key"),
                      "row", "digest", "bands"), "signed")

    # classes of equal n-gram sets; a class is named by its least row
    least = F.min(F.struct(F.col("key").isNull().alias("n"), "key", "rid")).alias("least")
    classes = (signed.where("digest IS NOT NULL").groupBy("digest")
               .agg(least, F.count("*").alias("size"))
               .select("digest", F.col("least.rid").alias("id"), "least", "size"))
    classes = scratch.keep(classes, "classes")
    heads = signed.join(classes.select(F.col("id").alias("rid"), "size"), "rid")
    heads = scratch.keep(heads.select(F.col("rid").alias("id"), "size", "bands"), "heads")

    banded = heads.select("id", F.explode("bands").alias("band"))
    # written before the join, so that a large bucket can be split there
    buckets = scratch.keep(
        banded.groupBy("band").agg(F.min("id").alias("b"), F.count("*").alias("n"))
        .where("n > 1").select("band", "b"), "buckets")
    near = (banded.join(buckets, "band").where("id != b")
            .select(F.col("id").alias("a"), "b").distinct())
    # every edge stays: a pair that shares a bucket is held together by the
    # bucket's least class even where neither of the two resembles it
    candidates = connected_components(near, scratch, "maybe")

    # blocks: class -> every pair of blocks of its component that holds it
    sizes = scratch.keep(candidates.groupBy("root").agg(
        F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks")), "sizes")
    dealt = (candidates.join(sizes, "root")
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .join(heads.select("id", "size"), "id")
             .join(signed.select(F.col("rid").alias("id"), F.col(f"row.`{text}`").alias("text")),
                   "id")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("id", "size", "block", "text", "root",
                     F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    verified = dealt.groupBy("root", "i", "j").applyInArrow(
        _verify(threshold), "id long, links long, root long")
    verified = scratch.keep(verified, "verified")
    links = verified.groupBy("id").agg(F.sum("links").alias("links"))
    groups = connected_components(verified.select("id", "root"), scratch, "groups")

    # every class's group and the least row of the group, then every row's
    of_class = (classes.join(links, "id", "left").join(groups, "id", "left")
                .select("digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                        "least", F.coalesce("root", "id").alias("group")))
    of_class = scratch.keep(of_class, "of-class")
    of_group = scratch.keep(of_class.groupBy("group").agg(F.min("least").alias("first")), "firsts")
    of_class = (of_class.join(of_group, "group")
                .select("digest", "n_links", F.col("first.key").alias("class_id"),
                        F.col("first.rid").alias("first")))
    of_class = scratch.keep(of_class, "of-group")
    # what the result does not read
    scratch.drop("classes", "heads", "buckets", "sizes", "verified", "of-class", "firsts")
    rows_ = signed.select("rid", "key", "digest", F.struct(
        *[F.col(f"row.`{c}`") for c in carry]).alias("row"))
    narrow = rows_.drop("row") if text in carry else rows_
    found = (narrow.where("digest IS NOT NULL").join(of_class, "digest")
             .withColumn("kept", F.col("rid") == F.col("first")))
    alone = (narrow.where("digest IS NULL")
             .withColumn("class_id", F.col("key")).withColumn("n_links", F.lit(0).cast("bigint"))
             .withColumn("kept", F.lit(True)))
    out = ["class_id", "n_links", "kept"]
    if text not in carry:
        return found.select("row", *out).unionByName(alone.select("row", *out))
    decided = found.select("rid", *out).unionByName(alone.select("rid", *out))
    # the texts join once, by row
    return rows_.select("rid", "row").join(decided, "rid").select("row", *out)
