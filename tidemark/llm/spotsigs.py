"""Document fingerprints by SpotSigs.

A signature is a common word (an anchor) and the chain of content words
that follow it; a document's fingerprint is the set of its signatures.
Where no common word stands among the last ``REACH`` words (lists, other
languages, a text's start) every word counts as an anchor.  A text too
short for a chain is one signature as a whole, so short texts that differ
have different fingerprints.

``near_duplicates`` compares fingerprints: documents are dealt by set
length, because sets whose lengths differ by more than the threshold
cannot be similar; within a length partition only documents sharing one of
their rarest signatures are compared (enough rare ones that no similar
pair shares none), and pairs are verified block by block on full sets.
``next_in_order`` pairs every document with the one after it, for
comparisons along an order, without gathering the order in one task.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, map_texts, shuffle_partitions, split_distinct, text_slices
from tidemark.llm.components import connected_components
from tidemark.llm.ngram_join import BLOCK, common_counts, roots_of

#: Content words of a chain.
CHAIN = 2
THRESHOLD = 0.8
#: Words behind an anchor up to which words are content only.
REACH = 6
#: Common words of the corpus's languages.
ANCHORS = frozenset(
    # English
    "a an and are as at be been but by for from had has have he her his in is it its not of on or "
    "she that the their there they this to was were which will with you "
    # German
    "als auch auf aus bei das dass dem den der des die ein eine einem einen einer es für im ist mit "
    "nicht sich sie sind und vom von vor wie wird zu zum zur über "
    # French
    "au aux avec ce ces dans de du elle en est et il la le les ne ou par pas pour que qui sa se ses "
    "son sur un une "
    # Spanish
    "al como con del el ella entre era esta este lo los más no para pero por sin su una y".split())
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def _word(word: str) -> int:
    """Hash of a word's normal form, even for anchors; 0 for none."""
    w = word.strip(_MARKS).lower()
    if not w:
        return 0
    h = (zlib.crc32(w.encode()) | 1) + (1 << 32)
    return h - 1 if w in ANCHORS else h


def signatures(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct signatures (32-bit) of texts (no nulls)."""
    flat = pa.compute.replace_substring_regex(texts, r"\s+", " ")
    words, place, cuts = split_distinct(flat)
    h = np.fromiter(map(_word, words), np.int64, len(words))[place]
    doc = np.repeat(np.arange(len(texts)), np.diff(cuts))
    doc, h = doc[h != 0], h[h != 0]
    anchor = (h & 1) == 0
    # far from any anchor every word is an anchor and content at once
    at = np.arange(len(h))
    begin = np.searchsorted(doc, doc)
    last = np.maximum.accumulate(np.where(anchor, at, -1)) if len(h) else at
    every = ~anchor & (at - np.where(last >= begin, last, begin - REACH - 1) > REACH)
    content = np.flatnonzero(~anchor | every)
    spot = np.flatnonzero(anchor | every)
    ahead = np.searchsorted(content, spot, side="right")
    with np.errstate(over="ignore"):
        x = h[spot].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        whole = np.ones(len(spot), bool)
        for k in range(CHAIN):
            inside = ahead + k < len(content)
            at = content[np.where(inside, ahead + k, 0)] if len(content) else np.zeros(len(spot), int)
            whole &= inside & (doc[at] == doc[spot]) if len(content) else False
            x = (x ^ (x >> np.uint64(29))) + h[at].astype(np.uint64)
            x *= np.uint64(0xBF58476D1CE4E5B9)
    found = (x >> np.uint64(32)).astype(np.uint32)[whole]
    pairs = np.unique((doc[spot][whole].astype(np.int64) << 32) | found)
    ends = np.searchsorted(pairs >> 32, np.arange(len(texts) + 1))
    values = (pairs & 0xFFFFFFFF).astype(np.uint32)
    return [values[a:b] if b > a else np.array([zlib.crc32(texts[i].as_py().encode())], np.uint32)
            for i, (a, b) in enumerate(zip(ends[:-1], ends[1:]))]


def fingerprint(sig: np.ndarray) -> str:
    """A signature set as text: base64 of its sorted 32-bit hashes."""
    return base64.b64encode(sig.astype("<u4").tobytes()).decode()


def parse(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u4")


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two signature sets; 0 without counting where
    their lengths already rule ``least`` out."""
    small, large = sorted((len(a), len(b)))
    if large == 0 or small < least * large:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (small + large - common)


def fingerprints(docs: DataFrame, *, text: str = "text",
                 carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``carry`` columns, all by default) and
    ``fingerprint``.  Null and empty texts have the fingerprint of the
    empty text; repeated rows have equal ones; no rows give no rows."""
    def make():
        return lambda texts: [pa.array([fingerprint(s) for s in signatures(texts)], pa.string())]
    return map_texts(docs, text, docs.columns if carry is None else carry,
                     "fingerprint string", make)


# -- along an order ---------------------------------------------------------

def _dealt_in_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (bucket, ahead, key, text), partitioned and sorted so that the
    next document by descending key follows each row.  Buckets are key
    ranges; the first document of a bucket also closes the bucket before
    it (``ahead`` = 1), that of the first bucket the last one."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    # several buckets a partition, so that partitions come out even
    m = 4 * n
    d = docs.select(F.col(f"`{key}`").cast("bigint").alias("key"),
                    F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    bounds = d.agg(F.percentile_approx("key", [i / m for i in range(1, m)], 10000)
                   .alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    larger = F.size(F.filter(F.lit(bounds).cast("array<bigint>"),
                             lambda b: b > F.col("key"))) if bounds else F.lit(0)
    # a null key has no place in the order: dealt anywhere, next to nothing
    nowhere = F.lit(len(bounds) + 1) + F.pmod(F.xxhash64("text"), F.lit(m)).cast("int")
    d = d.withColumn("bucket", F.when(F.col("key").isNull(), nowhere).otherwise(larger))
    heads = {r["bucket"]: r["k"] for r in  # a row per bucket
             d.where("key IS NOT NULL").groupBy("bucket").agg(F.max("key").alias("k")).collect()}
    order = sorted(heads)
    # the first bucket's head closes the last bucket; as many rows as buckets
    closes = spark.createDataFrame([(heads[b], order[i - 1]) for i, b in enumerate(order)],
                                   "key long, closes int")
    places = F.filter(F.array(
        F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("ahead")),
        F.struct(F.col("closes").alias("bucket"), F.lit(1).alias("ahead"))),
        lambda p: p["bucket"].isNotNull())
    return (d.join(F.broadcast(closes), "key", "left").withColumn("place", F.explode(places))
            .select("place.bucket", "place.ahead", "key", "text")
            .repartition(n, "bucket")
            .sortWithinPartitions("bucket", "ahead", F.desc("key"), "text"))


def compare_along_order(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint, beside that of its edited text (the
    last third of its code points replaced by as many first ones of the
    next document, by descending key; after the last comes the first) and
    the likeness to the edited text's and to the next document's.

    Null texts are empty.  Rows that share a key follow each other by
    text.  A row with a null key has no next document: its third is
    replaced by nothing, and the next fingerprint is that of the empty
    text.  A single document is its own next.  No rows give no rows.
    """
    schema = T.StructType.fromDDL("key long, n_chars long, edited_sha256 string, fingerprint string, "
                                  "edited_fingerprint string, near_edited double, near_next double")

    def run(batches):
        held = None
        for part in text_slices(batches, "text", 2 << 20):
            rows = part if held is None else pa.concat_batches([held, part])
            done = rows.num_rows - 1
            held = rows.slice(done)
            if done:
                yield _compared(rows, done, schema)
        if held is not None:
            yield _compared(held, 1, schema)  # closes its bucket, or has a null key

    return _dealt_in_order(docs, key, text).mapInArrow(run, schema)


def _compared(rows: pa.RecordBatch, done: int, schema: T.StructType) -> pa.RecordBatch:
    """The first ``done`` rows against those that follow them."""
    bucket, ahead = (rows.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    null = rows.column(2).is_null().to_numpy(zero_copy_only=False)
    texts = rows.column(3).to_pylist()
    own = [i for i in range(done) if not ahead[i]]
    follows = [i + 1 < len(texts) and bucket[i] == bucket[i + 1] and not null[i] for i in own]
    edited = []
    for i, f in zip(own, follows):
        cut = len(texts[i]) // 3
        edited.append(texts[i][:len(texts[i]) - cut] + (texts[i + 1][:cut] if f else ""))
    sig = signatures(rows.column(3))
    edited_sig = signatures(pa.array(edited, pa.string()))
    none = signatures(pa.array([""]))[0]
    columns = [
        [None if null[i] else k for i, k in zip(own, rows.column(2).take(pa.array(own, pa.int64()))
                                                .to_pylist())],
        [len(texts[i]) for i in own],
        [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
        [fingerprint(sig[i]) for i in own],
        [fingerprint(s) for s in edited_sig],
        [likeness(sig[i], s) for i, s in zip(own, edited_sig)],
        [likeness(sig[i], sig[i + 1] if f else none) for i, f in zip(own, follows)]]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
             pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                      schema.names)


# -- near-duplicates ----------------------------------------------------------

def length_partition(length, threshold: float):
    """Partition of a set length: lengths of one partition differ by the
    threshold at most, so similar sets lie in the same or adjacent ones."""
    return F.floor(F.log(length.cast("double")) / F.lit(-math.log(threshold))).cast("int")


def _verify(threshold: float):
    """Task of one block pair: rows (id, size, block, fingerprint)."""
    def verify(key, rows):
        ids, size, block = (rows[c].to_numpy() for c in ("id", "size", "block"))
        sets = [parse(f) for f in rows["fingerprint"].to_pylist()]
        n = np.array([len(s) for s in sets])
        common = common_counts(np.concatenate(sets), np.concatenate([[0], np.cumsum(n)]))
        linked = common >= threshold * (n[:, None] + n[None, :] - common) - 1e-6
        np.fill_diagonal(linked, False)
        if key[1].as_py() != key[2].as_py():
            linked &= block[:, None] != block[None, :]
        links = linked @ size
        keep = links > 0
        return pa.table({"id": ids[keep], "links": links[keep], "root": ids[roots_of(linked)][keep]})
    return verify


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                    threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``key``, ``class_id`` (least key of its group of documents with like
    fingerprints), ``n_links`` (other documents of likeness ``threshold``
    or more) and ``kept`` (one row of each group).

    Documents of equal fingerprints form a class, and classes are
    compared; empty texts are alike.  Null keys sort last in their group.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "spotsigs")
    d = docs.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").alias("text"))
    prints = fingerprints(d, carry=["key"]).select(
        F.monotonically_increasing_id().alias("rid"), "row.key", "fingerprint",
        F.md5("fingerprint").alias("digest"))
    prints = scratch.keep(prints, "prints")
    least = F.min(F.struct(F.col("key").isNull().alias("n"), "key", "rid")).alias("least")
    classes = scratch.keep(
        prints.groupBy("digest").agg(least, F.count("*").alias("size"),
                                     F.first("fingerprint").alias("fingerprint"))
        .withColumn("id", F.col("least.rid")), "classes")
    # length of the set: 4 bytes a signature
    sets = (classes.withColumn("raw", F.unbase64("fingerprint"))
            .withColumn("n", (F.length("raw") / 4).cast("int")))
    sigs = sets.select("id", "n", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.substring("raw", i * 4 + 1, F.lit(4)))).alias("sig"))
    rarity = sigs.groupBy("sig").agg(F.count("*").alias("df")).where("df > 1")
    rank = F.row_number().over(W.partitionBy("id").orderBy("df", "sig"))
    # signatures no other class holds come first in the order of rarity
    alone = F.col("n") - F.count("*").over(W.partitionBy("id"))
    rare = (sigs.join(rarity, "sig").withColumn("at", rank + alone)
            .where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1))
    part = length_partition(F.col("n"), threshold)
    held = rare.select("id", "sig", F.explode(F.array(part, part + 1)).alias("part"))
    held = scratch.keep(held, "held")
    least_of = scratch.keep(held.groupBy("part", "sig").agg(
        F.min("id").alias("b"), F.count("*").alias("c")).where("c > 1"), "least-of")
    pairs = (held.join(least_of, ["part", "sig"]).where("id != b")
             .select("id", "b").distinct())
    maybe = connected_components(pairs, scratch, "maybe")
    sizes = scratch.keep(maybe.groupBy("root").agg(
        F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks")), "sizes")
    dealt = (maybe.join(sizes, "root")
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .join(classes.select("id", "size", "fingerprint"), "id")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("id", "size", "block", "fingerprint", "root",
                     F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    verified = scratch.keep(dealt.groupBy("root", "i", "j").applyInArrow(
        _verify(threshold), "id long, links long, root long"), "verified")
    links = verified.groupBy("id").agg(F.sum("links").alias("links"))
    groups = connected_components(verified.select("id", "root"), scratch, "groups")
    of_class = scratch.keep(
        classes.join(links, "id", "left").join(groups, "id", "left")
        .select("digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                "least", F.coalesce("root", "id").alias("group")), "of-class")
    first = scratch.keep(of_class.groupBy("group").agg(F.min("least").alias("first")), "firsts")
    of_class = scratch.keep(of_class.join(first, "group").select("digest", "n_links", "first"),
                            "of-group")
    # what the result does not read
    scratch.drop("classes", "held", "least-of", "sizes", "verified", "of-class", "firsts")
    return (prints.select("rid", "key", "digest").join(of_class, "digest")
            .select("key", F.col("first.key").alias("class_id"), "n_links",
                    (F.col("rid") == F.col("first.rid")).alias("kept")))
