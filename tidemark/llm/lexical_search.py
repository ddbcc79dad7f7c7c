"""Ranked lexical search with bag deduplication.

Every document is reduced to the items' vocabulary: its term frequencies
there (a bag) and m, which stands for its length.  Documents of equal bag
and m score alike for every item, so they form a class: classes are found
by hash and verified on the whole bag, each is scored once, and only the
members that a rank can need are expanded, by ascending key.

1. One pass over the texts counts terms and writes the bags; counts over
   all documents (N, L, df) come from them.
2. A window over (hash, m, bag) names each class by its first member and
   numbers the first ``k``; map tasks send ``k`` members of a class at most.
3. Tasks score their classes against the postings of the items and keep
   the ``k`` best of each item; the best of all tasks are ranked, and
   joined with the members of their classes.

Scale: texts are read once a block of items and never shuffled.  Items go
in blocks whose terms are measured (``BLOCK_BYTES``) before they are sent
to the tasks; a larger item table takes more passes and no more memory.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, map_texts

#: What is not part of a term: ASCII other than digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a ranking.
BEST = 10
#: Bytes of the terms of one block of items, as measured, unless one item
#: alone has more.
BLOCK_BYTES = 16 << 20
#: Scores and postings of the classes that are scored at once, about.
CELLS = 1 << 20
#: Sums of whole numbers below this are exact in double precision.
EXACT = 1 << 53


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct terms, place of every term of every text among them, its
    text).  Of letters only A to Z are lower-cased."""
    flat = pa.compute.replace_substring_regex(pa.compute.ascii_lower(texts), SEPARATORS, " ")
    lists = pa.compute.split_pattern(flat, " ")
    found = lists.flatten().dictionary_encode()
    place = found.indices.to_numpy()
    owner = np.repeat(np.arange(len(texts)),
                      pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
    blank = pa.compute.index_in(pa.scalar("", pa.string()), value_set=found.dictionary).as_py()
    if blank is not None:
        real = place != blank
        place, owner = place[real], owner[real]
    return found.dictionary, place, owner


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    cuts = np.searchsorted(owner, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values))


def _counted(n_texts: int, place: np.ndarray, owner: np.ndarray, size: int):
    """(owner, place, count) of the distinct places of each text, in order."""
    keys, count = np.unique(owner * np.int64(max(1, size)) + place, return_counts=True)
    return keys // max(1, size), keys % max(1, size), count


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """``rid``, ``item`` (key) and ``term``, ``qtf`` of each distinct term."""
    numbered = items.select(F.monotonically_increasing_id().alias("rid"),
                            F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").alias("text"))

    def make():
        def work(texts):
            words, place, owner = terms_of(texts)
            owner, place, count = _counted(len(texts), place, owner, len(words))
            terms = words.take(pa.array(place))
            cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
            return [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), terms),
                    _lists(count, owner, len(texts))]
        return work

    found = map_texts(numbered, "text", ["rid", "item"], "terms array<string>, qtfs array<long>", make)
    return found.select("row.rid", "row.item", F.explode(F.arrays_zip("terms", "qtfs")).alias("t")).select(
        "rid", "item", F.col("t.terms").alias("term"), F.col("t.qtfs").alias("qtf"))


def blocks_of(terms: DataFrame, block_bytes: int) -> tuple[DataFrame, list[int]]:
    """``terms`` with the ``block`` of each item, and the blocks: an item
    with more than ``block_bytes`` of terms is one of its own, the others
    are dealt to as many as keep each within twice that, as measured."""
    sizes = terms.groupBy("rid").agg(
        F.sum(F.octet_length("term") + F.lit(64)).alias("bytes"))
    small = F.col("bytes") <= block_bytes
    total = sizes.where(small).agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"]
    n = max(1, math.ceil(total / block_bytes))
    while True:
        dealt = sizes.withColumn("block", F.when(small, F.pmod(F.xxhash64("rid"), F.lit(n)))
                                 .otherwise(-1 - F.col("rid")))
        held = dealt.groupBy("block").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("items"))
        if n == 1 or held.where((F.col("bytes") > 2 * block_bytes) & (F.col("items") > 1)).isEmpty():
            break
        n *= 2
    blocks = sorted(r["block"] for r in held.select("block").collect())  # passes over the texts
    return terms.join(dealt.select("rid", "block"), "rid"), blocks


def bags(docs: DataFrame, vocabulary: pa.Array, key: str, text: str) -> DataFrame:
    """``rid``, ``key``, ``n`` (terms with repeats) and the bag: ``terms``
    (places in ``vocabulary``, ascending) and ``tfs``."""
    numbered = docs.select(F.monotonically_increasing_id().alias("rid"),
                           F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.to_pylist())

    def make():
        known = pa.array(shared.value, pa.string())

        def work(texts):
            words, place, owner = terms_of(texts)
            n = np.bincount(owner, minlength=len(texts))
            at = pa.compute.fill_null(pa.compute.index_in(words, value_set=known), -1).to_numpy()[place]
            owner, term, tf = _counted(len(texts), at[at >= 0], owner[at >= 0], len(known))
            return [pa.array(n, pa.int64()), _lists(term.astype(np.int32), owner, len(texts)),
                    _lists(tf.astype(np.int32), owner, len(texts))]
        return work

    return map_texts(numbered, "text", ["rid", "key"], "n long, terms array<int>, tfs array<int>",
                     make).select("row.rid", "row.key", "n", "terms", "tfs")


class Postings:
    """Items of one block: their terms' weights and who holds them."""

    def __init__(self, term: np.ndarray, item: np.ndarray, qtf: np.ndarray, weight: np.ndarray,
                 items: int):
        order = np.argsort(term, kind="stable")
        self.item, self.qtf = item[order], qtf[order]
        self.cuts = np.searchsorted(term[order], np.arange(len(weight) + 1))
        self.weight, self.items = weight, items
        # no impact exceeds a million
        self.exact = items == 0 or int(weight.max(initial=0)) * 1_000_000 * int(
            np.bincount(item, qtf, minlength=items).max(initial=0)) < EXACT

    def scores(self, row: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray,
               rows: int) -> np.ndarray:
        """(rows, items) scores of bags; ``m`` stands beside each term."""
        impact = self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        reps = self.cuts[term + 1] - self.cuts[term]
        ends = np.cumsum(reps)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.cuts[term] - (ends - reps), reps)
        cell = np.repeat(row, reps) * self.items + self.item[at]
        value = np.repeat(impact, reps) * self.qtf[at]
        if self.exact:
            out = np.bincount(cell, value, minlength=rows * self.items).astype(np.int64)
        else:
            out = np.zeros(rows * self.items, np.int64)
            np.add.at(out, cell, value)
        return out.reshape(rows, self.items)


class Best:
    """The ``k`` best classes of each item: greatest score, then least first
    key (nulls last), then least head."""

    def __init__(self, items: int, k: int):
        self._items, self._k = items, k
        self._floor = np.ones(items, np.int64)  # scores below cannot be among the best
        self._held = [np.zeros((0, 5), np.int64)]  # item, score, null, key, head
        self._waiting = 0

    def add(self, scores: np.ndarray, keys: np.ndarray, none: np.ndarray, heads: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self._floor)
        self._held.append(np.stack([item, scores[row, item], none[row], keys[row], heads[row]], axis=1))
        self._waiting += len(row)
        if self._waiting > 4 * self._items * self._k + 10_000:
            self.settle()

    def settle(self) -> np.ndarray:
        x = np.concatenate(self._held)
        x = x[np.lexsort((x[:, 4], x[:, 3], x[:, 2], -x[:, 1], x[:, 0]))]
        start = np.searchsorted(x[:, 0], np.arange(self._items + 1))
        place = np.arange(len(x)) - start[x[:, 0]]
        full = np.flatnonzero(np.diff(start) >= self._k)
        self._floor[full] = x[start[full] + self._k - 1, 1]
        x = x[place < self._k]
        self._held, self._waiting = [x], 0
        return x


def _score(shared, k: int):
    """Classes (head, key, m, terms, tfs) to the best of each item."""
    def run(batches):
        postings, best = shared.value, None
        for batch in batches:
            best = best or Best(postings.items, k)
            term, tf = (batch.column(i).flatten().to_numpy().astype(np.int64) for i in (3, 4))
            cuts = np.concatenate([[0], np.cumsum(
                pa.compute.list_value_length(batch.column(3)).to_numpy(zero_copy_only=False))])
            # classes at a time, by the scores and postings that they take
            cost = np.concatenate([[0], np.cumsum(postings.cuts[term + 1] - postings.cuts[term])])[cuts]
            cost = cost + postings.items * np.arange(len(cuts))
            key, none = batch.column(1), batch.column(1).is_null().to_numpy(zero_copy_only=False)
            key, head, m = pa.compute.fill_null(key, 0).to_numpy(), batch.column(0).to_numpy(), \
                batch.column(2).to_numpy()
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(cost, cost[at] + CELLS, side="right")) - 1)
                row = np.repeat(np.arange(end - at), np.diff(cuts[at:end + 1]))
                some = slice(cuts[at], cuts[end])
                best.add(postings.scores(row, term[some], tf[some], m[at:end][row], end - at),
                         key[at:end], none[at:end], head[at:end])
                at = end
        if best is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in best.settle().T[[0, 1, 4]]], ["at", "score", "head"])
    return run


def _rank_block(docs: DataFrame, block: DataFrame, scratch: Scratch, name: str, k: int, key: str,
                text: str) -> DataFrame:
    """``rid``, ``item``, ``rank``, ``key``, ``score`` of one block of items."""
    spark = docs.sparkSession
    # bounded: see blocks_of
    rows = block.select("rid", "term", "qtf").toArrow()
    vocabulary = pa.array(sorted(set(rows["term"].to_pylist())), pa.string())
    rids = np.unique(rows["rid"].to_numpy())

    bagged = scratch.keep(bags(docs, vocabulary, key, text), f"bags-{name}")
    all_docs = bagged.agg(F.count_if(F.col("n") > 0).alias("N"), F.sum("n").alias("L")).first()
    df = bagged.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("df")).toArrow()  # a row per term of the block
    n_docs, n_terms = all_docs["N"], all_docs["L"] or 1
    weight = np.zeros(len(vocabulary), np.int64)
    for term, held in zip(df["term"].to_pylist(), df["df"].to_pylist()):
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held + 1)))

    m = F.expr(f"100 - 75 + (75 * n * {n_docs}L) div {n_terms}L")
    same = W.partitionBy("hash", "m", "terms", "tfs").orderBy(F.col("key").asc_nulls_last(), "rid")
    members = (bagged.where(F.size("terms") > 0).withColumn("m", m)
               .withColumn("hash", F.xxhash64("m", "terms", "tfs"))
               .withColumn("place", F.row_number().over(same)).where(F.col("place") <= k)
               # the rows that are left, dealt as they are
               .withColumn("head", F.first("rid").over(same)))
    first = F.col("place") == 1
    members = scratch.keep(members.select(
        "head", "place", "key", F.when(first, F.col("m")).alias("m"),
        F.when(first, F.col("terms")).alias("terms"), F.when(first, F.col("tfs")).alias("tfs")),
        f"members-{name}")

    at = np.searchsorted(rids, rows["rid"].to_numpy())
    term = pa.compute.index_in(rows["term"], value_set=vocabulary).to_numpy().astype(np.int64)
    postings = spark.sparkContext.broadcast(
        Postings(term, at, rows["qtf"].to_numpy(), weight, len(rids)))
    scored = (members.where("place = 1").select("head", "key", "m", "terms", "tfs")
              .mapInArrow(_score(postings, k), "at long, score long, head long"))
    scored = scratch.keep(scored, f"scored-{name}")
    heads = members.where("place = 1").select("head", F.col("key").alias("first"))
    by_class = W.partitionBy("at").orderBy(F.col("score").desc(), F.col("first").asc_nulls_last(), "head")
    top = (scored.join(heads, "head").withColumn("place", F.row_number().over(by_class))
           .where(F.col("place") <= k).drop("place", "first"))
    by_doc = W.partitionBy("at").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last(),
                                         "head", "place")
    ranked = (top.join(members.select("head", "place", "key"), "head")
              .withColumn("rank", F.row_number().over(by_doc)).where(F.col("rank") <= k))
    # back from places to items
    items = spark.createDataFrame([(i, r) for i, r in enumerate(rids.tolist())], "at long, rid long")
    named = block.select("rid", "item").distinct()
    out = scratch.keep(ranked.join(items, "at").join(named, "rid").select(
        "item", "rank", "key", "score"), f"ranked-{name}")
    scratch.drop(f"bags-{name}", f"members-{name}", f"scored-{name}")
    return out


def search(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text", k: int = BEST,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` highest-scoring rows of ``docs`` for each row of ``items``,
    of those that score above zero: ``item``, ``rank`` (from 1), ``key`` and
    ``score``; equal scores by ascending ``key``, nulls last.

    A document without text, or without a term, counts nowhere; items
    without a term that a document holds have no rows.  Rows that share a
    key are documents of their own, rows that share an item key are items
    of their own.  Other columns are not read.  Empty tables give no rows.
    """
    scratch = Scratch(docs.sparkSession, "lexical-search")
    terms, blocks = blocks_of(scratch.keep(item_terms(items, item, item_text), "items"), block_bytes)
    terms, found = scratch.keep(terms, "dealt"), None
    for i, b in enumerate(blocks or [0]):
        part = _rank_block(docs, terms.where(F.col("block") == b), scratch, str(i), k, key, text)
        found = part if found is None else found.unionByName(part)
    return found.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
