"""Embedding near-duplicates: a forest of random-projection trees.

Vectors of equal label and length are split again and again by random
hyperplanes, near the median where fewest vectors are, and those close to
a hyperplane go to both sides (spill).  Each tree ends in leaves of
bounded size; vectors are compared within leaves, in double precision, and
the links of all trees are united.

A round splits every node that is too large by a small subtree, fitted on
a bounded sample of that node alone, so models are as many rows as nodes
and nothing global is gathered.  Equal vectors are one class throughout.
A leaf that hyperplanes cannot thin out (many vectors closer together
than the spill) is dealt out in pairs of bounded blocks.  A pair that
meets in several leaves is counted in the one of least key only, so tasks
return links per vector and one link towards the group, never pairs.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch
from tidemark.llm.components import connected_components
from tidemark.llm.ngram_join import roots_of

#: Trees are as many as find a pair at the threshold with ``RECALL``.
THRESHOLD, RECALL = 0.93, 0.99
#: Vectors of a leaf at most; expected sample of a node for its subtree;
#: levels of a subtree.
LEAF, SAMPLE, LEVELS = 768, 1024, 4
#: Half width of the spill, in units of the projected distance of two
#: vectors that are just similar enough.
SPILL = 0.35
#: A split that would put more of a node's vectors on both sides leaves it
#: whole: its vectors are then so near each other that hyperplanes lose pairs.
SPILLED = 0.2
NODE = ["tree", "label", "dim", "node"]


def direction(tree: int, node: int, dim: int) -> np.ndarray:
    """The random unit vector that splits a node."""
    u = np.random.default_rng([tree, node, dim]).normal(size=dim)
    return u / np.linalg.norm(u)


def spill_width(threshold: float, dim: int, spill: float = SPILL) -> float:
    return spill * math.sqrt(2 * (1 - threshold) / dim)


def split_loss(spill: float, spilled: float = SPILLED) -> float:
    """Share of pairs at the threshold that a split parts, at most: those of
    normal projections of which ``spilled`` are in the spill."""
    z, both = NormalDist(), 2 * spill
    apart = 2 * (z.pdf(both) - both * (1 - z.cdf(both)))
    return apart * z.pdf(0) * z.inv_cdf(0.5 + spilled / 2) / spill


def trees_for(n, leaf: int, recall: float = RECALL, spill: float = SPILL,
              spilled: float = SPILLED):
    """Column: trees with which a pair at the threshold, among ``n`` vectors
    of a label, shares a leaf with probability ``recall``."""
    levels = F.ceil(F.greatest(F.lit(0.0), F.log(n / F.lit(leaf)))
                    / F.lit(-math.log((1 + spilled) / 2)))
    together = F.pow(F.lit(1 - split_loss(spill, spilled)), levels)
    return F.when(levels == 0, F.lit(1)).otherwise(
        F.ceil(F.lit(math.log(1 - recall)) / F.log(1 - together))).cast("int")


def _matrix(column, dim: int) -> np.ndarray:
    """Unit vectors in double precision (scaled first: squares of very large
    or small components leave its range)."""
    x = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_subtree(x: np.ndarray, tree: int, node: int, population: float, *, leaf: int,
                width: float, levels: int = LEVELS) -> dict[int, float]:
    """Node -> threshold for the splits below ``node``, from a sample of it.
    Of the quantiles between 0.3 and 0.7 that one splits which has fewest
    vectors in its spill.  A node with more than ``SPILLED`` of its vectors
    there is left whole."""
    out: dict[int, float] = {}
    todo = [(node, np.arange(len(x)), levels)]
    while todo:
        at, rows, left = todo.pop()
        if not left or len(rows) < 32 or population * len(rows) / len(x) <= leaf:
            continue
        p = x[rows] @ direction(tree, at, x.shape[1])
        s = np.sort(p)
        cuts = np.quantile(s, np.linspace(0.3, 0.7, 21))
        inside = np.searchsorted(s, cuts + width, "right") - np.searchsorted(s, cuts - width)
        off = np.abs(np.linspace(0.3, 0.7, 21) - 0.5) * 0.1 * len(s)
        t = float(cuts[np.argmin(inside + off)])
        low, high = rows[p <= t + width], rows[p > t - width]
        if len(low) + len(high) - len(rows) > SPILLED * len(rows):
            continue
        out[at] = t
        todo += [(2 * at, low, left - 1), (2 * at + 1, high, left - 1)]
    return out


def route(x: np.ndarray, tree: int, node: int, splits: dict[int, float], width: float):
    """(row, node) of every place of every vector below ``node``."""
    places = []
    todo = [(node, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        if at not in splits or not len(rows):
            places.append((rows, np.full(len(rows), at, np.int64)))
            continue
        p = x[rows] @ direction(tree, at, x.shape[1])
        todo += [(2 * at, rows[p <= splits[at] + width]), (2 * at + 1, rows[p > splits[at] - width])]
    return tuple(np.concatenate(c) for c in zip(*places))


def _fit(leaf: int, threshold: float, spill: float):
    def fit(key, rows):
        tree, label, dim, node = (k.as_py() for k in key)
        splits = fit_subtree(_matrix(rows["vector"], dim), tree, node,
                             float(rows["n"][0].as_py()), leaf=leaf,
                             width=spill_width(threshold, dim, spill))
        return pa.table({"tree": pa.array([tree], pa.int32()), "label": [label],
                         "dim": pa.array([dim], pa.int32()), "node": [node],
                         "nodes": pa.array([list(splits)], pa.list_(pa.int64())),
                         "cuts": pa.array([list(splits.values())], pa.list_(pa.float64()))})
    return fit


def _route(threshold: float, spill: float):
    """Rows (id, size, vector, tree, label, dim, node, nodes, cuts) to their
    places; ``whole`` where a node has no split."""
    def run(batches):
        for b in batches:
            keys: dict[tuple, list[int]] = {}
            for i, k in enumerate(zip(*(b.column(c).to_pylist() for c in (3, 4, 5, 6)))):
                keys.setdefault(k, []).append(i)
            for (tree, _, dim, node), rows in keys.items():
                part = b.take(pa.array(rows))
                splits = dict(zip(part.column(7)[0].as_py(), part.column(8)[0].as_py()))
                width = spill_width(threshold, dim, spill)
                row, at = route(_matrix(part.column(2), dim), tree, node, splits, width)
                part = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(6)), pa.array(at),
                     pa.array(np.full(len(at), not splits))],
                    ["id", "size", "vector", "tree", "label", "dim", "node", "whole"])
    return run


def _compare(threshold: float):
    """Task of one leaf, or of one pair of blocks of it."""
    def compare(key, rows):
        leaf, i, j = (k.as_py() for k in key)
        ids, size, block = (rows[c].to_numpy() for c in ("id", "size", "block"))
        x = _matrix(rows["vector"], rows["dim"][0].as_py())
        linked = x @ x.T >= threshold
        np.fill_diagonal(linked, False)
        if i != j:
            linked &= block[:, None] != block[None, :]
        roots = ids[roots_of(linked)]
        # a pair counts in the least leaf that it shares
        leaves = rows["leaves"].combine_chunks()
        flat = leaves.flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(ids)),
                          pa.compute.list_value_length(leaves).to_numpy(zero_copy_only=False))
        before = flat < leaf
        names, col = np.unique(flat[before], return_inverse=True)
        met = np.zeros((len(ids), len(names)), np.float32)
        met[owner[before], col] = 1
        links = (linked & ((met @ met.T) == 0)) @ size
        keep = linked.any(axis=1)
        return pa.table({"id": ids[keep], "links": links[keep], "root": roots[keep]})
    return compare


def near_duplicates(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding",
                    label: str = "label", threshold: float = THRESHOLD, trees: int | None = None,
                    leaf: int = LEAF, sample: int = SAMPLE, spill: float = SPILL,
                    recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors``: ``key``, ``n_links`` (other vectors
    linked directly), ``component_id`` (least key reachable by links, its
    own included) and ``kept`` (key = component_id).

    Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, nor do those with a null label; vectors
    of different lengths are never similar.  A null key takes part; it is
    the greatest of its component and never kept.  Rows that share a key
    and a vector count as two vectors.  No rows give no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "forest")
    v = vectors.select(F.monotonically_increasing_id().alias("rid"),
                       F.col(f"`{key}`").cast("bigint").alias("key"),
                       F.col(f"`{label}`").cast("string").alias("label"),
                       F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    fine = (F.col("label").isNotNull() & F.col("vector").isNotNull()
            & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)
                       & (F.abs(x) != F.lit(float("inf"))))
            & F.exists("vector", lambda x: x != 0))
    v = v.withColumn("digest", F.when(F.coalesce(fine, F.lit(False)), F.md5(
        F.concat_ws(",", "label", F.col("vector").cast("array<string>")))))
    v = scratch.keep(v, "vectors")
    least = F.min(F.struct(F.col("key").isNull().alias("n"), "key", "rid")).alias("least")
    classes = scratch.keep(
        v.where("digest IS NOT NULL").groupBy("digest")
        .agg(least, F.count("*").alias("size"), F.first("label").alias("label"),
             F.first("vector").alias("vector"))
        .select("digest", F.col("least.rid").alias("id"), "least", "size", "label", "vector"),
        "classes")

    classed = classes.withColumn("dim", F.size("vector"))
    counts = scratch.keep(classed.groupBy("label", "dim").agg(F.count("*").alias("n")).select(
        "label", "dim", (trees_for(F.col("n"), leaf, recall, spill) if trees is None
                         else F.lit(trees)).alias("trees")), "trees")
    state = classed.join(counts, ["label", "dim"]).select(
        "id", "size", "vector", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree"),
        "label", "dim", F.lit(1).cast("bigint").alias("node"))
    finished, round_ = None, 0
    while True:
        large = scratch.keep(state.groupBy(*NODE).agg(F.count("*").alias("n"))
                             .where(F.col("n") > leaf), f"large-{round_}")
        some = (state.join(large, NODE)
                .where(F.pmod(F.xxhash64("id", "tree", F.lit(round_)), F.lit(1_000_000))
                       < F.lit(1_000_000.0 * sample) / F.col("n"))
                .select(*NODE, "n", "vector"))
        model = scratch.keep(some.groupBy(*NODE).applyInArrow(
            _fit(leaf, threshold, spill),
            "tree int, label string, dim int, node long, nodes array<long>, cuts array<double>"),
            f"model-{round_}")
        small = state.join(large.drop("n"), NODE, "left_anti").select(
            "id", "size", "vector", *NODE)
        finished = small if finished is None else finished.unionByName(small)
        if large.isEmpty():
            break
        routed = scratch.keep(
            state.join(model, NODE).select("id", "size", "vector", *NODE, "nodes", "cuts")
            .mapInArrow(_route(threshold, spill), "id long, size long, vector array<double>, "
                        "tree int, label string, dim int, node long, whole boolean"),
            f"state-{round_}")
        finished = finished.unionByName(routed.where("whole").drop("whole"))
        state = routed.where("NOT whole").drop("whole")
        round_ += 1

    # a label that several trees leave whole is compared in the first of them
    whole = scratch.keep(finished.where("node = 1").groupBy("label", "dim").agg(
        F.min("tree").alias("first")), "whole")
    places = (finished.join(whole, ["label", "dim"], "left")
              .where("node != 1 OR tree = first").withColumn("leaf", F.xxhash64(*NODE)))
    places = scratch.keep(places.select("id", "size", "vector", "dim", "leaf"), "places")
    of_id = places.groupBy("id").agg(F.collect_set("leaf").alias("leaves"))
    blocks = scratch.keep(places.groupBy("leaf").agg(
        F.count("*").alias("n")).where("n > 1").select(
        "leaf", F.when(F.col("n") <= 2 * leaf, F.lit(1)).otherwise(
            F.ceil(F.col("n") / F.lit(leaf))).cast("int").alias("blocks")), "blocks")
    dealt = (places.join(of_id, "id").join(blocks, "leaf")
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
             .select("id", "size", "vector", "dim", "leaf", "leaves", "block", "i", "j"))
    found = scratch.keep(dealt.groupBy("leaf", "i", "j").applyInArrow(
        _compare(threshold), "id long, links long, root long"), "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select("id", "root"), scratch, "groups")
    of_class = scratch.keep(
        classes.select("digest", "id", "least", "size").join(links, "id", "left")
        .join(groups, "id", "left")
        .select("digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                "least", F.coalesce("root", "id").alias("group")), "of-class")
    first = scratch.keep(of_class.groupBy("group").agg(F.min("least").alias("first")), "firsts")
    of_class = of_class.join(first, "group").select(
        "digest", "n_links", F.col("first.key").alias("component_id"))
    of_class = scratch.keep(of_class, "of-group")
    # what the result does not read
    scratch.drop("classes", "places", "blocks", "found", "of-class", "firsts", "trees", "whole",
                 *(f"{x}-{r}" for r in range(round_ + 1) for x in ("large", "model", "state")))
    rows = v.select("key", "digest")
    linked = rows.where("digest IS NOT NULL").join(of_class, "digest").select(
        "key", "n_links", "component_id")
    alone = rows.where("digest IS NULL").select(
        "key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)))
