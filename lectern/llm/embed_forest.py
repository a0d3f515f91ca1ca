"""Embedding near-duplicates through a forest of random-projection trees with spill."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import components, durable

TREES = 10
#: A node with more vectors is split again.
LEAF_VECTORS = 256
#: Both children take the vectors whose projection lies between these quantiles of their node.
SPILL = (0.45, 0.55)
#: Deepest split. A node twice as large needs one more, so this is out of reach for data that can be split at all.
MAX_DEPTH = 48
#: Rows of one block of a comparison.
BLOCK = 512


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1. They are first divided by their largest magnitude, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def projections(embedding, trees: int, depth: int, seed: int):
    """array<double>: the unit vector of an embedding on the random direction of this depth in each tree, with a jitter of 1e-9 that lets vectors that coincide be split."""

    @F.arrow_udf("array<double>")
    def project(vectors: pa.Array, ids: pa.Array) -> pa.Array:
        out = np.empty((len(vectors), trees))
        values, starts = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum([0, *(len(v) for v in vectors)])
        sizes = np.diff(starts)
        for width in np.unique(sizes):
            rows = np.flatnonzero(sizes == width)
            x = values[(starts[rows][:, None] + np.arange(width)).ravel()].reshape(len(rows), width)
            x = unit(x)
            out[rows] = x @ np.random.default_rng([seed, depth, int(width)]).standard_normal((width, trees))
        rng_bits = (ids.to_numpy(zero_copy_only=False).astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9) * np.uint64(depth + 1))
        out += ((rng_bits >> np.uint64(40)).astype(np.float64) / (1 << 24) - 0.5) * 1e-9
        return pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, trees), pa.int32()), pa.array(out.ravel()))

    return project(embedding, F.col("vec"))


def grow(vectors: DataFrame, trees: int, leaf_vectors: int, seed: int) -> DataFrame:
    """(vec, tree, leaf): the leaves of each vector in each tree. vectors: vec (distinct long), label, embedding.

    A level at a time, for all trees and labels together: nodes over leaf_vectors get two quantiles of their projections, and their vectors go left, right or, between the quantiles, both ways.
    A node is a hash of its tree, label and the turns that lead to it.
    """
    node = vectors.select("vec", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.xxhash64("label").alias("node"))
    node = node.withColumn("node", F.xxhash64("tree", "node"))
    done, node = None, durable(node)
    for depth in range(MAX_DEPTH):
        sizes = node.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"))
        large = durable(sizes.where(F.col("n") > leaf_vectors).select("tree", "node"))
        small = node if large.isEmpty() else node.join(large, ["tree", "node"], "left_anti")
        done = small if done is None else done.unionByName(small)
        if large.isEmpty():
            break
        split = node.join(large, ["tree", "node"])
        on = vectors.select("vec", projections(F.col("embedding"), trees, depth, seed).alias("on"))
        split = split.join(on, "vec").select("vec", "tree", "node", F.element_at("on", F.col("tree") + 1).alias("x"))
        split = durable(split)
        cuts = split.groupBy("tree", "node").agg(F.percentile_approx("x", F.array(*map(F.lit, SPILL)), F.lit(1000)).alias("q")).select("tree", "node", F.get("q", F.lit(0)).alias("lo"), F.get("q", F.lit(1)).alias("hi"))
        turns = F.filter(F.array(F.when(F.col("x") <= F.col("hi"), F.lit(0)), F.when(F.col("x") >= F.col("lo"), F.lit(1))), lambda t: t.isNotNull())
        node = split.join(cuts, ["tree", "node"]).select("vec", "tree", "node", F.explode(turns).alias("turn"))
        node = durable(node.select("vec", "tree", F.xxhash64("node", "turn").alias("node")))
    else:
        done = done.unionByName(node)
    return done.withColumnRenamed("node", "leaf")


def unit_rows(rows: list[list[float]]) -> np.ndarray:
    """Rows of one length, scaled to length 1, in double precision."""
    return unit(np.array(rows, np.float64))


def reached(x: np.ndarray, threshold: float) -> list[np.ndarray]:
    """The rows of each component of two or more among unit vectors whose cosine is at least threshold."""
    near = [np.concatenate([x[a : a + BLOCK] @ x[b : b + BLOCK].T >= threshold for b in range(0, len(x), BLOCK)], axis=1) for a in range(0, len(x), BLOCK)]
    degree = np.concatenate([n.sum(axis=1) for n in near])
    fresh, out = degree > 1, []
    for i in np.flatnonzero(fresh):
        if not fresh[i]:
            continue
        fresh[i] = False
        own, front = [], [i]
        while front:
            own += front
            hit = np.zeros(len(x), bool)
            for f in front:
                hit |= near[f // BLOCK][f % BLOCK]
            hit &= fresh
            fresh &= ~hit
            front = np.flatnonzero(hit).tolist()
        out.append(np.array(own))
    return out


def connect_leaves(leaves: DataFrame, threshold: float) -> DataFrame:
    """(vec, low): for each leaf and vector that links within it, the smallest vector that it reaches there. leaves: tree, leaf, vec, embedding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        vec, rows = t["vec"].to_numpy(), t["embedding"].to_pylist()
        sizes = np.array([len(r) for r in rows])
        for width in np.unique(sizes):
            at = np.flatnonzero(sizes == width)
            for own in reached(unit_rows([rows[i] for i in at]), threshold):
                ids = vec[at[own]]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.full(len(ids), ids.min()))], ["vec", "low"])

    return leaves.groupBy("tree", "leaf").applyInArrow(run, "vec long, low long")


def count_links(placed: DataFrame, threshold: float) -> DataFrame:
    """(vec, found): with how many vectors of its component each vector links, weighted by their copies, of all pairs of the component. placed: vec, component, copies, embedding.

    A component of more than BLOCK vectors is dealt over blocks by hash and each two blocks meet in a group of their own, so no task holds a whole one. Smaller ones share groups.
    """
    sizes = placed.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cells = max(1, -(-placed.count() // BLOCK))
    own = placed.join(sizes, "component").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    own = own.withColumn("block", F.pmod(F.xxhash64("vec", F.lit(1)), F.col("blocks")))
    own = own.withColumn("home", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(cells))).otherwise(F.col("component")))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.select("home", (F.col("blocks") == 1).alias("whole"), F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "component", "vec", "copies", "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)).sort_by("component")
        vec, copies, block, component = (t[c].to_numpy() for c in ("vec", "copies", "block", "component"))
        rows, a, b = t["embedding"].to_pylist(), t["a"][0].as_py(), t["b"][0].as_py()
        found = np.zeros(len(vec), np.int64)
        edges = [0, *(np.flatnonzero(np.diff(component)) + 1), len(vec)]
        for lo, hi in zip(edges, edges[1:]):
            x, side = unit_rows(rows[lo:hi]), block[lo:hi]
            p, q = lo + np.flatnonzero(side == a), lo + np.flatnonzero(side == b)
            near = x[p - lo] @ x[q - lo].T >= threshold
            if a == b:
                np.fill_diagonal(near, False)
            found[p] += near @ copies[q]
            if a != b:
                found[q] += copies[p] @ near
        yield pa.RecordBatch.from_arrays([pa.array(vec), pa.array(found)], ["vec", "found"])

    return met.groupBy("whole", "home", "a", "b").applyInArrow(run, "vec long, found long").groupBy("vec").agg(F.sum("found").alias("found"))


def identified(kinds: DataFrame, number: Callable[[int], Column]) -> tuple[DataFrame, Column]:
    """kinds with vec, a long that no two rows share, and the column that gives it: number of the first of 0, 1, 2... by which no two rows agree."""
    for salt in count():
        own = durable(kinds.withColumn("vec", number(salt)))
        if own.groupBy("vec").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            return own, number(salt)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label", *, threshold: float = 0.93, trees: int = TREES, leaf_vectors: int = LEAF_VECTORS, seed: int = 7) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept, of links between vectors of one label and size whose cosine is at least threshold.

    Equal vectors are compared once and counted by their number. Vectors that are null, empty, zero or hold a null or a value that isn't finite, and rows with a null label, link with nothing: 0 links, a component of their own.
    label_col None: one label for all. Null ids keep their row, count as links, and are never a component's smallest. Rows that repeat an id with the same vector are copies. Other columns are not read. No rows give none.
    The forest only tells which vectors belong together: all pairs of a component are then compared, however many it has. A link is missed only if no chain of links within leaves joins its ends (README: recall against brute force).
    """
    label = F.col(label_col) if label_col else F.lit(0)
    rows = vectors.select(F.col(id_col).alias("vec_id"), label.alias("label"), F.col(vec_col).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite, F.lit(False))
    whole = durable(rows.withColumn("usable", usable))
    kinds = whole.where("usable").groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    kinds, vec = identified(kinds, lambda salt: F.xxhash64(F.lit(salt), "label", "embedding"))
    leaves = durable(grow(kinds.select("vec", "label", "embedding"), trees, leaf_vectors, seed))
    full = leaves.join(kinds.select("vec", "embedding"), "vec")
    joined = connect_leaves(full.select("tree", "leaf", "vec", "embedding"), threshold).distinct()
    groups = durable(components(joined, "vec", "low").withColumnRenamed("node", "vec"))
    counts = count_links(groups.join(kinds.select("vec", "copies", "embedding"), "vec"), threshold)
    placed = kinds.select("vec", "copies", "least").join(groups, "vec", "left").join(counts, "vec", "left").select("vec", "copies", "least", F.coalesce("component", "vec").alias("component"), F.coalesce("found", F.lit(0)).alias("found"))
    low = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    result = placed.join(low, "component").select("vec", (F.col("copies") - 1 + F.col("found")).cast("long").alias("n_links"), "component_id")
    linked = whole.where("usable").select("vec_id", vec.alias("vec")).join(result, "vec").select("vec_id", "n_links", "component_id")
    alone = whole.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
