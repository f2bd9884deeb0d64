"""Near-duplicate embeddings with a forest of random-projection trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.llm.components import components

#: Vectors a leaf should hold, vectors compared with each other in one task at most, rows of one product.
LEAF, BLOCK, ROWS = 256, 2_048, 512
#: Vectors of leaves, copies counted, that are dealt to their leaves at once; bounds what shuffles hold on disk.
ROUND = 4_000_000
#: Vectors from which a split is fitted at least, and levels by which leaves that are still large deepen at once.
FITTED, STEP = 16, 6


@dataclass
class Forest:
    """``trees`` complete binary trees of ``depth`` random splits: a direction and a threshold per
    inner node, as arrays (tree, node, ...). Its size is bounded by the sample it was fitted on."""

    directions: np.ndarray
    thresholds: np.ndarray
    spill: float
    depth: int

    def leaves(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs; a row near a threshold goes down both sides. Leaves of tree t are
        numbered from t x 2^depth."""
        rows, leaves = [], []
        for t in range(len(self.thresholds)):
            row, node = np.arange(len(units)), np.zeros(len(units), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", units[row], self.directions[t, node]) - self.thresholds[t, node]
                left, right = side <= self.spill, side >= -self.spill
                row, node = np.concatenate((row[left], row[right])), np.concatenate((2 * node[left] + 1, 2 * node[right] + 2))
            rows.append(row)
            leaves.append(node - ((1 << self.depth) - 1) + (t << self.depth))
        return np.concatenate(rows), np.concatenate(leaves)


def grow(sample: np.ndarray, total: int, trees: int, spill: float, leaf: int = LEAF, seed: int = 0) -> Forest:
    """Splits at medians of a sample of unit vectors, as deep as ``total`` rows need for leaves of
    about ``leaf`` rows and as the sample can tell medians (``FITTED`` vectors); ``deepened`` goes on."""
    depth = max(0, min(ceil(log2(max(total / leaf, 1))), int(log2(max(len(sample) / FITTED, 1)))))
    random = np.random.default_rng(seed)
    width = sample.shape[1] if sample.size else 1
    directions = random.normal(size=(trees, (1 << depth) - 1, width))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    thresholds = np.zeros(directions.shape[:2])
    for t in range(trees):
        node = np.zeros(len(sample), np.int64)
        for level in range(depth):
            side = np.einsum("ij,ij->i", sample, directions[t, node])
            for n in range((1 << level) - 1, (2 << level) - 1):
                own = side[node == n]
                thresholds[t, n] = np.median(own) if len(own) else 0.0
            node = 2 * node + 1 + (side > thresholds[t, node])
    return Forest(directions, thresholds, spill, depth)


def fit_cuts(units: np.ndarray, directions: np.ndarray, levels: int, spill: float, fewest: int) -> np.ndarray:
    """Thresholds of a subtree of ``levels`` splits, infinite where a node stays whole: it has fewer
    than ``fewest`` vectors, or most of them lie so close to the median that they would go down both sides."""
    cuts, node = np.full((1 << levels) - 1, np.inf), np.zeros(len(units), np.int64)
    for level in range(levels):
        side = units @ directions[level]
        for n in range((1 << level) - 1, (2 << level) - 1):
            own = side[node == n]
            if len(own) >= fewest and np.mean(np.abs(own - np.median(own)) <= spill) <= 0.5:
                cuts[n] = np.median(own)
        node = 2 * node + 1 + (side > cuts[node])
    return cuts


def sub_leaves(units: np.ndarray, directions: np.ndarray, cuts: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, subleaf) pairs; ``directions`` per row and level, ``cuts`` per row, infinite where a node is whole."""
    sides = np.einsum("ij,ilj->il", units, directions)
    row, node = np.arange(len(units)), np.zeros(len(units), np.int64)
    for level in range(STEP):
        side = sides[row, level] - cuts[row, node]
        left, right = side <= spill, side >= -spill
        row, node = np.concatenate((row[left], row[right])), np.concatenate((2 * node[left] + 1, 2 * node[right] + 2))
    return row, node - ((1 << STEP) - 1)


def units_of(vectors: pa.Array) -> np.ndarray:
    """Unit vectors in double precision of a list array whose lists have one length."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    flat = flat / np.abs(flat).max(1, keepdims=True)  # no overflow or underflow in the norm
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def sharing(a: list[np.ndarray], b: list[np.ndarray], leaf: int) -> np.ndarray:
    """For rows with the leaves ``a`` and ``b`` whether two share one of a smaller number than ``leaf``."""
    flat = [np.concatenate([np.asarray(x, np.int64) for x in rows]) for rows in (a, b)]
    own = [np.repeat(np.arange(len(rows)), [len(x) for x in rows]) for rows in (a, b)]
    early = np.intersect1d(*flat)
    early, out = early[early < leaf], np.zeros((len(a), len(b)), bool)
    for at in range(0, len(early), BLOCK):
        part = early[at : at + BLOCK]
        known = [np.zeros((len(rows), len(part)), np.float32) for rows in (a, b)]
        for marks, rows, leaves in zip(known, own, flat):
            place = np.minimum(np.searchsorted(part, leaves), len(part) - 1)
            hit = part[place] == leaves
            marks[rows[hit], place[hit]] = 1
        out |= known[0] @ known[1].T > 0
    return out


def compare_block(a: pd.DataFrame, b: pd.DataFrame | None, leaf: int, least: float) -> tuple[list[np.ndarray], list[tuple]]:
    """Links between the rows of two blocks of one leaf (or within one block).

    A pair that already shares a leaf of a smaller number is left to that leaf, so a pair counts once.
    Returns for each block the number of linked vectors per row, and edges that connect what is linked.
    """
    first, second = a, a if b is None else b
    ua, ub = np.stack(first["unit"].to_numpy()), np.stack(second["unit"].to_numpy())
    counts, edges = [np.zeros(len(first), np.int64), np.zeros(len(second), np.int64)], []
    times_a, times_b = first["times"].to_numpy(), second["times"].to_numpy()
    ids_a, ids_b = first["node"].to_numpy(), second["node"].to_numpy()
    for at in range(0, len(first), ROWS):
        near = ua[at : at + ROWS] @ ub.T >= least
        if b is None:
            near &= np.arange(len(second))[None, :] > np.arange(at, at + len(near))[:, None]
        if not near.any():
            continue
        i, j = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        near[np.ix_(i, j)] &= ~sharing([first["leaves"].iat[at + k] for k in i], [second["leaves"].iat[k] for k in j], leaf)
        counts[0][at : at + ROWS] += near @ times_b
        counts[1] += times_a[at : at + ROWS] @ near
        i, j = np.nonzero(near)
        if len(i):
            edges += list(spanning(ids_a[at + i], ids_b[j]))
    return counts, edges


def spanning(u: np.ndarray, v: np.ndarray) -> Iterator[tuple[int, int]]:
    """At most one edge per node, with the same components as the edges (u, v)."""
    nodes, flat = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return zip(nodes[moved].tolist(), nodes[label[moved]].tolist())


def near_duplicates(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.9, trees: int = 8, spill: float = 0.025, sample: int = 20_000, seed: int = 0) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (other vectors linked directly), ``component_id``
    (smallest id reachable) and ``kept`` (is it its component's smallest id).

    Vectors link where they share a leaf of the forest and their cosine in double precision is at least
    ``least``; each tree halves by random projections and sends vectors within ``spill`` of a threshold
    down both sides, so a close pair is missed only if every tree parts it (tests measure recall). The
    first splits are fitted on at most about ``sample`` vectors, deeper ones on samples of their leaves;
    every vector is indexed. Equal vectors are
    folded to one before. A leaf that stays large is compared in blocks, none of it left out, and
    nothing but counts and a spanning edge per vector leaves a task. Null and zero vectors and vectors
    with null or non-finite components link with nothing; vectors link only with those of their own
    length. A null id takes part with no id of its own: its component is named by the smallest other
    id, null if there is none, and it is not kept. Repeated rows link with each other. No rows give none.
    """
    value = F.col(embedding)
    if rows.schema[embedding].dataType.simpleString() != "array<float>":  # floats are exact as they are
        value = value.cast("array<double>")
    good = F.coalesce((F.size(value) > 0) & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(value, lambda x: x != 0), F.lit(False))
    marked = rows.select(F.col(vec_id).cast("long").alias("vec_id"), value.alias("v"), good.alias("good"))
    classes = marked.where("good").groupBy("v").agg(F.count("*").alias("times"), F.min("vec_id").alias("least"))
    numbered = F.monotonically_increasing_id()  # kept by the write; no two vectors share one, as hashes might
    classes = staged(classes.select(numbered.alias("node"), F.xxhash64(F.col("v").cast("array<double>")).alias("mark"), "v", "times", "least", F.size("v").alias("width")))
    widths = [(r["width"], r["n"]) for r in classes.groupBy("width").agg(F.count("*").alias("n")).collect()]
    links = []
    for width, total in widths:
        own = classes.where(F.col("width") == width).select("node", "mark", "v", "times")
        links.append(_links(own, total, least, trees, spill, sample, seed))
    found = None
    for part in links:
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "node bigint, n bigint, other bigint")
    counts = found.groupBy("node").agg(F.sum("n").alias("linked"))
    roots = components(found.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")))
    told = classes.join(roots, "node", "left").select("node", "v", "times", "least", F.coalesce("root", "node").alias("root"))
    named = told.groupBy("root").agg(F.min("least").alias("component_id"))
    told = told.join(named, "root").join(counts, "node", "left")
    told = staged(told.select("v", (F.coalesce("linked", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id"))
    linked = marked.where("good").join(told, "v").select("vec_id", "n_links", "component_id")
    alone = marked.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = linked.unionByName(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def rounds(leaves: DataFrame) -> Iterator[DataFrame]:
    """Leaves (leaf, n) in parts of about ``ROUND`` vectors, one after the other. Shuffles of a part that is
    done are let go, so that disk does not hold all leaves at once."""
    count = ceil((leaves.agg(F.sum("n")).first()[0] or 0) / ROUND)
    for number in range(count):
        yield leaves.where(F.pmod(F.xxhash64("leaf"), F.lit(count)) == number)
        if count > 1:
            leaves.sparkSession.sparkContext._jvm.System.gc()  # Spark removes the files of shuffles nothing refers to


def deepened(placed: DataFrame, classes: DataFrame, forest: Forest, total: int, width: int, seed: int) -> DataFrame:
    """``placed`` (node, leaves) with leaves of about ``LEAF`` vectors however many vectors there are.

    The splits of ``grow`` come from one bounded sample; where the table needs deeper trees, leaves that
    are still large get subtrees of ``STEP`` levels, pass after pass. Each is fitted in a task of its own on
    a sample of its leaf, some ``FITTED`` vectors for each split of the last level, so no model of all leaves
    exists anywhere. Splits of a level share a direction per tree, which every task draws again.
    """
    missing, bits = ceil(log2(max(total / LEAF, 1))) - forest.depth, forest.depth
    for number in range(ceil(max(missing, 0) / STEP)):
        each = placed.select("node", F.explode("leaves").alias("leaf"))
        large = staged(each.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > 2 * LEAF))
        if large.isEmpty():
            break
        directions = np.random.default_rng((seed, number + 1)).normal(size=(len(forest.thresholds), STEP, width))
        directions /= np.linalg.norm(directions, axis=2, keepdims=True)
        placed = staged(_deeper(each, large, classes, directions, bits, forest.spill, seed + number))
        bits += STEP
    return placed


def _deeper(each: DataFrame, large: DataFrame, classes: DataFrame, directions: np.ndarray, bits: int, spill: float, seed: int) -> DataFrame:
    """One pass of ``deepened``: a leaf's subleaves are numbered from leaf x 2^STEP."""

    def levels(n: float) -> int:
        return min(STEP, max(1, ceil(log2(n / LEAF))))

    def fit(batch: pa.Table) -> pa.Table:
        leaf, n = batch["leaf"][0].as_py(), batch["n"][0].as_py()
        units = units_of(batch["v"].combine_chunks())
        cuts = np.full((1 << STEP) - 1, np.inf)
        own = fit_cuts(units[np.lexsort(units.T[:4])], directions[leaf >> bits], levels(n), spill, FITTED)
        cuts[: len(own)] = own
        return pa.table({"leaf": pa.array([leaf], pa.int64()), "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64()))})

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                b = whole.slice(at, 2_000)
                leaf, node = b.column("leaf").to_numpy(), b.column("node").to_numpy()
                cuts = b.column("cuts").flatten().to_numpy().reshape(b.num_rows, -1)
                row, sub = sub_leaves(units_of(b.column("v")), directions[leaf >> bits], cuts, spill)
                yield pa.RecordBatch.from_arrays([pa.array(node[row]), pa.array((leaf[row] << STEP) + sub)], ["node", "leaf"])

    own, none = classes.select("node", "v"), F.array_repeat(F.lit(float("inf")), (1 << STEP) - 1)
    share = F.lit(1.0 * FITTED * (1 << STEP)) / F.col("n")
    sampled = F.pmod(F.xxhash64(F.lit(seed), "mark"), F.lit(1_000_003)) < F.lit(1_000_003) * share

    def subleaves(part: DataFrame) -> DataFrame:
        inner = each.join(part, "leaf")
        some = inner.join(classes.select("node", "mark"), "node").where(sampled).join(own, "node")
        models = some.select("leaf", "n", "v").groupBy("leaf").applyInArrow(fit, "leaf bigint, cuts array<double>")
        asked = inner.join(own, "node").join(models, "leaf", "left").select("node", "leaf", "v", F.coalesce("cuts", none).alias("cuts"))
        return staged(asked.mapInArrow(descend, "node bigint, leaf bigint"))

    fresh = reduce(DataFrame.unionByName, [subleaves(part) for part in rounds(large)])
    stay = each.join(large, "leaf", "left_anti").select("node", (F.col("leaf") * (1 << STEP)).alias("leaf"))
    return fresh.unionByName(stay).groupBy("node").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))


def _links(classes: DataFrame, total: int, least: float, trees: int, spill: float, sample: int, seed: int) -> DataFrame:
    """(node, n, other): linked vectors per node and edges, for vectors of one length."""
    some = classes.where(F.pmod(F.xxhash64(F.lit(seed), "mark"), F.lit(1_000_003)) < F.lit(1_000_003.0 * sample / max(total, 1))).select("v")
    fitted = units_of(some.toArrow()["v"].combine_chunks())
    forest = grow(fitted[np.lexsort(fitted.T[:4])] if len(fitted) else fitted, total, trees, spill, seed=seed)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                b = whole.slice(at, 2_000)
                row, leaf = forest.leaves(units_of(b.column("v")))
                order = np.lexsort((leaf, row))
                row, leaf = row[order], leaf[order]
                cut = np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column("node"), pa.ListArray.from_arrays(cut, pa.array(leaf, pa.int64()))], ["node", "leaves"])

    placed = staged(classes.select("node", "v").mapInArrow(assign, "node bigint, leaves array<bigint>"))
    placed = deepened(placed, classes, forest, total, fitted.shape[1], seed)
    # Leaves are counted and joined as numbers; vectors move once, when they are dealt to their leaves.
    each = placed.select("node", F.explode("leaves").alias("leaf"))
    sizes = staged(each.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1"))

    def compare(key: tuple, batch: pa.Table) -> pa.Table:
        leaf, p, q = (x.as_py() for x in key)
        frame = batch.select(["node", "times", "part", "leaves"]).to_pandas()
        frame["unit"] = list(units_of(batch["v"].combine_chunks()))
        if p == q:
            groups, (counts, edges) = [frame], compare_block(frame, None, leaf, least)
            counts = [counts[0] + counts[1]]
        else:
            groups = [frame[frame["part"] == p], frame[frame["part"] == q]]
            counts, edges = compare_block(*groups, leaf, least) if len(groups[0]) and len(groups[1]) else ([np.zeros(len(g), np.int64) for g in groups], [])
        node = np.concatenate([g["node"].to_numpy() for g in groups])
        n = np.concatenate(counts)
        hit = n > 0
        u = np.concatenate((node[hit], np.array([e[0] for e in edges], np.int64)))
        other = pa.array([None] * int(hit.sum()) + [e[1] for e in edges], pa.int64())
        return pa.table({"node": pa.array(u, pa.int64()), "n": pa.array(np.concatenate((n[hit], np.zeros(len(edges), np.int64))), pa.int64()), "other": other})

    def compared(part: DataFrame) -> DataFrame:
        met = each.join(part, "leaf").groupBy("node").agg(F.collect_list(F.struct("leaf", "n")).alias("met"))
        spread = met.join(placed, "node").join(classes.drop("mark"), "node").select("node", "leaves", "times", "v", F.explode("met").alias("m"))
        spread = spread.select("node", F.filter("leaves", lambda x: x < F.col("m.leaf")).alias("leaves"), "times", "v", "m.leaf", "m.n")
        # A leaf of n vectors is cut into parts of BLOCK; every pair of parts is one group of work.
        parts = F.ceil(F.col("n") / BLOCK)
        own = F.pmod(F.xxhash64(F.lit(seed + 1), "node"), parts)
        work = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda o: F.struct(F.least(own, o).alias("p"), F.greatest(own, o).alias("q")))
        dealt = spread.select("node", "leaves", "leaf", own.alias("part"), "times", "v", F.explode(work).alias("w"))
        rows = dealt.select("node", "leaves", "leaf", "part", "w.p", "w.q", "times", "v")
        return staged(rows.groupBy("leaf", "p", "q").applyInArrow(compare, "node bigint, n bigint, other bigint"))

    found = [compared(part) for part in rounds(sizes)]
    if not found:
        return classes.limit(0).select("node", F.lit(0).cast("long").alias("n"), F.col("node").alias("other"))
    return reduce(DataFrame.unionByName, found)
