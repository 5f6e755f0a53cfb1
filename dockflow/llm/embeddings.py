"""Embedding near-duplicates with a forest of random-projection trees.

A tree splits the vectors again and again by a random direction; vectors close to a split go to
both sides (spill). Vectors are compared exactly within each leaf, over many trees, and the links
found are united. A pair that shares several leaves is counted in the first of them only, so that
numbers of links need no list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import components, number_batches, written


@dataclass(frozen=True)
class Forest:
    """Parameters of the forest.

    ``sample`` bounds the vectors that the splits are fitted on (on the driver: ``sample`` times
    the dimension in doubles); every vector is routed and compared. Leaves aim at ``leaf`` vectors.
    ``spill`` is the half width of the overlap, in the mean distance that two vectors at the
    threshold have along a random direction. ``block`` bounds what one task compares at once.
    """

    trees: int = 8
    leaf: int = 400
    spill: float = 0.25
    sample: int = 20_000
    least_sample: int = 40
    block: int = 2048
    seed: int = 7


@dataclass
class Tree:
    """Split directions, thresholds and children (negative: -1 - crown leaf) of one fitted tree."""

    directions: list[np.ndarray] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    centers: list[np.ndarray] = field(default_factory=list)
    extra: list[int] = field(default_factory=list)


def _unit(rng: np.random.Generator, dim: int) -> np.ndarray:
    v = rng.standard_normal(dim)
    return v / np.linalg.norm(v)


def fit_tree(sample: np.ndarray, population: float, forest: Forest, seed: int) -> Tree:
    """Split a sample at medians down to ``leaf`` expected vectors or ``least_sample`` sampled ones.

    A leaf that the sample cannot split further gets ``extra`` levels of splits through its centre,
    in directions that follow from the seed and the path.
    """
    rng, tree = np.random.default_rng(seed), Tree()
    scale = population / max(1, len(sample))

    def grow(rows: np.ndarray) -> int:
        expected = len(rows) * scale
        if expected <= forest.leaf or len(rows) < 2 * forest.least_sample:
            tree.centers.append(rows.mean(0) if len(rows) else np.zeros(sample.shape[1]))
            tree.extra.append(max(0, ceil(log2(max(1.0, expected / forest.leaf)))))
            return -len(tree.centers)
        direction = _unit(rng, sample.shape[1])
        along = rows @ direction
        at = float(np.median(along))
        left, right = rows[along <= at], rows[along > at]
        if not len(right):  # all on one spot: more levels cannot separate them
            tree.centers.append(rows.mean(0))
            tree.extra.append(0)
            return -len(tree.centers)
        node = len(tree.directions)
        tree.directions.append(direction)
        tree.thresholds.append(at)
        tree.children.append([0, 0])
        tree.children[node] = [grow(left), grow(right)]
        return node

    grow(sample)
    return tree


def route(x: np.ndarray, tree: Tree, margin: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and leaf numbers of unit vectors; a row is in several leaves where splits overlap."""
    rows, leaves = [], []
    todo = [(0 if tree.directions else -1, np.arange(len(x)))]

    def both(along: np.ndarray, at: float, idx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return idx[along <= at + margin], idx[along > at - margin]

    while todo:
        node, idx = todo.pop()
        if not len(idx):
            continue
        if node >= 0:
            left, right = both(x[idx] @ tree.directions[node], tree.thresholds[node], idx)
            todo += [(tree.children[node][0], left), (tree.children[node][1], right)]
            continue
        crown = -1 - node
        below = [(1, idx)]
        for level in range(tree.extra[crown]):
            deeper = []
            for path, part in below:
                direction = _unit(np.random.default_rng([seed, crown, path]), x.shape[1])
                left, right = both(x[part] @ direction, float(tree.centers[crown] @ direction), part)
                deeper += [(2 * path, left), (2 * path + 1, right)]
            below = [(p, i) for p, i in deeper if len(i)]
        for path, part in below:
            rows.append(part)
            leaves.append(np.full(len(part), crown << 24 | path, np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(leaves)


def _valid(name: str):
    v = F.col(name).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & good & F.exists(v, lambda x: x != 0)


def _first_shared(a: np.ndarray, b: np.ndarray, none: int) -> np.ndarray:
    """Smallest common entry of the rows of two padded matrices (padding negative)."""
    shared = (a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)
    return np.where(shared.any(2), a, none).min(1)


def near_duplicates(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    forest: Forest = Forest(),
) -> DataFrame:
    """One row ``(key, n_links, component_id, kept)`` per vector.

    Vectors are linked if their cosine, in doubles, is at least ``threshold`` and some tree has
    them in one leaf. ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest key that links reach, ``kept`` says whether that is the row's own. Null, empty and
    zero vectors and those with null or non-finite components link with nothing; vectors are
    compared with those of their own length. Equal vectors are one class, compared once. Repeated
    rows are rows of their own; a row with a null key is never kept, has links like any other, and
    its component is null only if no linked row has a key.

    A leaf of more than ``block`` vectors, as one group of near copies can make it, is cut into
    blocks, and every two blocks are compared in a group of their own.
    """
    spark = df.sparkSession
    number_batches(spark, 2000)
    rows = df.select(F.col(key).alias("_k"), F.col(vector).cast("array<double>").alias("_v"), _valid(vector).alias("_ok"))
    # a plain sum makes -0.0 and 0.0 equal, as they are for the cosine
    rows = rows.withColumn("_v", F.when(F.col("_ok"), F.transform("_v", lambda x: x + F.lit(0.0))))
    classes = written(
        rows.where("_ok").groupBy("_v").agg(F.min("_k").alias("least"), F.count("*").alias("copies"))
        .withColumn("node", F.xxhash64("_v")).withColumn("rank", F.hash("_v")),
        "classes",
    )
    found = []
    for dim in sorted(r[0] for r in classes.select(F.size("_v")).distinct().collect()):
        found.append(_links_of(classes.where(F.size("_v") == dim), dim, threshold, forest))
    if found:
        counts, edges = found[0]
        for c, e in found[1:]:
            counts, edges = counts.union(c), edges.union(e)
        counts = counts.groupBy("node").agg(F.sum("links").alias("links"))
        nodes = components(edges)
    else:
        counts = spark.createDataFrame([], "node long, links long")
        nodes = spark.createDataFrame([], "node long, component long")
    counts, nodes = written(counts, "counts"), written(nodes, "nodes")
    rooted = written(
        classes.join(nodes, "node", "left").join(counts, "node", "left")
        .select("_v", "least", "copies", F.coalesce("component", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links")),
        "rooted",
    )
    roots = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    named = written(
        rooted.join(roots, "root").select("_v", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"),
        "named",
    )
    return (
        rows.where("_ok").join(named, "_v").select("_k", "n_links", "component_id")
        .unionAll(rows.where("not _ok").select("_k", F.lit(0).cast("long"), "_k"))
        .select(F.col("_k").alias(key), "n_links", "component_id",
                F.coalesce(F.col("_k") == F.col("component_id"), F.lit(False)).alias("kept"))
    )


def _links_of(classes: DataFrame, dim: int, threshold: float, forest: Forest) -> tuple[DataFrame, DataFrame]:
    """Numbers of linked rows per class, and edges that connect the classes of each component."""
    context = classes.sparkSession.sparkContext
    population = classes.count()
    # a hash threshold picks the sample; it is fitted on, never searched in
    share = min(1.0, forest.sample / population)
    sampled = classes.where(F.col("rank") < F.lit(int(-(2**31) + share * 2**32))) if share < 1 else classes
    x = np.array([r[0] for r in sampled.select("_v").orderBy("_v").collect()], np.float64).reshape(-1, dim)
    x /= np.abs(x).max(1, keepdims=True, initial=1e-300)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    trees = context.broadcast([fit_tree(x, population, forest, forest.seed + t) for t in range(forest.trees)])
    margin = forest.spill * np.sqrt(max(0.0, 2 - 2 * threshold) / dim)

    def routed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            v = np.array(frame["_v"].tolist(), np.float64)
            unit = v / np.abs(v).max(1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            idx, leaf = [], []
            for t, tree in enumerate(trees.value):
                i, at = route(unit, tree, margin, forest.seed + t)
                idx.append(i)
                leaf.append(at | t << 54)
            idx, leaf = np.concatenate(idx), np.concatenate(leaf)
            order = np.lexsort((leaf, idx))
            idx, leaf = idx[order], leaf[order]
            starts = np.searchsorted(idx, np.arange(len(frame) + 1))
            own = [leaf[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
            raw = [r.tobytes() for r in v]
            node, copies = frame["node"].to_numpy(), frame["copies"].to_numpy()
            yield pd.DataFrame({
                "leaf": leaf, "node": node[idx], "copies": copies[idx],
                "leaves": [own[i] for i in idx], "raw": [raw[i] for i in idx],
            })

    dealt = classes.select("node", "copies", "_v").mapInPandas(
        routed, "leaf long, node long, copies long, leaves binary, raw binary"
    )
    sizes = written(
        classes.select("node", "copies", "_v").mapInPandas(
            lambda fs: (f[["leaf"]] for f in routed(fs)), "leaf long"
        ).groupBy("leaf").count().where(F.col("count") > forest.block)
        .select("leaf", F.ceil(F.col("count") / forest.block).cast("int").alias("blocks")),
        "sizes",
    )
    mine = F.pmod("node", F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(mine, other).alias("i"), F.greatest(mine, other).alias("j"), mine.alias("own")),
    )
    zero = F.lit(0)
    one = F.array(F.struct(zero.alias("i"), zero.alias("j"), zero.alias("own")))
    dealt = (
        dealt.join(sizes, "leaf", "left")
        .withColumn("p", F.explode(F.when(F.col("blocks").isNull(), one).otherwise(pairs)))
        .select("leaf", F.col("p.i").alias("i"), F.col("p.j").alias("j"), F.col("p.own").alias("own"), "node", "copies", "leaves", "raw")
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        leaf, i, j = (int(frame[c].iat[0]) for c in ("leaf", "i", "j"))
        v = np.frombuffer(b"".join(frame["raw"]), np.float64).reshape(-1, dim)
        v = v / np.abs(v).max(1, keepdims=True)
        norm = np.sqrt((v * v).sum(1))
        node, copies, own = (frame[c].to_numpy() for c in ("node", "copies", "own"))
        lists = [np.frombuffer(b, np.int64) for b in frame["leaves"]]
        leaves = np.full((len(v), max(map(len, lists))), -1, np.int64)
        for r, one_list in enumerate(lists):
            leaves[r, : len(one_list)] = one_list
        links, label = np.zeros(len(v), np.int64), np.arange(len(v))
        us, vs = [], []
        for at in range(0, len(v), 256):
            cosine = (v[at : at + 256] @ v.T) / (norm[at : at + 256, None] * norm[None, :])
            near = cosine >= threshold
            if i != j:  # pairs within a block belong to that block's own group
                near &= own[at : at + 256, None] != own[None, :]
            a, b = np.nonzero(near)
            a += at
            a, b = a[a < b], b[a < b]
            for k in range(0, len(a), 20_000):
                p, q = a[k : k + 20_000], b[k : k + 20_000]
                first = _first_shared(leaves[p], leaves[q], 1 << 62) == leaf
                p, q = p[first], q[first]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                us.append(p)
                vs.append(q)
        u, w = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (us, vs))
        while len(u):  # smallest row of each component, so that edges are no more than rows
            new = label.copy()
            np.minimum.at(new, u, label[w])
            np.minimum.at(new, w, label[u])
            new = new[new]
            if (new == label).all():
                break
            label = new
        keep = (links > 0) | (label != np.arange(len(v)))
        return pd.DataFrame({"node": node[keep], "links": links[keep], "least": node[label[keep]]})

    out = written(
        dealt.groupBy("leaf", "i", "j").applyInPandas(compare, "node long, links long, least long"), "links"
    )
    return out.select("node", "links"), out.select(F.col("node").alias("u"), F.col("least").alias("v"))
