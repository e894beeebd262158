"""Spectral clustering of any number of points: nearest-neighbour graph, multilevel embedding, k-means.

1. Equal points are one node. Random trees part the nodes by coordinates into groups of bounded size; the
   nearest neighbours within small blocks of every group are exact, and the best of all trees count.
2. The graph is coarsened level by level: by a coin of their hash nodes are heads or tails, and every tail joins
   the head that it has most weight with. Weights add up, so a coarse graph cuts like the fine one.
3. The coarsest graph, of ``COARSE`` nodes at most, gives the leading eigenvectors of its random walk. They are
   handed down the levels, and at each level smoothed by steps of its own walk: joins along the edges.
4. K-means groups the nodes by their embedding.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.session import stage

# functions of this module travel to the Python workers by value, so they need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NEIGHBOURS = 10
TREES = 6
#: Nodes of a group, about; nodes of a block, at most; values of the sample that trees are grown on, at most.
GROUP_NODES, BLOCK_NODES, SAMPLE_VALUES = 4_000, 256, 1_000_000
COARSE = 400
SMOOTHING = 2
SEED = 42


def embedding(points: DataFrame, k: int) -> tuple[DataFrame, list[str]]:
    """``z`` and one column per eigenvector, one row per different ``z`` (``array<double>``) of ``points``.

    Points that agree have one row. With ``k`` different points or fewer each has a vector of its own.
    """
    nodes = points.select("z").distinct().withColumn("node", F.monotonically_increasing_id())
    nodes = stage(nodes, "spectral-nodes")
    count = nodes.count()
    columns = [f"e{i}" for i in range(k)]
    if count <= k:  # one row per cluster
        place = F.row_number().over(W.orderBy("node")) - 1
        return nodes.select("z", *[(place == i).cast("double").alias(c) for i, c in enumerate(columns)]), columns
    levels, maps = [nearest_graph(nodes, count)], []
    while count > COARSE:
        edges, parents, count = _coarser(levels[-1], len(levels), count)
        levels.append(edges)
        maps.append(parents)
    found = _leading(levels[-1], k, columns)
    for edges, parents in zip(reversed(levels[:-1]), reversed(maps), strict=True):
        found = parents.join(found.withColumnRenamed("node", "parent"), "parent").drop("parent")
        for _ in range(SMOOTHING):
            found = _walked(edges, found, columns)
        found = stage(found, "spectral-level")
    return nodes.join(found, "node").select("z", *columns), columns


def nearest_graph(nodes: DataFrame, count: int, neighbours: int = NEIGHBOURS) -> DataFrame:
    """A written table ``a, b, w`` in both directions: half a unit for every node that has the other among its nearest."""
    def nearest(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        ids, x = frame["node"].to_numpy(), np.stack(frame["z"].to_numpy())
        rng = np.random.default_rng([SEED, int(key[0]), int(key[1])])
        out = []
        for block in small_blocks(x, rng):
            y = x[block]
            gaps = squared_gaps(y)
            np.fill_diagonal(gaps, np.inf)
            near = np.argsort(gaps, axis=1, kind="stable")[:, : min(neighbours, len(block) - 1)]
            a = np.repeat(np.arange(len(block)), near.shape[1])
            out.append(pd.DataFrame({"a": ids[block[a]], "b": ids[block[near.ravel()]], "gap": gaps[a, near.ravel()]}))
        return pd.concat(out)

    found = in_groups(nodes, count).groupBy("tree", "part").applyInPandas(nearest, "a long, b long, gap double")
    found = found.groupBy("a", "b").agg(F.min("gap").alias("gap"))
    best = F.row_number().over(W.partitionBy("a").orderBy("gap", "b"))  # TREES * neighbours rows at most
    found = found.withColumn("place", best).where(F.col("place") <= neighbours).select("a", "b", F.lit(0.5).alias("w"))
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))
    return stage(both.groupBy("a", "b").agg(F.sum("w").alias("w")), "spectral-graph")


def in_groups(nodes: DataFrame, count: int) -> DataFrame:
    """``nodes`` (with ``z``) once per tree, with ``tree, part``: groups of about ``GROUP_NODES`` near ones."""
    trees = _trees(nodes, count)

    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            x = np.stack(frame["z"].to_numpy())
            for t, (dims, cuts) in enumerate(trees):
                place = np.zeros(len(x), np.int64)
                while dims and place[0] < len(dims):  # all leaves lie at one depth
                    place = 2 * place + 1 + (x[np.arange(len(x)), np.array(dims)[place]] > np.array(cuts)[place])
                yield frame.assign(tree=np.int32(t), part=place)

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInPandas(part, f"{columns}, tree int, part long")


def small_blocks(x: np.ndarray, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Row numbers of ``x`` in blocks of ``BLOCK_NODES`` at most, cut along wide coordinates."""
    waiting = [np.arange(len(x))]
    while waiting:
        block = waiting.pop()
        if len(block) <= BLOCK_NODES:
            yield block
            continue
        widest = np.argsort(-x[block].std(axis=0), kind="stable")[:3]
        order = block[np.argsort(x[block, rng.choice(widest)], kind="stable")]
        at = int(len(order) * rng.uniform(0.4, 0.6))
        waiting += [order[:at], order[at:]]


def squared_gaps(y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a small block."""
    if y.size < 20_000:
        return ((y[:, None, :] - y[None, :, :]) ** 2).sum(axis=2)
    square = (y**2).sum(axis=1)
    return np.maximum(square[:, None] + square[None, :] - 2 * y @ y.T, 0.0)


def _trees(nodes: DataFrame, count: int) -> list[tuple[list[int], list[float]]]:
    """Per tree the coordinate and the cut of every inner node in heap order, from a bounded sample."""
    depth = int(np.ceil(np.log2(max(1, count / GROUP_NODES))))
    if not depth:
        return [([], [])] * TREES
    width = len(nodes.first()["z"])
    share = min(1.0, SAMPLE_VALUES / max(width, 1) / count)
    chosen = F.pmod(F.xxhash64("z"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = np.stack(nodes.where(chosen).orderBy("node").toPandas()["z"].to_numpy())
    out = []
    for t in range(TREES):
        rng = np.random.default_rng([SEED, t])
        dims, cuts, level = [], [], [np.arange(len(sample))]
        for _ in range(depth):
            after = []
            for rows in level:
                if len(rows) < 2:  # too few to cut by: all go one way
                    dims.append(0)
                    cuts.append(np.inf)
                    after += [rows, rows[:0]]
                    continue
                dim = int(rng.choice(np.argsort(-sample[rows].std(axis=0), kind="stable")[:3]))
                cut = float(np.quantile(sample[rows, dim], rng.uniform(0.4, 0.6)))
                dims.append(dim)
                cuts.append(cut)
                right = sample[rows, dim] > cut
                after += [rows[~right], rows[right]]
            level = after
        out.append((dims, cuts))
    return out


def _coarser(edges: DataFrame, level: int, count: int) -> tuple[DataFrame, DataFrame, int]:
    """The next graph, the map ``node, parent`` to it, and its number of nodes."""
    head = lambda c: F.xxhash64(c, F.lit(level)).bitwiseAND(1) == 0
    ties = F.xxhash64("a", "b")
    joined = edges.where((F.col("a") != F.col("b")) & ~head("a") & head("b"))
    joined = joined.groupBy("a").agg(F.max(F.struct("w", ties, "b"))["b"].alias("to"))
    parents = edges.select("a").distinct().join(joined, "a", "left")
    parents = stage(parents.select(F.col("a").alias("node"), F.coalesce("to", "a").alias("parent")), "spectral-parents")
    left = parents.select("parent").distinct().count()
    if left > 0.95 * count:
        # Nearly all components are single nodes by now: without an edge between them, chance may group them.
        alone = F.pmod(F.xxhash64("parent"), F.lit(COARSE // 2))
        single = edges.groupBy("a").agg(F.max(F.col("a") != F.col("b")).alias("linked")).where("NOT linked")
        single = single.select(F.col("a").alias("parent")).join(parents, "parent").select("node", "parent", alone.alias("alone"))
        single = single.groupBy("alone").agg(F.min("parent").alias("low")).join(single, "alone").select("node", "low")
        parents = parents.join(single, "node", "left").select("node", F.coalesce("low", "parent").alias("parent"))
        parents = stage(parents, "spectral-parents")
        left = parents.select("parent").distinct().count()
    ends = edges.join(parents.toDF("a", "pa"), "a").join(parents.toDF("b", "pb"), "b")
    coarse = ends.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.sum("w").alias("w"))
    return stage(coarse, "spectral-graph"), parents, left


def _leading(edges: DataFrame, k: int, columns: list[str]) -> DataFrame:
    """``node`` and the ``k`` leading eigenvectors of the walk on a graph of ``COARSE`` nodes at most."""
    table = edges.toPandas().sort_values(["a", "b"])
    ids = np.unique(table["a"])
    graph = np.zeros((len(ids), len(ids)))
    graph[np.searchsorted(ids, table["a"]), np.searchsorted(ids, table["b"])] = table["w"]
    degree = np.sqrt(graph.sum(axis=1))
    _, vectors = np.linalg.eigh(graph / degree[:, None] / degree[None, :])
    vectors = vectors[:, ::-1][:, :k] / degree[:, None]
    rows = [(int(i), *map(float, v)) for i, v in zip(ids, vectors, strict=True)]
    return edges.sparkSession.createDataFrame(rows, "node long, " + ", ".join(f"{c} double" for c in columns))


def _walked(edges: DataFrame, found: DataFrame, columns: list[str]) -> DataFrame:
    """Half a step of the walk: every node moves half-way to the weighted mean of its neighbours."""
    ahead = edges.join(found.withColumnRenamed("node", "b"), "b").groupBy("a")
    means = ahead.agg(*[(F.sum(F.col("w") * F.col(c)) / F.sum("w")).alias(f"m_{c}") for c in columns])
    moved = found.join(means.withColumnRenamed("a", "node"), "node")
    return moved.select("node", *[((F.col(c) + F.col(f"m_{c}")) / 2).alias(c) for c in columns])
