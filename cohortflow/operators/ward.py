"""Ward's clustering of any number of points by rounds of mutual nearest neighbours.

Merging two groups that are each other's nearest belongs to Ward's tree whatever else is merged before, as
merged groups never come nearer to others. So a round merges all such pairs at once, by joins. It leaves
out the dearest: enough groups then have no neighbour below the round's limit that every merge of a round
lies below the cut into ``k`` groups, and the order of merging has no say. What is left at the end,
``LAST`` groups at most, is merged one pair at a time, with the same tree.

The nearest group of each is looked for in its own leaf of a tree of cuts, and then in every other leaf whose
box may hold a nearer one. So no neighbour is missed, whatever the cuts: they decide on the time alone.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.operators import spectral
from cohortflow.session import stage

# functions of this module travel to the Python workers by value, so they need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Groups that are merged one pair at a time, at most (and at least four times the clusters), and their values.
LAST, LAST_VALUES = 4_000, 64_000_000
#: Share of the groups that a round looks at, at most; rows of the sample per leaf; values of a step of the search.
NEARER, LEAF_SAMPLE, STEP_VALUES = 0.75, 64, 4_000_000


def labels(points: DataFrame, k: int) -> DataFrame:
    """``z, cluster`` per different ``z`` (``array<double>``) of ``points``; equal points weigh together."""
    nodes = points.groupBy("z").agg(F.count(F.lit(1)).cast("double").alias("n"))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "ward-nodes")
    groups, count, maps = nodes, nodes.count(), []
    row = nodes.first()
    last_count = max(min(LAST, LAST_VALUES // max(len(row["z"]), 1)) if row else LAST, 4 * k)
    unknown = F.exists("z", F.isnan)
    if count > last_count and (first := nodes.where(unknown).agg(F.min("node")).first()[0]) is not None:
        return nodes.join(_in_order(nodes, first, k), "node").select("z", "cluster")
    while count > last_count:
        merged = _mutual(groups, count, k)
        members = groups.join(merged, groups["node"] == merged["b"], "left")
        members = stage(members.select("node", F.coalesce("a", "node").alias("parent"), "z", "n"), "ward-parents")
        maps.append(members.select("node", "parent"))
        groups = stage(_merge(members), "ward-groups")
        left = groups.count()
        if left == count:  # the cheapest of all pairs is always mutual
            raise ValueError("Ward's clustering needs finite values")
        count = left

    def last(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        found = greedy(np.stack(rows["z"].to_numpy()), rows["n"].to_numpy(), min(k, len(rows)))
        return pd.DataFrame({"node": rows["node"], "cluster": found.astype(np.int32)})

    # LAST groups at most, in one task
    found = groups.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(last, "node long, cluster int")
    found = stage(found, "ward-clusters")
    for parents in reversed(maps):
        found = parents.join(found.withColumnRenamed("node", "parent"), "parent").select("node", "cluster")
    return nodes.join(found, "node").select("z", "cluster")


def _in_order(nodes: DataFrame, unknown: int, k: int) -> DataFrame:
    """``node, cluster`` as ``greedy`` has them where a value is NaN: all but the last go to the first group.

    Costs are NaN then, which come before all others: the first node merges with ``unknown``, the first of those
    without a distance, and then with one after the other by id until ``k`` groups remain.
    """
    kept = nodes.agg(F.min("node")).first()[0], unknown
    alone = nodes.where(~F.col("node").isin(*kept)).orderBy(F.desc("node")).limit(k - 1).select("node").collect()
    cluster = F.lit(0)
    if alone:
        places = F.array(*[F.lit(i) for i in sorted(r["node"] for r in alone)])
        cluster = F.array_position(places, F.col("node")).cast("int")  # 0 where it is none of them
    return nodes.select("node", cluster.alias("cluster"))


def _mutual(groups: DataFrame, count: int, k: int) -> DataFrame:
    """A written table ``a, b``: groups that are each other's nearest, up to the limit of the round."""

    def in_leaf(rows: pd.DataFrame) -> pd.DataFrame:
        x, n, ids = _arrays(rows)
        cost, near = np.full(len(x), np.inf), np.full(len(x), -1)
        blocks = _blocks(x, n, ids)
        for block in blocks:
            _look(x, n, ids, cost, near, block, block[0])
        for block in blocks:
            _look(x, n, ids, cost, near, block)
        box = [None] * len(x)
        box[0] = np.concatenate([x.min(axis=0), x.max(axis=0), [n.min()]])
        return rows.assign(b=near, cost=cost, box=box)

    columns = "node long, z array<double>, n double, leaf long, b long, cost double, box array<double>"
    placed = groups.select("node", "z", "n", _leaf(groups, count).alias("leaf")).groupBy("leaf")
    own = stage(placed.applyInPandas(in_leaf, columns), "ward-leaves")
    # Three times k groups at least lie beyond the limit, so k remain even where equal costs at it merge in pairs.
    share = min(NEARER, 1 - 3 * k / count)
    # What costs more than the cap is not merged in this round: the nearest of all are no dearer than those found so far.
    boxes = F.collect_list(F.when(F.col("box").isNotNull(), F.struct("leaf", "box")))  # one per leaf
    cap, boxes = own.agg(F.percentile_approx("cost", share, 1_000), boxes).first()
    best = own.select(F.col("node").alias("a"), "b", "cost")
    if len(boxes) > 1:
        best = best.unionByName(_from_other_leaves(own, boxes, cap))
    # One order of all pairs, so that the first of them is mutual even among equal costs.
    ends = F.struct("cost", F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    best = stage(best.groupBy("a").agg(F.min(ends).alias("e")), "ward-nearest")
    # At most a thousandth beside the share, and never below the cheapest pair.
    limit, least = best.agg(F.percentile_approx("e.cost", share, 1_000), F.min("e.cost")).first()
    pairs = best.where(F.col("e.cost") <= max(min(limit, cap), least)).groupBy("e.low", "e.high").count()
    return stage(pairs.where("count = 2").select(F.col("low").alias("a"), F.col("high").alias("b")), "ward-pairs")


def _from_other_leaves(own: DataFrame, boxes: list, cap: float) -> DataFrame:
    """``a, b, cost``: nearest groups of other leaves, where they are as near as the own leaf's and as ``cap``."""
    homes = np.array([r["leaf"] for r in boxes])
    facts = np.array([r["box"] for r in boxes])
    width = facts.shape[1] // 2
    low, high, light = facts[:, :width], facts[:, width:-1], facts[:, -1]

    @F.pandas_udf("array<long>")
    def reached(leaf: pd.Series, z: pd.Series, n: pd.Series, cost: pd.Series) -> pd.Series:
        out = [[] for _ in range(len(z))]
        for home, rows in leaf.groupby(leaf.to_numpy()).indices.items():
            x, w, most = np.stack(z.to_numpy()[rows]), n.to_numpy()[rows], cost.to_numpy()[rows]
            # all these rows against a leaf, then each of them
            gap = np.maximum(np.maximum(low - x.max(axis=0), x.min(axis=0) - high), 0.0)
            for at in np.flatnonzero((1 - 1e-9) * _union(gap, w.min(), light) <= most.max()):
                if homes[at] != home:
                    for r in rows[_least(x, w, low[at], high[at], light[at]) <= most]:
                        out[r].append(homes[at])
        return pd.Series(out)

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, parts, blocks = None, [], []
        for frame in frames:
            for leaf, rows in frame.groupby("leaf"):
                if leaf != here:
                    here, parts, blocks = leaf, [], []
                guest = rows["guest"].to_numpy()
                if not guest.all():
                    parts.append(rows[~guest])
                if guest.any():  # all that live here came before
                    blocks = blocks or _blocks(*_arrays(pd.concat(parts)))
                    x, n, ids = _arrays(rows[guest])
                    cost, near = rows["cost"].to_numpy()[guest].copy(), np.full(len(x), -1)
                    for block in blocks:
                        _look(x, n, ids, cost, near, block)
                    yield pd.DataFrame({"a": ids, "b": near, "cost": cost})[near >= 0]

    most = F.least("cost", F.lit(cap))
    guests = own.withColumn("to", reached("leaf", "z", "n", most)).select(
        "node", "z", "n", F.explode("to").alias("leaf"), most.alias("cost"), F.lit(True).alias("guest"))
    both = guests.unionByName(own.select("node", "z", "n", "leaf", "cost", F.lit(False).alias("guest")))
    # a task holds one leaf at a time, and its guests pass by
    parted = both.repartition("leaf").sortWithinPartitions("leaf", "guest")
    return parted.mapInPandas(meet, "a long, b long, cost double")


def _leaf(groups: DataFrame, count: int) -> Column:
    """The leaf of ``z`` in a tree of cuts, for leaves of about ``GROUP_NODES`` groups each."""
    depth = int(np.ceil(np.log2(max(1, count / spectral.GROUP_NODES))))
    if not depth:
        return F.lit(0).cast("long")
    share = min(1.0, 2**depth * LEAF_SAMPLE / count)
    chosen = F.pmod(F.xxhash64("z"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = [np.array(r["z"]) for r in groups.where(chosen).select("z").collect()]
    dims, cuts, level = [], [], [np.array(sample)]
    for _ in range(depth):
        after = []
        for x in level:
            dim, cut = _cut(x) if len(x) > 1 else (0, np.inf)  # too few to cut by: all go one way
            dims.append(dim)
            cuts.append(cut)
            right = x[:, dim] > cut if len(x) else []
            after += [x[~right], x[right]] if len(x) else [x, x]
        level = after
    heap_dims, heap_cuts = np.array(dims), np.array(cuts)

    @F.pandas_udf("long")
    def leaf(z: pd.Series) -> pd.Series:
        place = np.zeros(len(z), np.int64)
        if len(z):
            x = np.stack(z.to_numpy())
            for _ in range(depth):  # all leaves lie at one depth
                place = 2 * place + 1 + (x[np.arange(len(x)), heap_dims[place]] > heap_cuts[place])
        return pd.Series(place)

    return leaf("z")


def _cut(x: np.ndarray) -> tuple[int, float]:
    """The widest coordinate whose middle parts the rows about evenly, else the one that does best; and the cut."""
    found = (0.0, 0, np.inf)
    for dim in np.argsort(-x.std(axis=0), kind="stable"):
        values = np.sort(x[:, dim])
        middle = values[(len(values) - 1) // 2]
        below = values[values < middle]  # where many values are equal
        for cut in (middle, *below[-1:]):
            share = float((values > cut).mean())
            found = max(found, (min(share, 1 - share), -int(dim), float(cut)))
        if found[0] >= 0.4:
            break
    return -found[1], found[2]


def _arrays(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.stack(rows["z"].to_numpy()), rows["n"].to_numpy(), rows["node"].to_numpy()


def _blocks(x: np.ndarray, n: np.ndarray, ids: np.ndarray) -> list[tuple]:
    """Blocks of near rows: their numbers, centres, weights and ids, the corners of their box, the least weight."""
    out = []
    for rows in spectral.small_blocks(x, np.random.default_rng(spectral.SEED)):
        y = x[rows]
        out.append((rows, y, n[rows], ids[rows], y.min(axis=0), y.max(axis=0), n[rows].min()))
    return out


def _union(gaps: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What the unions of groups cost that lie ``gaps`` apart; ``n`` and ``m`` are their weights."""
    return n * m / (n + m) * (gaps**2).sum(axis=1)


def _least(x: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray, light: float) -> np.ndarray:
    """What a union with a group in a box costs at least, if ``light`` is the least weight there; rounded down."""
    return (1 - 1e-9) * _union(np.maximum(np.maximum(low - x, x - high), 0.0), n, light)


def _look(
    x: np.ndarray,
    n: np.ndarray,
    ids: np.ndarray,
    cost: np.ndarray,
    near: np.ndarray,
    block: tuple,
    rows: np.ndarray | None = None,
) -> None:
    """Put the nearest groups of ``block`` into ``near`` and ``cost`` where they are nearer; of equal ones the lowest id."""
    _, y, m, others, low, high, light = block
    if rows is None:
        rows = np.flatnonzero(_least(x, n, low, high, light) <= cost)
    middle, step = y.mean(axis=0), max(1, STEP_VALUES // y.size)
    q = y - middle
    qq = (q**2).sum(axis=1)
    for at in range(0, len(rows), step):
        some = rows[at : at + step]
        p, w = x[some] - middle, n[some]
        pp = (p**2).sum(axis=1)
        rough = (pp[:, None] + qq - 2 * p @ q.T) * (w[:, None] * m / (w[:, None] + m))
        rough[ids[some][:, None] == others] = np.inf
        # products are rounded: every pair that may be the cheapest is worked out from its differences
        error = 1e-15 * (x.shape[1] + 8) * (pp + qq.max()) * w * m.max() / (w + m.max())
        most = np.minimum(rough.min(axis=1) + 2 * error, cost[some] + error)
        i, j = np.nonzero(rough <= most[:, None])
        apart = ids[some[i]] != others[j]
        i, j = some[i[apart]], j[apart]
        exact = _union(x[i] - y[j], n[i], m[j])
        order = np.lexsort((others[j], exact, i))
        i, j, exact = i[order], j[order], exact[order]
        first = np.flatnonzero(np.diff(i, prepend=-1))
        i, j, exact = i[first], j[first], exact[first]
        closer = (exact < cost[i]) | ((exact == cost[i]) & ((near[i] < 0) | (others[j] < near[i])))
        i, j, exact = i[closer], j[closer], exact[closer]
        near[i], cost[i] = others[j], exact


def _merge(members: DataFrame) -> DataFrame:
    """Every group once, merged pairs as the one with the lower id: weights added, centres weighted."""
    left = members.where("node = parent").select("node", "z", "n")
    right = members.where("node <> parent").select(F.col("parent").alias("node"), F.col("z").alias("z_b"), F.col("n").alias("n_b"))
    kept = left.join(right, "node", "left")
    total = F.col("n") + F.col("n_b")

    def centre(x: Column, y: Column) -> Column:
        return (x * F.col("n") + y * F.col("n_b")) / total

    z = F.when(F.col("n_b").isNull(), F.col("z")).otherwise(F.zip_with("z", "z_b", centre))
    return kept.select("node", z.alias("z"), F.coalesce(total, "n").alias("n"))


def greedy(centres: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Merge the two groups whose union raises the within-group variance least, until k remain."""
    centres, weights = centres.copy(), weights.astype(float)
    label = np.arange(len(centres))

    def costs(i: int) -> np.ndarray:
        gap = ((centres - centres[i]) ** 2).sum(axis=1)
        return np.where(weights > 0, weights * weights[i] / np.maximum(weights + weights[i], 1e-300) * gap, np.inf)

    cost = np.empty((len(centres), len(centres)))
    for i in range(len(centres)):
        cost[i] = costs(i)
    np.fill_diagonal(cost, np.inf)
    near = cost.argmin(axis=1)  # per row the first of its nearest
    least = cost[np.arange(len(cost)), near]
    for _ in range(len(centres) - k):
        first = int(np.argmin(least))
        a, b = sorted((first, int(near[first])))
        total = weights[a] + weights[b]
        centres[a] = (centres[a] * weights[a] + centres[b] * weights[b]) / total
        weights[a], weights[b] = total, 0.0
        label[label == b] = a
        cost[b, :] = cost[:, b] = np.inf
        cost[a, :] = costs(a)
        cost[a, a] = cost[a, b] = np.inf
        cost[:, a] = cost[a, :]
        lost = ((near == a) | (near == b)) & (weights > 0)
        lost[a] = True
        closer = ~lost & ((cost[a] < least) | ((cost[a] == least) & (a < near)))
        near[closer], least[closer] = a, cost[a, closer]
        again = np.flatnonzero(lost)
        near[again] = cost[again].argmin(axis=1)
        least[again] = cost[again, near[again]]
        least[b] = np.inf
    return np.unique(label, return_inverse=True)[1]
