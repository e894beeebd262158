"""Outlier removal: quartile fences, z-scores, isolation forest."""

from __future__ import annotations

import math
import sys
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.functions.exprs import clean_double
from cohortflow.operators.ranking import DIRECT_ROWS, exact_quantiles
from cohortflow.operators.relational import resolve_numeric
from cohortflow.session import stage

# functions of this module travel to the Python workers by value, so they need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES = 100
SAMPLE = 256
SEED = 42


def remove_outliers(
    df: DataFrame,
    method: str = "iqr",
    columns: str | list[str] | None = None,
    threshold: float | str | None = None,
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """Keep the rows that are inside for every checked column.

    ``iqr``: Q1 - m*IQR .. Q3 + m*IQR, m = ``threshold`` or 1.5. ``zscore``: |z| <= ``threshold`` or
    3, sample std. ``isolation_forest``: drop the share ``threshold`` (or 0.05) with the highest
    anomaly score.
    """
    names = resolve_numeric(df, columns)
    given = None if threshold is None or not str(threshold).strip() else float(threshold)
    if method == "iqr":
        return df.filter(_inside_fences(df, names, 1.5 if given is None else given, direct_rows))
    if method == "zscore":
        return df.filter(_inside_zscore(df, names, 3.0 if given is None else given))
    if method == "isolation_forest":
        share = 0.05 if given is None else given
        if not 0.0 < share < 0.5:
            raise ValueError(f"The share to drop must lie between 0 and 0.5, got {share}")
        return _by_forest(df, names, share, direct_rows)
    raise ValueError(f"Unknown method: {method!r}")


def removal_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows_before, rows_after, rows_removed, percent_removed (0 for an empty input)."""
    counted = before.agg(F.count(F.lit(1)).alias("rows_before")).withColumn(
        "rows_after", after.agg(F.count(F.lit(1)).alias("n")).scalar()
    )
    removed = F.col("rows_before") - F.col("rows_after")
    percent = F.coalesce(F.try_divide(removed * 100.0, F.col("rows_before")), F.lit(0.0))
    return counted.select("*", removed.alias("rows_removed"), percent.alias("percent_removed"))


def _all_of(tests: list[Column]) -> Column:
    return F.coalesce(reduce(lambda a, b: a & b, tests, F.lit(True)), F.lit(False))


def _inside_fences(df: DataFrame, names: list[str], reach: float, direct_rows: int) -> Column:
    quartiles = exact_quantiles(df, names, [0.25, 0.75], direct_rows)
    tests = []
    for name in names:
        low, high = quartiles[name]
        if low is None:
            tests.append(F.lit(False))
        else:
            gap = high - low
            tests.append(
                clean_double(df, name).between(F.lit(low - reach * gap), F.lit(high + reach * gap))
            )
    return _all_of(tests)


def _inside_zscore(df: DataFrame, names: list[str], limit: float) -> Column:
    values = {c: clean_double(df, c) for c in names}
    fitted = df.agg(
        *[F.avg(values[c]).alias(f"m{i}") for i, c in enumerate(names)],
        *[F.stddev_samp(values[c]).alias(f"s{i}") for i, c in enumerate(names)],
    ).first()
    tests = []
    for i, name in enumerate(names):
        mean, std = fitted[f"m{i}"], fitted[f"s{i}"]
        if std is None:
            tests.append(F.lit(False))
        elif std != 0:
            tests.append(F.abs((values[name] - F.lit(mean)) / F.lit(std)) <= F.lit(limit))
    return _all_of(tests)


# Isolation forest after Liu, Ting and Zhou (2008): random splits isolate unusual rows early.


def _by_forest(df: DataFrame, names: list[str], share: float, direct_rows: int) -> DataFrame:
    numbers = df.select(*[clean_double(df, c).alias(f"c{i}") for i, c in enumerate(names)])
    holes = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in numbers.columns])
    facts = numbers.agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(holes, 1)).alias("holes")
    ).first()
    if facts["holes"]:
        raise ValueError(f"The isolation forest takes no gaps: {facts['holes']} row(s) lack a checked value")
    if facts["rows"] == 0:
        return df
    score = _scorer(_grow_forest(numbers, facts["rows"]), min(SAMPLE, facts["rows"]))
    # scores are read several times and are far dearer than a write
    scored = stage(df.withColumn("_score", score(*[clean_double(df, c) for c in names])), "scores")
    cut = exact_quantiles(scored.select("_score"), ["_score"], [1.0 - share], direct_rows)["_score"][0]
    return scored.filter(F.col("_score") <= F.lit(cut)).drop("_score")


def _grow_forest(numbers: DataFrame, rows: int) -> pd.DataFrame:
    """Grow every tree in a task of its own, from SAMPLE rows that hashes of the values choose.

    Equal rows are counted first. One hash per different row thins the table to a pool of about
    4 * SAMPLE * TREES copies. Hashes then name the trees that a copy of the pool is dealt to, so that about
    4 * SAMPLE of them reach a tree, and the SAMPLE of those with the lowest hashes are taken. So each
    tree draws from the whole table, and the draw depends on the values alone, not on partitions or
    their order. The nodes returned are at most 2 * SAMPLE - 1 per tree.
    """
    names = numbers.columns
    pool = min(rows, 4 * SAMPLE * TREES)
    counted = numbers.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))

    def draw(*parts: Column) -> Column:
        return (F.pmod(F.xxhash64(F.lit(SEED), *parts, *[F.col(c) for c in names]), F.lit(1 << 52)) + 0.5) / float(1 << 52)

    # expected copies, rounded up or down by the hash: a value that fills the table is not drawn whole
    pooled = counted.withColumn("_n", F.floor(F.col("_n") * (pool / rows) + draw(F.lit(-1)))).filter(F.col("_n") > 0)
    drawn = pooled.select(*names, F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_copy"))
    # a start and a step without a common divisor with TREES: the trees of a copy are all different
    steps = F.array(*[F.lit(k) for k in range(1, TREES) if math.gcd(k, TREES) == 1])
    trees = F.floor(TREES * min(1.0, 4 * SAMPLE / pool) + draw(F.lit(-2), F.col("_copy"))).cast("int")
    first, step = (F.pmod(F.xxhash64(F.lit(SEED), F.lit(k), "_copy", *names), n) for k, n in ((-3, F.lit(TREES)), (-4, F.size(steps))))
    dealt = drawn.withColumns({"_trees": trees, "_first": first, "_step": F.get(steps, step.cast("int"))}).filter("_trees > 0")
    dealt = dealt.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_trees"))))
    drawn = dealt.withColumn("tree", F.pmod(F.col("_first") + F.col("_i") * F.col("_step"), F.lit(TREES)).cast("int"))
    order = W.partitionBy("tree").orderBy(draw(F.col("tree"), F.col("_copy")), *names)
    chosen = drawn.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= SAMPLE)

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_rank")
        return _grow_tree(rows[names].to_numpy(dtype=float), int(rows["tree"].iloc[0]))

    nodes = chosen.groupBy("tree").applyInPandas(
        grow, "tree int, node int, feature int, split double, child int, depth double"
    )
    return nodes.toPandas().sort_values(["tree", "node"])


def _grow_tree(sample: np.ndarray, tree: int) -> pd.DataFrame:
    rng = np.random.default_rng([SEED, tree])
    size = len(sample)
    height = math.ceil(math.log2(max(size, 2)))
    nodes: list[list] = [[tree, 0, -1, 0.0, -1, 0.0]]
    todo = [(0, sample, 0)]
    while todo:
        node, rows, depth = todo.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= height or len(rows) <= 1 or len(varying) == 0:
            nodes[node][5] = depth + _expected_depth(len(rows))
            continue
        feature = int(rng.choice(varying))
        split = float(rng.uniform(low[feature], high[feature]))
        left = rows[:, feature] <= split
        child = len(nodes)
        nodes[node][2:5] = [feature, split, child]
        nodes += [[tree, child, -1, 0.0, -1, 0.0], [tree, child + 1, -1, 0.0, -1, 0.0]]
        todo += [(child, rows[left], depth + 1), (child + 1, rows[~left], depth + 1)]
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "split", "child", "depth"])


def _expected_depth(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _scorer(nodes: pd.DataFrame, size: int):
    """A vectorised score; each tree is laid out as a full binary tree (children of i: 2i+1, 2i+2)."""
    height = math.ceil(math.log2(max(size, 2)))
    trees = [_full_tree(tree, height) for _, tree in nodes.groupby("tree")]
    norm = max(_expected_depth(size), 1e-12)

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        values, start = x.ravel(), np.arange(len(x)) * x.shape[1]
        total = np.zeros(len(x))
        for feature, split, depth in trees:
            at = np.zeros(len(x), dtype=np.intp)
            for _ in range(height):
                at = 2 * at + 1 + (values[start + feature[at]] > split[at])
            total += depth[at]
        return pd.Series(np.exp2(-total / (len(trees) * norm)))

    # not deterministic in Spark's terms: keeps the score filter from moving below a repartition
    return score.asNondeterministic()


def _full_tree(nodes: pd.DataFrame, height: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, split and depth per position; below a leaf every row goes left and keeps its depth."""
    size = 2 ** (height + 1) - 1
    feature, split = np.zeros(size, dtype=np.intp), np.full(size, np.inf)
    depth = np.zeros(size)
    given = nodes[["feature", "split", "child", "depth"]].to_numpy()
    todo = [(0, 0)]
    while todo:
        node, place = todo.pop()
        f, s, child, d = given[node]
        if child >= 0:
            feature[place], split[place] = int(f), s
            todo += [(int(child), 2 * place + 1), (int(child) + 1, 2 * place + 2)]
            continue
        while place < size:
            depth[place] = d
            place = 2 * place + 1
    return feature, split, depth
