"""Pairwise correlation reports: Pearson, Spearman, Kendall tau-b."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.functions.exprs import clean_double, round_even
from cohortflow.operators.relational import resolve_numeric
from cohortflow.operators.skew import broadcast_if_small
from cohortflow.session import stage

# functions of this module travel to the Python workers by value, so they need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAIRS_PER_CHUNK = 9
MAX_CHUNKS = 5
ROWS_PER_BUCKET = 2_000_000
NO_SPREAD = 1e-12  #: share of the squares that rounding may leave


def correlation_report(
    df: DataFrame,
    method: str = "pearson",
    columns: str | list[str] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per unordered column pair over the rows where both values are present.

    Columns: column_a, column_b, correlation (4 digits, NULL where undefined), strength, direction.
    """
    names = resolve_numeric(df, columns)
    if len(names) < 2:
        raise ValueError("Need at least 2 numeric columns to compute correlation")
    measures = {"pearson": _pearson, "spearman": _spearman, "kendall": _kendall}
    if method not in measures:
        raise ValueError(f"Unknown method {method!r}; expected one of {sorted(measures)}")
    pairs = list(combinations(range(len(names)), 2))
    numbers = df.select(*[clean_double(df, c).alias(f"c{i}") for i, c in enumerate(names)])
    raw = measures[method](numbers, pairs, rows_per_bucket)
    label = F.array(
        *[F.struct(F.lit(names[i]).alias("a"), F.lit(names[j]).alias("b")) for i, j in pairs]
    )
    value = F.col("correlation")
    size = F.abs(value)
    return raw.withColumn("_names", F.get(label, F.col("pair"))).select(
        F.col("_names.a").alias("column_a"),
        F.col("_names.b").alias("column_b"),
        round_even(F.col("r"), 4).alias("correlation"),
    ).select(
        "*",
        F.when(size >= 0.7, "strong").when(size >= 0.4, "moderate").otherwise("weak").alias("strength"),
        F.when(value > 0.05, "positive").when(value < -0.05, "negative").otherwise("none").alias("direction"),
    ).orderBy(size.desc_nulls_last(), "column_a", "column_b")


def top_correlations(report: DataFrame, n: int = 5) -> DataFrame:
    """The n strongest pairs of a report."""
    order = [F.abs("correlation").desc_nulls_last(), F.col("column_a"), F.col("column_b")]
    return report.orderBy(*order).limit(n)


def _pearson(numbers: DataFrame, pairs: list[tuple[int, int]], _: int) -> DataFrame:
    """Few pairs: one row of aggregates per chunk, each chunk a scan of its own columns.

    A chunk keeps its buffers below the 100 fields that whole-stage code generation takes
    (spark.sql.codegen.maxFields). Many pairs would mean many scans; they come from sums of products
    over blocks of rows.
    """
    if len(pairs) > MAX_CHUNKS * PAIRS_PER_CHUNK:
        return _every_pair(_gram(numbers, pairs), pairs)
    parts = []
    for start in range(0, len(pairs), PAIRS_PER_CHUNK):
        structs = []
        for k, (i, j) in enumerate(pairs[start : start + PAIRS_PER_CHUNK], start=start):
            x, y = F.col(f"c{i}"), F.col(f"c{j}")
            spread = F.sqrt(
                F.var_pop(F.when(y.isNotNull(), x)) * F.var_pop(F.when(x.isNotNull(), y))
            )
            r = F.try_divide(F.covar_pop(x, y), spread)
            structs.append(F.struct(F.lit(k).alias("pair"), r.alias("r")))
        parts.append(numbers.agg(F.array(*structs).alias("_all")).select(F.inline("_all")))
    return reduce(DataFrame.unionByName, parts)


def _gram(numbers: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    """``pair, r`` from matrix products of row blocks, with a mask for the values present.

    Values are counted from their column's mean, so that sums of squares lose no digits. A task holds
    six numbers per pair whatever it reads, and writes them once. A spread that rounding alone would
    leave counts as none.
    """
    names = numbers.columns
    means = numbers.agg(*[F.avg(c).alias(c) for c in names]).first()
    shift = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])
    left, right = (np.array(side) for side in zip(*pairs, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(shift)
        n, sx, sxx, sxy = (np.zeros((d, d)) for _ in range(4))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float) - shift
            there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            x, there = np.where(there, x, 0.0), there.astype(float)
            n += there.T @ there
            sx += x.T @ there  # at (i, j): the sum of column i where column j is present
            sxx += (x * x).T @ there
            sxy += x.T @ x
        sums = [n[left, right], sx[left, right], sx[right, left], sxx[left, right], sxx[right, left], sxy[left, right]]
        arrays = [pa.array(np.arange(len(left), dtype=np.int32)), *map(pa.array, sums)]
        yield pa.RecordBatch.from_arrays(arrays, names=["pair", "n", "x", "y", "xx", "yy", "xy"])

    parts = numbers.mapInArrow(run, "pair int, n double, x double, y double, xx double, yy double, xy double")
    total = parts.groupBy("pair").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])

    def spread(at: str) -> Column:
        squares = F.col(f"{at}{at}")
        rest = squares - F.try_divide(F.col(at) * F.col(at), F.col("n"))
        return F.when((rest <= NO_SPREAD * squares) & (squares < float("inf")), 0.0).otherwise(rest)

    shared = F.col("xy") - F.try_divide(F.col("x") * F.col("y"), F.col("n"))
    r = F.try_divide(shared, F.sqrt(spread("x")) * F.sqrt(spread("y")))
    one = F.when(F.isnan("r"), F.col("r")).when(F.col("r") > 1, 1.0).when(F.col("r") < -1, -1.0)
    return total.select("pair", r.alias("r")).select("pair", one.otherwise(F.col("r")).alias("r"))


def _pair_rows(numbers: DataFrame, pairs, buckets: dict[str, Column] | None = None) -> DataFrame:
    """One row per table row and column pair where both values are present."""
    structs = []
    for k, (i, j) in enumerate(pairs):
        fields = [F.lit(k).alias("pair"), F.col(f"c{i}").alias("x"), F.col(f"c{j}").alias("y")]
        if buckets:
            fields += [buckets[f"c{i}"].alias("xb"), buckets[f"c{j}"].alias("yb")]
        structs.append(F.struct(*fields))
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    return numbers.select(F.inline(F.array(*structs))).filter(both)


def _cells(numbers: DataFrame, pairs, buckets: dict[str, Column] | None = None) -> DataFrame:
    """Distinct value pairs with their row count, for all column pairs in one pass."""
    keys = ["pair", "x", "y"] + (["xb", "yb"] if buckets else [])
    counted = F.count(F.lit(1)).alias("n")
    return _pair_rows(numbers, pairs, buckets).groupBy(*keys).agg(counted)


# Spearman: average ranks from value buckets, as many as the rows ask for. A bucket is either an open
# interval between two cut values (even id) or one cut value alone (odd id). A frequent value is always
# a cut value, and its rank needs only bucket sizes, so no task has to sort a hot value.


def _spearman(numbers: DataFrame, pairs, rows_per_bucket: int) -> DataFrame:
    numbers = stage(numbers, "numbers")  # counted, cut and ranked: the input is read and dealt once
    total = numbers.count()
    cuts = max(1, -(-total // rows_per_bucket))
    bucketed, ids = _value_buckets(numbers, cuts)
    cells = _cells(bucketed, pairs, ids)
    sizes = {"x": None, "y": None}
    if cuts > 1:
        cells = stage(cells, "cells")
        sizes = {axis: _bucket_sizes(cells, axis) for axis in sizes}
    ranked = _with_rank(_with_rank(cells, "x", "y", sizes["x"]), "y", "x", sizes["y"])
    n, rx, ry = F.col("n"), F.col("x_rank"), F.col("y_rank")
    sums = ranked.groupBy("pair").agg(
        F.sum(n).cast("double").alias("N"),
        F.sum(n * rx * ry).alias("xy"),
        F.sum(n * rx * rx).alias("xx"),
        F.sum(n * ry * ry).alias("yy"),
        (F.min("x") == F.max("x")).alias("x_flat"),
        (F.min("y") == F.max("y")).alias("y_flat"),
    )
    middle = F.col("N") * F.pow((F.col("N") + 1) / 2, F.lit(2.0))
    r = F.try_divide(
        F.col("xy") - middle, F.sqrt((F.col("xx") - middle) * (F.col("yy") - middle))
    )
    measured = sums.select("pair", F.when(~F.col("x_flat") & ~F.col("y_flat"), r).alias("r"))
    return _every_pair(measured, pairs)


def _value_buckets(numbers: DataFrame, cuts: int) -> tuple[DataFrame, dict[str, Column]]:
    names = numbers.columns
    if cuts <= 1:
        return numbers, {c: F.lit(0) for c in names}
    probs = [k / cuts for k in range(1, cuts)]
    bounds = [sorted(set(b)) for b in numbers.approxQuantile(names, probs, 1 / (4 * cuts))]
    ids = {c: F.lit(0) for c in names}
    for name, values in zip(names, bounds):
        if not values:
            continue
        # cut values up to the value, and cut values below it: the two differ for a cut value alone
        above = [float(np.nextafter(v, np.inf)) for v in values]
        for at, splits in ((f"_upto_{name}", values), (f"_below_{name}", above)):
            numbers = Bucketizer(
                splits=[-float("inf"), *sorted(set(splits)), float("inf")], inputCol=name, outputCol=at, handleInvalid="keep"
            ).transform(numbers)
        ids[name] = (F.col(f"_upto_{name}") + F.col(f"_below_{name}")).cast("int")
    return numbers, ids


def _bucket_sizes(cells: DataFrame, axis: str) -> DataFrame:
    """Per pair and bucket: rows in it and rows in the buckets before."""
    bucket = f"{axis}b"
    sizes = cells.groupBy("pair", bucket).agg(F.sum("n").alias("_size"))
    before = W.partitionBy("pair").orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    return sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))


def _with_rank(cells: DataFrame, axis: str, other: str, sizes: DataFrame | None) -> DataFrame:
    """Adds the average rank of one axis; without ``sizes`` a pair is a single bucket."""
    if sizes is None:
        group = W.partitionBy("pair")
    else:
        single = F.col(f"{axis}b") % 2 == 1
        # a hot value is a bucket of its own: its cells need no order, so they may be spread
        spread = F.when(single, F.pmod(F.xxhash64(other), F.lit(1024))).otherwise(0)
        cells = cells.withColumn("_spread", spread)
        group = W.partitionBy("pair", f"{axis}b", "_spread")
    upto = F.sum("n").over(group.orderBy(axis))  # a range frame: equal values count together
    ties = F.sum("n").over(group.orderBy(axis).rangeBetween(W.currentRow, W.currentRow))
    rank = upto - (ties - 1) / 2
    if sizes is None:
        return cells.withColumn(f"{axis}_rank", rank)
    return (
        cells.withColumn("_rank", rank)
        .join(broadcast_if_small(sizes), ["pair", f"{axis}b"])
        .withColumn(
            f"{axis}_rank",
            F.col("_before") + F.when(single, (F.col("_size") + 1) / 2).otherwise(F.col("_rank")),
        )
        .drop("_spread", "_rank", "_size", "_before")
    )


def _every_pair(measured: DataFrame, pairs) -> DataFrame:
    """Pairs without a common row keep their line, with an undefined value."""
    listed = measured.sparkSession.createDataFrame([(k,) for k in range(len(pairs))], "pair int")
    return listed.join(measured, "pair", "left")


# Kendall tau-b (Knight 1966): ties follow from value counts, so only the discordant pairs have to
# be counted. Small groups of cells are counted inside a task. A larger group is cut into buckets on
# both axes: pairs that differ in both buckets are counted on the bucket matrix, the others are in
# one x bucket or one y bucket, which are smaller problems of the same kind.

LEAF_CELLS = 1_000_000
CUTS = 256


def _kendall(
    numbers: DataFrame, pairs, _: int, leaf: int | None = None, cuts: int | None = None
) -> DataFrame:
    cells = stage(_cells(numbers, pairs), "cells")  # read for each tie count and each cut

    def tied(*keys: str) -> DataFrame:
        t = F.col("t").cast("double")
        return (
            cells.groupBy("pair", *keys)
            .agg(F.sum("n").alias("t"))
            .groupBy("pair")
            .agg(F.sum(t * (t - 1) / 2).alias("_".join(("t", *keys))))
        )

    points = cells.withColumn("grp", F.lit(""))
    discordant = _discordant(points, leaf or LEAF_CELLS, cuts or CUTS)
    sums = (
        tied()
        .join(tied("x"), "pair")
        .join(tied("y"), "pair")
        .join(tied("x", "y"), "pair")
        .join(discordant.groupBy("pair").agg(F.sum("d").alias("d")), "pair", "left")
    )
    all_, x, y, xy = F.col("t"), F.col("t_x"), F.col("t_y"), F.col("t_x_y")
    balance = all_ - x - y + xy - 2 * F.coalesce("d", F.lit(0.0))
    spread = F.sqrt(all_ - x) * F.sqrt(all_ - y)
    return _every_pair(sums.select("pair", F.try_divide(balance, spread).alias("r")), pairs)


def _discordant(points: DataFrame, leaf: int, cuts: int) -> DataFrame:
    key = ["pair", "grp"]
    sizes = points.groupBy(*key).agg(F.count(F.lit(1)).alias("_size"))
    if (sizes.agg(F.max("_size")).first()[0] or 0) <= leaf:
        return points.groupBy(*key).applyInPandas(_count_discordant, "pair int, d double")

    probs = [k / cuts for k in range(1, cuts)]
    marked = points.join(broadcast_if_small(sizes.filter(F.col("_size") > leaf)), key, "left")
    small = marked.filter(F.col("_size").isNull()).drop("_size")
    large = marked.filter(F.col("_size").isNotNull()).drop("_size")
    bounds = large.groupBy(*key).agg(
        *[
            F.array_sort(F.array_distinct(F.percentile_approx(c, probs))).alias(f"{c}s")
            for c in ("x", "y")
        ]
    )
    placed = large.join(broadcast_if_small(bounds, 20_000), key)
    for axis in ("x", "y"):
        placed = placed.withColumn(f"{axis}b", _bucket(axis)).drop(f"{axis}s")
    matrix = (
        placed.groupBy(*key, F.col("xb").alias("x"), F.col("yb").alias("y"))
        .agg(F.sum("n").alias("n"))
        .groupBy(*key)
        .applyInPandas(_count_discordant, "pair int, d double")
    )
    same_x = placed.filter(F.col("xb") % 2 == 1).select(
        "pair", F.concat("grp", F.lit("x"), F.col("xb").cast("string")).alias("grp"), "x", "y", "n"
    )
    same_y = (
        placed.filter(F.col("yb") % 2 == 1)
        .groupBy(
            "pair",
            F.concat("grp", F.lit("y"), F.col("yb").cast("string")).alias("grp"),
            F.col("xb").cast("double").alias("x"),
            "y",
        )
        .agg(F.sum("n").alias("n"))
    )
    deeper = stage(same_x.unionByName(same_y), "groups")
    done = small.groupBy(*key).applyInPandas(_count_discordant, "pair int, d double")
    return done.unionByName(matrix).unionByName(_discordant(deeper, leaf, cuts))


def _bucket(axis: str) -> Column:
    """Even: equal to a cut value; odd: between two cut values."""
    at = F.size(F.filter(F.col(f"{axis}s"), lambda cut: cut <= F.col(axis)))
    equal = F.coalesce(F.get(F.col(f"{axis}s"), at - 1) == F.col(axis), F.lit(False))
    return 2 * at + (~equal).cast("int")


def _count_discordant(cells: pd.DataFrame) -> pd.DataFrame:
    """Weighted pairs with x ascending and y descending, counted bit by bit of the y rank."""
    x, y = cells["x"].to_numpy(), cells["y"].to_numpy()
    weight = cells["n"].to_numpy(dtype=float)
    order = np.lexsort((y, x))
    rank = np.unique(y, return_inverse=True)[1][order]
    weight = weight[order]
    found = 0.0
    for bit in reversed(range(int(rank.max()).bit_length())):
        high = (rank >> bit) & 1
        ones = np.cumsum(weight * high)
        prefix = rank >> (bit + 1)
        starts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
        base = np.where(starts > 0, ones[starts - 1], 0.0)
        earlier = ones - np.repeat(base, np.diff(np.r_[starts, len(rank)]))
        found += float(np.sum((weight * earlier)[high == 0]))
        regroup = np.argsort(rank >> bit, kind="stable")
        rank, weight = rank[regroup], weight[regroup]
    return pd.DataFrame({"pair": [int(cells["pair"].iloc[0])], "d": [found]})
