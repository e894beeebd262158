"""Exact order statistics and dense numbering that never sort a whole table in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.functions.exprs import clean_double
from cohortflow.operators.skew import ordered_pieces

DIRECT_ROWS = 1_000_000


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], direct_rows: int = DIRECT_ROWS
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation, missing values left out.

    Up to ``direct_rows`` rows the built-in ``percentile`` is one job. It keeps every distinct value
    in one buffer, so larger tables narrow each quantile down instead: an approximate quantile gives
    a bracket, one aggregate counts what lies below and inside it, and only a bracket with few
    distinct values is read.
    """
    numbers = df.select(*[clean_double(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    names = numbers.columns
    if df.count() <= direct_rows:
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        row = numbers.agg(*[F.percentile(n, wanted).alias(n) for n in names]).first()
        return {c: list(row[n] or [None] * len(probs)) for c, n in zip(columns, names)}

    counts = numbers.agg(*[F.count(n).alias(n) for n in names]).first()
    targets = [
        _Target(n, (counts[n] - 1) * p, counts[n]) for n in names if counts[n] for p in probs
    ]
    _narrow(numbers, targets, direct_rows // 10)
    found = iter(_read_brackets(numbers, targets))
    return {
        c: [next(found) if counts[n] else None for _ in probs] for c, n in zip(columns, names)
    }


class _Target:
    """One quantile of one column and the closed bracket that holds its order statistics."""

    def __init__(self, name: str, position: float, count: int):
        self.name, self.position = name, position
        self.first, self.last = math.floor(position), math.ceil(position)
        self.low, self.high = -math.inf, math.inf
        self.below, self.inside = 0, count
        self.done = False

    def within(self) -> Column:
        """The value where it lies in the bracket, else NULL."""
        value = F.col(self.name)
        return F.when(value.between(F.lit(self.low), F.lit(self.high)), value)


def _narrow(numbers: DataFrame, targets: list[_Target], limit: int, accuracy: int = 10_000) -> None:
    slack = 4.0 / accuracy
    for _ in range(64):
        open_ = [t for t in targets if not t.done]
        if not open_:
            return
        guesses = []
        for i, t in enumerate(open_):
            span = max(t.inside - 1, 1)
            probs = [
                max(0.0, (t.first - t.below) / span - slack),
                min(1.0, (t.last - t.below) / span + slack),
            ]
            guesses += [
                F.percentile_approx(t.within(), probs, accuracy).alias(f"q{i}"),
                F.approx_count_distinct(t.within()).alias(f"d{i}"),
            ]
        row = numbers.agg(*guesses).first()
        for i, t in enumerate(open_):
            t.done = t.low == t.high or row[f"d{i}"] <= limit
        open_ = [(t, row[f"q{i}"]) for i, t in enumerate(open_) if not t.done]
        if not open_:
            return
        checks = []
        for i, (t, (low, high)) in enumerate(open_):
            value = F.col(t.name)
            checks += [
                F.count(F.when(value < F.lit(low), 1)).alias(f"b{i}"),
                F.count(F.when(value.between(F.lit(low), F.lit(high)), 1)).alias(f"n{i}"),
            ]
        row = numbers.agg(*checks).first()
        missed = False
        for i, (t, (low, high)) in enumerate(open_):
            below, inside = row[f"b{i}"], row[f"n{i}"]
            if below <= t.first and t.last < below + inside:
                t.low, t.high, t.below, t.inside = low, high, below, inside
            else:
                missed = True
        if missed:
            slack *= 4
    raise RuntimeError("quantile brackets did not converge")


def _read_brackets(numbers: DataFrame, targets: list[_Target]) -> list[float]:
    if not targets:
        return []
    each = F.array(
        *[F.struct(F.lit(i).alias("target"), t.within().alias("value")) for i, t in enumerate(targets)]
    )
    rows = (
        numbers.select(F.inline(each))
        .filter(F.col("value").isNotNull())
        .groupBy("target", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    values: dict[int, list[tuple[float, int]]] = {}
    for r in sorted(rows, key=lambda r: (r["target"], r["value"])):
        values.setdefault(r["target"], []).append((r["value"], r["n"]))
    answers = []
    for i, t in enumerate(targets):
        low, high = (_at(values[i], k - t.below) for k in (t.first, t.last))
        answers.append(low + (high - low) * (t.position - t.first))
    return answers


def _at(counted: list[tuple[float, int]], k: int) -> float:
    for value, n in counted:
        if k < n:
            return value
        k -= n
    raise RuntimeError("order statistic outside its bracket")


def dense_index(
    values: DataFrame, column: str, name: str, per_piece: int = 500_000, total: int | None = None
) -> tuple[DataFrame, int]:
    """Number distinct values 0..k-1 in ascending order; returns the frame and k (``total``, where it is known).

    A dictionary of at most ``per_piece`` values is numbered in one task. A larger one is cut into
    sorted ranges that are numbered on their own and shifted by the sizes of the ranges before.
    """
    if total is None:
        total = values.count()
    if total <= per_piece:
        position = F.row_number().over(W.orderBy(column))
        return values.withColumn(name, (position - 1).cast("bigint")), total
    cut = ordered_pieces(values, [F.col(column)], -(-total // per_piece) + 1)
    sizes = cut.groupBy("_piece").agg(F.count(F.lit(1)).alias("_rows"))
    before = W.orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_done")
    )
    inside = F.row_number().over(W.partitionBy("_piece").orderBy(column))
    numbered = cut.join(F.broadcast(offsets), "_piece").withColumn(
        name, (F.col("_done") + inside - 1).cast("bigint")
    )
    return numbered.drop("_piece", "_row", "_done"), total
