"""Carrying the last known value forward inside each key, and the as-of join built on it.

Ordinary keys are one window each. A key with too many rows for one task is cut into contiguous
pieces of its order; each piece is filled on its own, and what a piece inherits from the pieces
before it comes from a summary with one row per piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.functions.exprs import quoted
from cohortflow.operators.relational import require_columns
from cohortflow.operators.skew import HOT_ROWS, KeyProfile, ordered_pieces, profile_keys, split_hot


def carry_forward(
    df: DataFrame, keys: list[str], order: list[Column], seeds: int, profile: KeyProfile
) -> DataFrame:
    """For each seed column ``_s<i>`` add ``_c<i>`` (last non-null seed so far) and ``_gap<i>``
    (rows since it)."""
    if profile.hot is None:
        return _inside(df, keys, order, seeds)
    hot, cold = split_hot(df, keys, profile.hot)
    return _inside(cold, keys, order, seeds).unionByName(
        _across_pieces(hot, keys, order, seeds, profile.pieces)
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_time: str,
    right_time: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each left row with the latest right row of its key at or before its time (left join).

    Both sides share one ordered pass, so no key builds row pairs. Right columns that collide with a
    left name are not allowed; right rows of equal time are ordered by their other columns.
    """
    require_columns(left, [*keys, left_time])
    require_columns(right, [*keys, right_time])
    wanted = [c for c in right.columns if c not in keys]
    clash = sorted(set(wanted) & set(left.columns))
    if clash:
        raise ValueError(f"Columns exist on both sides: {clash}")
    key_cols = [F.col(quoted(k)) for k in keys]
    payload = F.struct(*[F.col(quoted(c)) for c in wanted])
    rows = right.dropna(subset=[*keys, right_time]).select(
        *key_cols, F.col(quoted(right_time)).alias("_t"), F.lit(0).alias("_side"), payload.alias("_s0")
    ).unionByName(
        left.select(
            *key_cols,
            F.col(quoted(left_time)).alias("_t"),
            F.lit(1).alias("_side"),
            F.struct(*[F.col(quoted(c)) for c in left.columns]).alias("_left"),
        ),
        allowMissingColumns=True,
    )
    order = [F.col("_t").asc_nulls_first(), F.col("_side").asc(), F.col("_s0").asc()]
    profile = profile_keys(rows, keys, hot_rows)
    carried = carry_forward(rows, keys, order, 1, profile).filter("_side = 1")
    found = F.when(F.col("_t").isNotNull(), F.col("_c0"))
    return carried.select("_left.*", found.alias("_found")).select(
        *[quoted(c) for c in left.columns], *[F.col(f"_found.{quoted(c)}").alias(c) for c in wanted]
    )


def _inside(df: DataFrame, keys: list[str], order: list[Column], seeds: int) -> DataFrame:
    w = W.partitionBy(*[F.col(quoted(k)) for k in keys]).orderBy(*order)
    so_far = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    out = df.withColumn("_rn", F.row_number().over(w).cast("bigint"))
    for i in range(seeds):
        seed = F.col(f"_s{i}")
        at = F.last(F.when(seed.isNotNull(), F.col("_rn")), ignorenulls=True).over(so_far)
        out = (
            out.withColumn(f"_c{i}", F.last(seed, ignorenulls=True).over(so_far))
            .withColumn(f"_at{i}", at)
            .withColumn(f"_gap{i}", F.col("_rn") - F.col(f"_at{i}"))
        )
    return out


def _across_pieces(
    df: DataFrame, keys: list[str], order: list[Column], seeds: int, pieces: int
) -> DataFrame:
    key_cols = [F.col(quoted(k)) for k in keys]
    cut = ordered_pieces(df, [*key_cols, *order], pieces)
    local = _inside(cut, [*keys, "_piece"], [*order, F.col("_row")], seeds)
    # One row per key and piece: pieces are contiguous, so there are at most (pieces + hot keys)
    # rows, which bounds the broadcast below.
    facts = [F.count(F.lit(1)).alias("_rows")]
    for i in range(seeds):
        facts.append(F.max_by(F.col(f"_c{i}"), F.col("_rn")).alias(f"_last{i}"))
        facts.append(F.max(f"_at{i}").alias(f"_lastat{i}"))
    before = W.partitionBy(*key_cols).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    summary = local.groupBy(*key_cols, "_piece").agg(*facts)
    summary = summary.withColumn("_done", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    inherited = []
    for i in range(seeds):
        at = F.col("_done") + F.col(f"_lastat{i}")
        inherited.append(F.last(f"_last{i}", ignorenulls=True).over(before).alias(f"_in{i}"))
        inherited.append(F.last(at, ignorenulls=True).over(before).alias(f"_inat{i}"))
    summary = summary.select(*key_cols, "_piece", "_done", *inherited)
    out = local.join(F.broadcast(summary), [*keys, "_piece"], "left")
    extra = ["_piece", "_row", "_done"]
    for i in range(seeds):
        reach = F.col("_done") + F.col("_rn") - F.col(f"_inat{i}")
        gap = F.when(F.col(f"_at{i}").isNull(), reach).otherwise(F.col(f"_gap{i}"))
        out = out.withColumn(f"_gap{i}", gap).withColumn(
            f"_c{i}", F.coalesce(F.col(f"_c{i}"), F.col(f"_in{i}"))
        )
        extra += [f"_in{i}", f"_inat{i}"]
    return out.drop(*extra)
