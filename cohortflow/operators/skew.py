"""Hot keys: find them with one narrow job, then give their rows a plan without a hot task.

A key is hot when it holds more rows than one task should take. At most ``SHARES`` keys can hold
more than one part in ``SHARES`` of a table, so the list of hot keys has a size bound that does not
grow with the data, and it may be collected and broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.exprs import quoted
from cohortflow.session import stage

SHARES = 32_768
HOT_ROWS = 2_000_000


@dataclass(frozen=True)
class KeyProfile:
    rows: int
    missing: int
    hot_rows: int
    row_limit: int
    hot: DataFrame | None

    @property
    def pieces(self) -> int:
        """How many row ranges the hot rows should be cut into."""
        return max(2, 2 * -(-self.hot_rows // self.row_limit))


def profile_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> KeyProfile:
    """Count rows per key (reading only the key columns) and list the hot keys."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(quoted(key)).isNull()
    counts = df.groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(
        F.sum("_n").alias("rows"),
        F.max("_n").alias("top"),
        F.sum(F.when(missing, F.col("_n"))).alias("missing"),
    ).first()
    rows, top = total["rows"] or 0, total["top"] or 0
    limit = max(hot_rows, -(-rows // SHARES))
    if top <= limit:
        return KeyProfile(rows, total["missing"] or 0, 0, limit, None)
    found = counts.filter(F.col("_n") > limit).collect()
    hot = df.sparkSession.createDataFrame(
        [tuple(r[k] for k in keys) for r in found], df.select(*[quoted(k) for k in keys]).schema
    )
    return KeyProfile(rows, total["missing"] or 0, sum(r["_n"] for r in found), limit, hot)


def split_hot(df: DataFrame, keys: list[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of hot keys, all other rows); both are map-side joins against the bounded key list."""
    match = _same_keys(df, hot, keys)
    listed = F.broadcast(hot)
    return df.join(listed, match, "left_semi"), df.join(listed, match, "left_anti")


def lookup(
    rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join ``table`` (one row per key) to ``rows``; rows of hot keys stay where they are.

    Cold rows take the plain join. The lookup rows of hot keys are at most ``SHARES``, so they are
    broadcast to the hot rows instead of pulling a hot key into one task.
    """
    profile = profile_keys(rows, keys, hot_rows)
    if profile.hot is None:
        return rows.join(table, keys, how)
    hot, cold = split_hot(rows, keys, profile.hot)
    few = table.join(F.broadcast(profile.hot), keys, "left_semi")
    return cold.join(table, keys, how).unionByName(hot.join(F.broadcast(few), keys, how))


def with_row_ids(df: DataFrame, name: str = "_row") -> DataFrame:
    """Rows with a unique id that later passes can rely on (materialised before use)."""
    return stage(df.withColumn(name, F.monotonically_increasing_id()), "rows")


def ordered_pieces(df: DataFrame, order: list[Column], pieces: int, name: str = "_piece") -> DataFrame:
    """Cut rows into contiguous ranges of ``order``; exact copies may end in different pieces.

    The row id is the last sort key, so even a group of identical rows is spread. The result is
    materialised, because range bounds are sampled and must not change between passes.
    """
    ranged = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(
        pieces, *order, F.col("_row")
    )
    return stage(ranged.withColumn(name, F.spark_partition_id()), "pieces")


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Hint a broadcast only after counting that the table stays below ``max_rows``."""
    return F.broadcast(df) if df.count() <= max_rows else df


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    match = F.lit(True)
    for key in keys:
        match = match & left[quoted(key)].eqNullSafe(right[quoted(key)])
    return match
