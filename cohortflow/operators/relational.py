"""Small relational steps several operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.exprs import quoted


_MOMENTS = (T.DateType, T.TimestampNTZType, T.TimestampType)


def require_columns(df: DataFrame, names: list[str]) -> None:
    for name in names:
        if name not in df.columns:
            raise ValueError(
                f"Column {name!r} not found in input. Available columns: "
                + ", ".join(df.columns[:40])
            )


def is_numeric(dtype: T.DataType) -> bool:
    """Numbers including decimals; booleans are not numbers here."""
    return isinstance(dtype, T.NumericType)


def resolve_numeric(df: DataFrame, columns: str | list[str] | None = None) -> list[str]:
    """The columns to compute on: a comma list or a Python list, else every numeric column."""
    if isinstance(columns, str):
        columns = [c.strip() for c in columns.split(",") if c.strip()]
    if columns:
        absent = [c for c in columns if c not in df.columns]
        if absent:
            raise ValueError(f"Columns not found: {absent}")
        other = [c for c in columns if not is_numeric(df.schema[c].dataType)]
        if other:
            raise ValueError(f"Columns are not numeric: {other}")
        return list(columns)
    found = [f.name for f in df.schema.fields if is_numeric(f.dataType)]
    if not found:
        raise ValueError("No numeric columns found")
    return found


def lead_then_sorted(df: DataFrame, lead: list[str]) -> DataFrame:
    """Leading columns in the given order, all others by name."""
    first = [c for c in lead if c in df.columns]
    rest = sorted(c for c in df.columns if c not in first)
    return df.select(*[quoted(c) for c in first + rest])


def union_widen(frames: list[DataFrame]) -> DataFrame:
    """Union by name over different column sets; conflicting types meet in a common one.

    Whole numbers widen to bigint, decimals to the decimal that holds them all, other numbers to double,
    dates and timestamps to a timestamp, anything else to string. The cast is explicit
    because an implicit string-to-number union fails at run time under ANSI rules.
    """
    if not frames:
        raise ValueError("union_widen needs at least one frame")
    seen: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            seen.setdefault(field.name, []).append(field.dataType)
    target = {name: _common_type(types) for name, types in seen.items()}
    aligned = [
        frame.select(*[F.col(quoted(c)).cast(target[c]).alias(c) for c in frame.columns])
        for frame in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def _common_type(types: list[T.DataType]) -> T.DataType:
    known = [t for t in types if not isinstance(t, T.NullType)] or types
    if all(t == known[0] for t in known):
        return known[0]
    if all(isinstance(t, T.IntegralType) for t in known):
        return T.LongType()
    if all(isinstance(t, T.DecimalType) for t in known):
        scale = max(t.scale for t in known)
        digits = max(t.precision - t.scale for t in known) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    if all(is_numeric(t) for t in known):
        return T.DoubleType()
    if all(isinstance(t, _MOMENTS) for t in known):
        zoned = any(isinstance(t, T.TimestampType) for t in known)
        return T.TimestampType() if zoned else T.TimestampNTZType()
    return T.StringType()


def one_value_per_key(df: DataFrame, keys: list[Column | str], value: str, *order: str) -> DataFrame:
    """One row per key with the non-null value that is smallest by ``order``, then by value.

    NULL keys group together; a key whose values are all NULL keeps its row.
    """
    ranked = F.struct(*[F.col(c) for c in order], F.col(value).alias("_value"))
    smallest = F.min(F.when(F.col(value).isNotNull(), ranked))
    return df.groupBy(*keys).agg(smallest["_value"].alias(value))


def pivot_fields(df: DataFrame, name: str) -> list[str]:
    """The sorted distinct values of the column to pivot on, counted before they are read."""
    found = df.select(name).dropna().distinct()
    _check_pivot(df, found.count())
    return sorted(r[0] for r in found.collect())


def pivot_values(
    df: DataFrame, keys: list[str], name: str, value: str, fields: list[str], how: str = "min"
) -> DataFrame:
    """Long to wide with a given field list (``min`` of one value per cell, or ``avg``)."""
    _check_pivot(df, len(fields))
    pivoted = df.groupBy(*[F.col(quoted(k)) for k in keys]).pivot(name, fields)
    return pivoted.agg(getattr(F, how)(value))


def _check_pivot(df: DataFrame, fields: int) -> None:
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    if fields > limit:
        raise ValueError(f"{fields} pivot fields exceed spark.sql.pivotMaxValues={limit}")


def repeated_keys(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)
