"""Scaling and label encoding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.exprs import clean_double, nan_to_null, quoted
from cohortflow.operators.ranking import dense_index
from cohortflow.operators.relational import resolve_numeric
from cohortflow.operators.skew import HOT_ROWS, lookup
from cohortflow.session import stage

# Fixed value: the label of a missing category.
MISSING = "__missing__"
# A dictionary is broadcast up to so many entries and bytes (its longest text times its entries).
BROADCAST_ENTRIES, BROADCAST_BYTES = 200_000, 64 << 20


def scale(df: DataFrame, method: str = "standard", columns: str | list[str] | None = None) -> DataFrame:
    """``standard``: (x - mean) / population std; ``minmax``: (x - min) / (max - min).

    Missing values are left out of the fit and stay missing; a constant column becomes 0.
    """
    fits = {"standard": (F.avg, F.stddev_pop), "minmax": (F.min, F.max)}
    if method not in fits:
        raise ValueError(f"Unknown scaling method {method!r}; expected one of {sorted(fits)}")
    names = resolve_numeric(df, columns)
    values = {c: clean_double(df, c) for c in names}
    first, second = fits[method]
    fitted = df.agg(
        *[first(values[c]).alias(f"a{i}") for i, c in enumerate(names)],
        *[second(values[c]).alias(f"b{i}") for i, c in enumerate(names)],
    ).first()
    scaled = {}
    for i, c in enumerate(names):
        start, spread = fitted[f"a{i}"], fitted[f"b{i}"]
        if method == "minmax" and spread is not None:
            spread = spread - start
        scaled[c] = (values[c] - F.lit(start).cast("double")) / F.lit(spread or 1.0)
    return df.withColumns(scaled)


def label_encode(
    df: DataFrame,
    columns: str | list[str],
    keep_original: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds ``<column>_encoded``: the position of the value's text among the sorted distinct texts."""
    names = list(dict.fromkeys(_encoded_columns(df, columns)))
    if {f"{c}_encoded" for c in names} & set(names):  # a result is encoded in its turn
        for column in names:
            df = _encode(df, [column], keep_original, hot_rows)
        return df
    return _encode(df, names, keep_original, hot_rows)


def _encode(df: DataFrame, names: list[str], keep_original: bool, hot_rows: int) -> DataFrame:
    """Distinct texts of all columns in one pass, counted and measured in another, then one join per column."""
    entry = F.array(*[F.struct(F.lit(i).alias("at"), _as_text(df, c).alias("_text")) for i, c in enumerate(names)])
    texts = stage(df.select(F.inline(entry)).distinct(), "dictionary")
    facts = texts.groupBy("at").agg(F.count(F.lit(1)).alias("size"), F.max(F.octet_length("_text")).alias("width"))
    facts = {r["at"]: r for r in facts.collect()}  # a row per column
    for i, column in enumerate(names):
        size, width = (facts[i]["size"], facts[i]["width"]) if i in facts else (0, 0)
        target = f"{column}_encoded"
        entries, _ = dense_index(texts.filter(F.col("at") == i).select("_text"), "_text", target, total=size)
        texted = df.drop(target).withColumn("_text", _as_text(df, column))
        if size <= BROADCAST_ENTRIES and width * size <= BROADCAST_BYTES:
            joined = texted.join(F.broadcast(entries), "_text", "left")
        else:
            joined = lookup(texted, stage(entries, "dictionary"), ["_text"], "left", hot_rows)  # counted, then joined
        df = joined.drop("_text") if keep_original else joined.drop("_text", column)
    return df


def encoding_map(df: DataFrame, columns: str | list[str]) -> DataFrame:
    """One row per column and value: column, value, label."""
    parts = [
        _dictionary(df, c)[0].select(F.lit(c).alias("column"), F.col("_text").alias("value"), "label")
        for c in _encoded_columns(df, columns)
    ]
    return reduce(DataFrame.unionByName, parts)


def _encoded_columns(df: DataFrame, columns: str | list[str]) -> list[str]:
    if isinstance(columns, str):
        columns = [c.strip() for c in columns.split(",") if c.strip()]
    if not columns:
        raise ValueError("columns is required: give the names of the columns to encode")
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"Columns not found in dataset: {absent}")
    return list(columns)


def _as_text(df: DataFrame, name: str) -> Column:
    col, dtype = F.col(quoted(name)), df.schema[name].dataType
    if isinstance(dtype, T.BooleanType):
        text = F.when(col, F.lit("True")).when(~col, F.lit("False"))
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        text = _float_text(nan_to_null(col).cast("string"))
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit(MISSING))


def _float_text(spelled: Column) -> Column:
    """A float's text in the spelling of Python: without exponent from 1e-4 up to 1e16.

    Spark spells 1.0E7 and 1.0E-4; the digits and the exponent are kept and only written otherwise.
    """
    part = lambda i: F.regexp_extract(spelled, r"^(-?)(\d)\.(\d+)E(-?\d+)$", i)
    exponent = part(4).cast("int")
    rest = F.when(part(3) == "0", F.lit("")).otherwise(part(3))
    digits = F.concat(part(2), rest)
    whole = F.rpad(F.substr(digits, F.lit(1), exponent + 1), exponent + 1, "0")
    after = F.substr(digits, exponent + 2, F.length(digits))
    large = F.concat(whole, F.lit("."), F.when(after == "", F.lit("0")).otherwise(after))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    mantissa = F.concat(part(2), F.when(rest == "", F.lit("")).otherwise(F.concat(F.lit("."), rest)))
    sign = F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+"))
    power = F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), "0")
    unsigned = (
        F.when(exponent.between(0, 15), large)
        .when(exponent.between(-4, -1), small)
        .otherwise(F.concat(mantissa, sign, power))
    )
    return F.when(spelled.contains("E"), F.concat(part(1), unsigned)).otherwise(spelled)


def _dictionary(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    return dense_index(df.select(_as_text(df, name).alias("_text")).distinct(), "_text", "label")
