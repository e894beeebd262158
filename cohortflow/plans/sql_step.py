"""One SELECT over named inputs, exported to every declared output."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortflow.sources.io import read_format, write_outputs

# Fixed value: the alias of a single input.
SINGLE_INPUT = "input_data"


@dataclass(frozen=True)
class SqlResult:
    result: DataFrame
    row_count: int | None


def sanitize_table_name(name: str) -> str:
    """Characters that are neither alphanumeric nor an underscore become underscores."""
    return re.sub(r"[^\w]", "_", name)


def sql_transform(
    spark: SparkSession,
    sql: str,
    inputs: Mapping[str, DataFrame | Mapping],
    outputs: Sequence[Mapping] | None = None,
    name: str = "result",
) -> SqlResult:
    """Register the inputs as views, run ``sql`` and write the result.

    An input is a DataFrame or a mapping with ``path`` and ``format``. A single input is also known
    as ``input_data``. With ``outputs`` the rows are counted during the first write; without, the
    lazy result is returned and ``row_count`` is None.
    """
    if not name:
        raise ValueError("name is required")
    if not sql or not sql.strip():
        raise ValueError("sql is required")
    if not inputs:
        raise ValueError("At least one input is required")
    if outputs is not None and not outputs:
        raise ValueError("At least one output is required")
    views: dict[str, str] = {}
    for given in inputs:
        view = sanitize_table_name(given)
        if view.lower() in views:
            raise ValueError(f"Inputs {views[view.lower()]!r} and {given!r} share the table name {view!r}")
        views[view.lower()] = given
    frames = {sanitize_table_name(given): _frame(spark, source) for given, source in inputs.items()}
    for view, df in frames.items():
        df.createOrReplaceTempView(f"`{view}`")
    if len(frames) == 1:
        next(iter(frames.values())).createOrReplaceTempView(SINGLE_INPUT)
    else:
        spark.catalog.dropTempView(SINGLE_INPUT)
    result = spark.sql(sql)
    if outputs is None:
        return SqlResult(result, None)
    counted = Observation(sanitize_table_name(name))
    write_outputs(result.observe(counted, F.count(F.lit(1)).alias("rows")), outputs)
    return SqlResult(result, counted.get["rows"])


def _frame(spark: SparkSession, source: DataFrame | Mapping) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    return read_format(spark, source["path"], source.get("format", "parquet"))
