"""Reading inputs, writing outputs, exporting granted tables."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from cohortflow.functions.exprs import quoted
from cohortflow.session import stage
from cohortflow.sources.catalog import AccessError, view_columns

FETCH_ROWS = 50_000
EXPORT_FORMATS = ("parquet", "csv")


class NoColumnsError(AccessError):
    """A view of which the catalog opens no column."""


IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read by file extension: parquet, pq, csv, tsv."""
    extension = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if extension in ("parquet", "pq"):
        return spark.read.parquet(path)
    if extension in ("csv", "tsv"):
        return _csv_reader(spark.read, sep="," if extension == "csv" else "\t").csv(path, inferSchema=True)
    raise ValueError(f"Unsupported file type {extension!r}; accepted: parquet, pq, csv, tsv")


def _csv_reader(reader: DataFrameReader, sep: str = ",") -> DataFrameReader:
    """RFC 4180: doubled quotes, separators and line breaks inside quotes.

    An empty field is NULL and a quoted empty one an empty text; a null marker that no file holds keeps
    Spark from taking both for NULL.
    """
    return reader.options(header=True, sep=sep, quote='"', escape='"', multiLine=True, nullValue="\0")


def spread_few_files(df: DataFrame) -> DataFrame:
    """A scan of fewer files than cores is read by few tasks: spread its rows once.

    Meant before work that costs much more per row than the shuffle. A table of many files comes
    back as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def read_format(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Read a declared format: csv, json (lines or one array), anything else is parquet.

    A ``schema`` (DDL text or StructType) saves the inference pass over text files.
    """
    fmt = (fmt or "parquet").lower()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "csv":
        return _csv_reader(reader).csv(path, inferSchema=schema is None)
    if fmt == "json":
        head = spark.read.text(path).filter("trim(value) <> ''").head(1)
        whole = bool(head) and head[0]["value"].lstrip().startswith("[")
        return reader.json(path, multiLine=whole)
    return reader.parquet(path)


def row_cap(asked) -> int | None:
    """How many rows a caller asks for; nothing, blank and zero ask for all of them."""
    digits = "" if asked is None else str(asked).strip()
    if digits and not digits.isdecimal():
        raise ValueError(f"A row limit is a whole number of rows, not {asked!r}")
    return int(digits or 0) or None


def granted_table(spark: SparkSession, table: str, row_limit=None) -> DataFrame:
    """All columns of a table or temp view, with the optional row cap the caller asks for."""
    if not IDENTIFIER.fullmatch(table):
        raise ValueError(f"Invalid table_name: {table!r}")
    cap, df = row_cap(row_limit), spark.table(table)
    return df.limit(cap) if cap else df


def granted_view(spark: SparkSession, views: DataFrame, view: str, max_rows: int | None = None) -> DataFrame:
    """Only the columns the catalog marks accessible; a view without any raises."""
    columns = view_columns(views, view)
    if not columns:
        raise NoColumnsError(f"No column of view {view!r} may be read")
    df = spark.table(quoted(view)).select(*[quoted(c) for c in columns])
    return df if max_rows is None else df.limit(_positive(max_rows))


def granted_views(
    spark: SparkSession, views: DataFrame, names: Sequence[str] | None = None, max_rows: int | None = None
) -> dict[str, DataFrame]:
    """Many views; those without accessible columns are skipped."""
    names = [r["name"] for r in views.select("name").collect()] if names is None else list(names)
    found = {}
    for name in names:
        try:
            found[name] = granted_view(spark, views, name, max_rows)
        except NoColumnsError:
            continue
    return found


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    **options,
) -> DataFrame:
    """A warehouse table in parallel ranges of ``partition_column``; 50 000 rows per round trip."""
    if not IDENTIFIER.fullmatch(table.rsplit(".", 1)[-1]):
        raise ValueError(f"Invalid table_name: {table!r}")
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=FETCH_ROWS, **options)
    if partition_column:
        if not bounds:
            raise ValueError("partition_column needs bounds")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=partitions or spark.sparkContext.defaultParallelism,
        )
    return reader.load()


def run_query(spark: SparkSession, sql: str, params: Mapping | None = None) -> DataFrame:
    """A read query with ``:name`` parameters."""
    return spark.sql(sql, args=dict(params)) if params else spark.sql(sql)


def iter_batches(df: DataFrame, chunksize: int = FETCH_ROWS) -> Iterator[pd.DataFrame]:
    """Hand a result over in batches of at most ``chunksize`` rows, one partition at a time."""
    if isinstance(chunksize, bool) or not isinstance(chunksize, int) or chunksize <= 0:
        raise ValueError(f"chunksize must be a positive integer, got {chunksize!r}")

    def batches() -> Iterator[pd.DataFrame]:
        rows = df.toLocalIterator(prefetchPartitions=True)
        while batch := list(islice(rows, chunksize)):
            yield pd.DataFrame(batch, columns=df.columns)

    return batches()


def write_output(df: DataFrame, path: str, fmt: str = "parquet", compression: str | None = "snappy", mode: str = "overwrite") -> None:
    """One output: parquet, csv with header, newline-delimited json; any other format is parquet."""
    fmt = (fmt or "parquet").lower()
    writer = df.write.mode(mode)
    if fmt == "csv":
        kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.options(header=True, quote='"', escape='"', **kept).csv(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", "false").json(path)
    else:
        codec = (compression or "").strip().lower()
        writer.option("compression", codec if codec not in ("", "none") else "none").parquet(path)


def write_outputs(df: DataFrame, files: Sequence[Mapping], compression: str | None = "snappy") -> None:
    """Every declared output (path, format) gets the result.

    The plan runs once: several outputs are all written from one staged Parquet copy, never from a
    text format, which loses types.
    """
    if not files:
        raise ValueError("At least one output is required")
    if len(files) > 1:
        df = stage(df, "outputs")
    for f in files:
        write_output(df, f["path"], f.get("format", "parquet"), compression)


def write_fanout(df: DataFrame, paths: Sequence[str], compression: str | None = "snappy") -> None:
    """The same parquet result at several places without computing it again."""
    write_outputs(df, [{"path": p, "format": "parquet"} for p in paths], compression)


def empty_frame(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """No rows, but the declared columns; the writers keep them."""
    return spark.createDataFrame([], schema)


def export_tables(
    tables: Mapping[str, DataFrame],
    dest: str,
    names: Sequence[str] | None = None,
    file_format: str = "parquet",
    max_rows: int | None = None,
    overwrite: bool = True,
    create_dir: bool = True,
) -> list[str]:
    """Write each granted table to ``<dest>/<table>.<format>``; stops at the first failure.

    All checks come before the first write. A table appears complete or not at all: Spark's commit
    protocol moves the files into place only when every task is done.
    """
    wanted = [*tables] if names is None else [*names]
    if denied := [name for name in wanted if name not in tables]:
        raise AccessError(f"Not granted: {', '.join(denied)}")
    if file_format not in EXPORT_FORMATS:
        raise ValueError(f"Exports are written as {' or '.join(EXPORT_FORMATS)}, not as {file_format!r}")
    cap = None if max_rows is None else _positive(max_rows)
    targets = [f"{dest.rstrip('/')}/{_file_stem(name)}.{file_format}" for name in wanted]
    if len(set(targets)) < len(targets):
        raise ValueError(f"Two of these tables would share a file: {', '.join(wanted)}")
    if targets:
        _check_targets(tables[wanted[0]].sparkSession, dest, targets, overwrite, create_dir)
    for name, target in zip(wanted, targets, strict=True):
        write_output(tables[name].limit(cap) if cap else tables[name], target, file_format)
    return targets


def _file_stem(table: str) -> str:
    """A file name for a table: its last path part, with anything unusual as an underscore."""
    last = table.rpartition("/")[2]
    return "".join(ch if ch.isascii() and (ch.isalnum() or ch in "._-") else "_" for ch in last) or "table"


def _check_targets(spark: SparkSession, dest: str, targets: list[str], overwrite: bool, create_dir: bool) -> None:
    if not create_dir and not _exists(spark, dest):
        raise ValueError(f"{dest} does not exist, and create_dir is off")
    there = [] if overwrite else [t for t in targets if _exists(spark, t)]
    if there:
        raise ValueError(f"Already there, and overwrite is off: {', '.join(there)}")


def _positive(n: int) -> int:
    if isinstance(n, bool) or int(n) <= 0:
        raise ValueError("max_rows must be a positive integer or None")
    return int(n)


def _exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)
