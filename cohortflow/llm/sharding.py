"""Sharding along a Hilbert curve over document metadata.

Source, language and size are quantised into 16 equally filled levels each, which gives at most 4,096
cells. The cells are put in the order of a Hilbert curve, rows are numbered along it, and the numbering
is cut into runs of equal row counts. A reader that filters on any of the dimensions then meets its
rows in few shards, and the minima and maxima in the files of a shard are narrow.

Rows are never sorted as a whole: a cell is cut into buckets by a hash of the id, as many as its row
count asks for, buckets are counted, and a row's number is the rows of the buckets ahead plus its place
in its bucket. So a source that holds a third of all rows is spread like the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.llm.common import pick, read, small
from cohortflow.session import stage

SHARDS = 8
BITS = 4
#: Rows of a bucket: a thousandth of the table, but no more than this.
BUCKET_ROWS = 50_000


def hilbert_index(levels: Sequence[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of the point with these levels, each in [0, 2**bits).

    Skilling's transform ("Programming the Hilbert curve", 2004) as folds over bit masks.
    """
    n = len(levels)
    start = F.array([x.cast("int") for x in levels])
    turns = [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(n)]

    def turn(point: Column, step: Column) -> Column:
        mask, i = step["mask"], step["i"]
        low = mask - 1
        set_bit = F.element_at(point, i + 1).bitwiseAND(mask) != 0
        swap = F.element_at(point, 1).bitwiseXOR(F.element_at(point, i + 1)).bitwiseAND(low)
        flipped = F.transform(point, lambda v, k: F.when(k == 0, v.bitwiseXOR(low)).otherwise(v))
        swapped = F.transform(point, lambda v, k: F.when((k == 0) | (k == i), v.bitwiseXOR(swap)).otherwise(v))
        return F.when(set_bit, flipped).when(i == 0, point).otherwise(swapped)

    steps = F.array([F.struct(F.lit(m).alias("mask"), F.lit(i).alias("i")) for m, i in turns])
    point = F.aggregate(steps, start, turn) if turns else start
    chain = F.array([F.lit(i) for i in range(2, n + 1)])
    gray = F.aggregate(
        chain,
        point,
        lambda p, i: F.transform(
            p, lambda v, k: F.when(k == i - 1, v.bitwiseXOR(F.element_at(p, i - 1))).otherwise(v)
        ),
    )
    last = F.element_at(gray, n)
    fix = F.lit(0)
    for b in range(bits - 1, 0, -1):
        fix = fix.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(0))
    point = F.transform(gray, lambda v: v.bitwiseXOR(fix))
    bit = [F.struct(F.lit(1 << b).alias("mask"), F.lit(i + 1).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)]
    return F.aggregate(
        F.array(bit),
        F.lit(0).cast("long"),
        lambda index, at: index * 2 + (F.element_at(point, at["i"]).bitwiseAND(at["mask"]) != 0).cast("long"),
    )


def levels(rows: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """``value, level`` for every value of a metadata column: equally filled levels in value order.

    A value that holds many rows takes the level of its middle row. Null is a value of its own, the
    last one. The column must be a metadata column: one row per different value is ordered in one task.
    """
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(W.orderBy(F.col("value").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0))
    middle = (upto - F.col("n") / 2) / F.sum("n").over(W.partitionBy())
    return counts.select("value", F.floor(middle * (1 << bits)).cast("int").alias("level"))


def shards(docs: DataFrame, count: int = SHARDS, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, size, text_crc32, source, lang, shard, slot`` per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1. Shards are runs of the curve whose row counts differ by
    one at most; ``slot`` numbers a shard's rows without gaps. Null texts have size 1 and the checksum
    of an empty text; null languages and sources are the last level. Repeated rows get slots of their
    own. With fewer rows than shards some shards stay empty; an empty table gives an empty result. The
    columns in ``keep`` stay beside these.
    """
    text = F.coalesce("text", F.lit(""))
    rows = pick(docs, "doc_id", "source", "lang", "text", *keep).select(
        *keep,
        "doc_id",
        "source",
        "lang",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    rows = stage(rows, "shard-rows")
    # An eighth of a doubling: some 250 values at most, whatever the sizes are.
    rows = rows.withColumn("magnitude", F.floor(F.log2("size") * 8).cast("int"))
    total = rows.count()
    names = ("source", "lang", "magnitude")
    tables = {name: stage(levels(rows, name), f"shard-{name}") for name in names}
    placed = rows
    for name, table in tables.items():
        values = table.select(F.col("value").alias(f"{name}_value"), F.col("level").alias(f"{name}_level"))
        values = small(values, table.count())
        placed = placed.join(values, F.col(name).eqNullSafe(F.col(f"{name}_value"))).drop(f"{name}_value")
    at = [f"{name}_level" for name in names]
    per_bucket = max(1, min(BUCKET_ROWS, total // 1024))
    cells = placed.groupBy(*at).agg(F.count(F.lit(1)).alias("held"))
    cells = cells.select(
        hilbert_index([F.col(c) for c in at]).alias("cell"),
        *at,
        F.ceil(F.col("held") / per_bucket).cast("int").alias("buckets"),
    )
    cells = F.broadcast(stage(cells, "shard-cells"))  # 16 ** 3 rows at most
    hashed = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("buckets")).cast("int")
    placed = placed.join(cells, at).withColumn("bucket", hashed).drop(*at)
    held = placed.groupBy("cell", "bucket").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(W.orderBy("cell", "bucket").rowsBetween(W.unboundedPreceding, 0))
    ahead = stage(held.select("cell", "bucket", (upto - F.col("n")).alias("ahead")), "shard-buckets")
    place = F.row_number().over(W.partitionBy("cell", "bucket").orderBy("doc_id", "text_crc32", "size"))
    numbered = placed.withColumn("place", place).join(small(ahead, ahead.count()), ["cell", "bucket"])
    number = F.col("ahead") + F.col("place") - 1
    numbered = numbered.withColumn("number", number).withColumn("shard", F.expr(f"(number * {count}) div {max(total, 1)}"))
    first = F.expr(f"(shard * {total} + {count - 1}) div {count}")
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        "source",
        "lang",
        F.col("shard").cast("int").alias("shard"),
        (F.col("number") - first).cast("long").alias("slot"),
        *keep,
    )


def write_shards(docs: DataFrame, path: str, count: int = SHARDS) -> None:
    """The rows of ``docs`` under ``path/shard=K/``, each shard in slot order.

    Every row is written once, repeated ids and rows too. A column that is named like the folder, or
    like an earlier column (case aside), gets an underscore for each such name before it.
    """
    names: list[str] = []
    for name in docs.columns:
        while name.lower() in {"shard", *(n.lower() for n in names)}:
            name += "_"
        names.append(name)
    given = F.struct(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)])
    whole = docs.toDF(*[f"c{i}" for i in range(len(names))]).select(given.alias("given"))
    own = {c: F.col("given").getField(names[docs.columns.index(c)]).alias(c) for c in ("doc_id", "text", "source", "lang")}
    placed = shards(whole.select(*own.values(), "given"), count, ["given"])
    ordered = placed.select("given", "shard", "slot").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.select("given.*", "shard").write.partitionBy("shard").parquet(path)


def op9_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight runs of the curve, under the law that row counts are at most one apart."""
    return shards(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
