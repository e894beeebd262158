"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.session import stage

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Tables of at most so many rows (a few short columns each) are broadcast; longer ones are shuffled.
BROADCAST_ROWS = 100_000


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The columns of exactly these names (the first of each), whatever else ``df`` carries.

    Further columns may repeat a name, or differ from it in case only.
    """
    places = [df.columns.index(name) for name in names]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select([F.col(f"c{i}").alias(name) for i, name in zip(places, names, strict=True)])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*parts: Column, seed: str) -> Column:
    """A double in (0, 1) that depends on the values alone; 52 bits of an MD5 sum."""
    key = F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for all ends of the undirected ``edges (a, b)``: the smallest id reachable.

    Large-star and small-star rounds until the stars are stable; every round is written to the shared
    folder, so lineage stays short. Round count grows with the logarithm of a component's diameter.
    """
    both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links = stage(both, name)
    before = None
    while True:
        # Large star: each node's larger neighbours hang on its smallest neighbour.
        ends = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        low = stage(low, name)
        large = ends.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), name)
        # Small star: each node and its smaller neighbours hang on the smallest of them.
        low = stage(large.groupBy("a").agg(F.min("b").alias("m")), name)
        joined = large.join(low, "a")
        links = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        links = stage(links.where("a <> b").distinct(), name)
        state = links.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if before == state:
            break
        before = state
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
