import pytest
from pyspark.sql import functions as F

from cohortflow.operators import prep
from cohortflow.operators.prep import label_encode
from cohortflow.operators.relational import pivot_fields, pivot_values
from cohortflow.operators.skew import lookup, ordered_pieces, profile_keys, split_hot
from cohortflow.session import clear_staged, stage


@pytest.fixture(scope="module")
def rows(spark):
    hot = F.when(F.col("id") < 300, "hot").when(F.col("id") < 310, None)
    return spark.range(900).select("id", hot.otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k")).repartition(6)


def test_profile(rows):
    plain = profile_keys(rows, ["k"])
    assert (plain.rows, plain.missing, plain.hot) == (900, 10, None)
    split = profile_keys(rows, ["k"], hot_rows=100)
    assert [tuple(r) for r in split.hot.collect()] == [("hot",)]
    assert (split.hot_rows, split.pieces) == (300, 6)
    hot, cold = split_hot(rows, ["k"], split.hot)
    assert (hot.count(), cold.count()) == (300, 600)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_gives_the_plain_join(spark, rows, how):
    table = spark.createDataFrame([("hot", 1), ("k3", 2), (None, 3), ("other", 4)], "k string, v int")
    want = sorted(map(str, rows.join(table, ["k"], how).collect()))
    assert sorted(map(str, lookup(rows, table, ["k"], how, hot_rows=100).collect())) == want


def test_large_dictionary_with_a_hot_value(rows, monkeypatch):
    want = sorted(map(str, label_encode(rows, "k").collect()))
    monkeypatch.setattr(prep, "BROADCAST_ENTRIES", 5)
    assert sorted(map(str, label_encode(rows, "k", hot_rows=100).collect())) == want


def test_pieces_are_contiguous_and_spread_copies(spark):
    same = spark.range(400).select(F.lit("p").alias("p"), F.lit(1).alias("t")).repartition(4)
    cut = ordered_pieces(same, [F.col("p"), F.col("t")], 4)
    sizes = [r["count"] for r in cut.groupBy("_piece").count().collect()]
    assert len(sizes) >= 3 and sum(sizes) == 400 and max(sizes) <= 250
    mixed = spark.range(400).select(F.lit("p").alias("p"), (F.col("id") * 7 % 400).alias("t"))
    bounds = ordered_pieces(mixed, [F.col("p"), F.col("t")], 4).groupBy("_piece").agg(F.min("t"), F.max("t"))
    edges = [tuple(r)[1:] for r in bounds.orderBy("_piece").collect()]
    assert all(a[1] < b[0] for a, b in zip(edges, edges[1:]))


def test_staged_tables_can_be_cleared(spark, rows):
    staged = stage(rows, "rows")
    path = staged.inputFiles()[0].removeprefix("file:").removeprefix("//")
    assert staged.count() == 900
    clear_staged(spark)
    with pytest.raises(FileNotFoundError):
        open(path)


def test_pivot_limit_is_checked(spark, rows):
    assert pivot_fields(rows, "k")[:2] == ["hot", "k0"]
    wide = pivot_values(rows, ["id"], "k", "id", ["hot", "k3"])
    assert wide.columns == ["id", "hot", "k3"]
    spark.conf.set("spark.sql.pivotMaxValues", "10")
    try:
        with pytest.raises(ValueError, match="pivot"):
            pivot_fields(rows, "k")
        with pytest.raises(ValueError, match="pivot"):
            pivot_values(rows, ["id"], "k", "id", [f"k{i}" for i in range(11)])
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
