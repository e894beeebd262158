import random

import pytest

from cohortflow.operators.carry import asof_join


@pytest.mark.parametrize("hot_rows", [10_000, 30])
def test_asof_against_brute_force(spark, hot_rows):
    rng = random.Random(9)
    keys = ["hot"] * 10 + [f"k{i}" for i in range(8)]
    left = [(i, rng.choice(keys), rng.choice([None, *range(100)])) for i in range(300)]
    right = [(rng.choice(keys), rng.choice([None, *range(100)]), float(i)) for i in range(200)]
    out = asof_join(
        spark.createDataFrame(left, "id int, k string, t int").repartition(3),
        spark.createDataFrame(right, "k string, rt int, v double").repartition(4),
        ["k"], "t", "rt", hot_rows,
    )
    assert out.columns == ["id", "k", "t", "rt", "v"]
    got = {r.id: (r.rt, r.v) for r in out.collect()}
    for i, k, t in left:
        found = [(rt, v) for key, rt, v in right if key == k and rt is not None and t is not None and rt <= t]
        assert got[i] == (max(found) if found else (None, None))


def test_column_clash(spark):
    df = spark.createDataFrame([("a", 1)], "k string, t int")
    with pytest.raises(ValueError, match="both sides"):
        asof_join(df, df, ["k"], "t", "t")
