import numpy as np
import pandas as pd
import pytest

from cohortflow.operators.prep import encoding_map, label_encode, scale
from cohortflow.operators.ranking import dense_index, exact_quantiles
from cohortflow.operators.relational import resolve_numeric, union_widen

ROWS = [
    (1, 20.0, 10.0, 5.0, True, "female"),
    (2, 30.0, None, 5.0, False, "male"),
    (3, None, 30.0, 5.0, True, None),
    (4, 50.0, 70.0, 5.0, None, "Male"),
    (5, float("nan"), 10.0, 5.0, True, "female"),
]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(ROWS, "id long, age double, salary double, constant double, flag boolean, gender string")


def column(df, name):
    return [r[0] for r in df.orderBy("id").select(name).collect()]


def test_resolve_numeric(people):
    assert resolve_numeric(people) == ["id", "age", "salary", "constant"]
    assert resolve_numeric(people, " age, salary ,") == ["age", "salary"]
    for bad in ("nope", "gender", "flag"):
        with pytest.raises(ValueError, match=bad):
            resolve_numeric(people, bad)
    with pytest.raises(ValueError, match="No numeric"):
        resolve_numeric(people.select("gender"))


def test_standard_scaling_uses_population_std(people):
    out = scale(people, "standard", "age,constant")
    ages = np.array([20.0, 30.0, 50.0])
    z = (ages - ages.mean()) / ages.std()
    assert column(out, "age") == pytest.approx([z[0], z[1], None, z[2], None])
    assert column(out, "constant") == [0.0] * 5
    assert column(out, "salary") == [10.0, None, 30.0, 70.0, 10.0]


def test_minmax_scaling(people):
    out = scale(people, "minmax", ["salary", "constant"])
    assert column(out, "salary") == pytest.approx([0.0, None, 1 / 3, 1.0, 0.0])
    assert column(out, "constant") == [0.0] * 5
    with pytest.raises(ValueError, match="method"):
        scale(people, "robust")


def test_label_encoding(people):
    out = label_encode(people, "gender, flag")
    assert column(out, "gender_encoded") == [2, 3, 1, 0, 2]
    assert column(out, "flag_encoded") == [1, 0, 1, 2, 1]
    assert "gender" not in label_encode(people, ["gender"], keep_original=False).columns
    got = [(r.value, r.label) for r in encoding_map(people, "gender").orderBy("label").collect()]
    assert got == [("Male", 0), ("__missing__", 1), ("female", 2), ("male", 3)]
    for bad in ("", "nope"):
        with pytest.raises(ValueError):
            label_encode(people, bad)


def test_dense_index_in_pieces(spark):
    df = spark.range(500).selectExpr("concat('v', id * 7) as v").repartition(5)
    whole, n = dense_index(df, "v", "i")
    pieces, m = dense_index(df, "v", "i", per_piece=60)
    assert n == m == 500
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, pieces.select("v", "i").collect()))


@pytest.mark.parametrize("direct_rows", [10_000, 100])
def test_exact_quantiles(spark, direct_rows):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.normal(size=4000), "b": np.r_[np.full(3000, 2.0), rng.normal(size=1000)]})
    pdf["c"] = np.where(rng.random(4000) < 0.3, None, pdf["a"] * 3)
    pdf["d"] = None
    df = spark.createDataFrame(
        list(pdf.astype(object).where(pdf.notna(), None).itertuples(index=False, name=None)),
        "a double, b double, c double, d double",
    ).repartition(6)
    got = exact_quantiles(df, ["a", "b", "c", "d"], [0.0, 0.25, 0.5, 0.9, 1.0], direct_rows)
    for c in "abc":
        want = pdf[c].dropna().astype(float).quantile([0.0, 0.25, 0.5, 0.9, 1.0]).tolist()
        assert got[c] == pytest.approx(want, rel=1e-12)
    assert got["d"] == [None] * 5


def test_union_widen(spark):
    a = spark.createDataFrame([("x", 1.5, 1)], "k string, v double, i int")
    b = spark.createDataFrame([("y", "text", 2)], "k string, v string, i bigint")
    out = union_widen([a, b, spark.createDataFrame([("z",)], "k string")])
    assert dict(out.dtypes) == {"k": "string", "v": "string", "i": "bigint"}
    assert sorted(map(tuple, out.collect())) == [("x", "1.5", 1), ("y", "text", 2), ("z", None, None)]


def test_float_labels_follow_pythons_spelling(spark):
    values = [1e7, 2.5, 0.0005, 123456789.0, -1e7, 1e15, 1e16, 1.5e16, 1e-4, 1.25e-5, 9.999e-4, 1e22, 123456.789, 0.0, -0.0]
    values += [12345678.5, 3e-10, 1e100, 1.0, 100.0, 0.001]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["value"] for r in encoding_map(df, "v").collect()}
    assert got == {str(v) for v in values}
    codes = {r["value"]: r["label"] for r in encoding_map(df, "v").collect()}
    assert [codes[t] for t in sorted(codes)] == list(range(len(codes)))


def test_union_of_dates_timestamps_and_decimals(spark):
    a = spark.sql("SELECT DATE '2024-01-02' AS at, CAST(1.5 AS DECIMAL(5,2)) AS price")
    b = spark.sql("SELECT TIMESTAMP '2024-01-02 03:04:05' AS at, CAST(2.125 AS DECIMAL(10,3)) AS price")
    out = union_widen([a, b])
    assert dict(out.dtypes) == {"at": "timestamp", "price": "decimal(10,3)"}
    assert sorted(str(r["price"]) for r in out.collect()) == ["1.500", "2.125"]
