import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortflow.operators import corr
from cohortflow.operators.corr import correlation_report, top_correlations


def frame(spark, pdf):
    rows = [tuple(None if v != v else float(v) for v in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf.columns)).repartition(4)


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(2)
    a = rng.normal(size=400)
    out = pd.DataFrame({"a": a, "b": a + rng.normal(size=400), "c": rng.integers(0, 4, 400).astype(float), "flat": 1.0})
    out["d"] = np.where(rng.random(400) < 0.6, 3.0, -a)
    out.loc[rng.random(400) < 0.2, "b"] = np.nan
    out.loc[rng.random(400) < 0.1, "c"] = np.nan
    return out


def kendall(x, y):
    both = ~(np.isnan(x) | np.isnan(y))
    x, y = x[both], y[both]
    s = n0 = tx = ty = 0
    for i in range(len(x)):
        for j in range(i):
            n0 += 1
            tx += x[i] == x[j]
            ty += y[i] == y[j]
            s += np.sign(x[i] - x[j]) * np.sign(y[i] - y[j])
    return s / math.sqrt((n0 - tx) * (n0 - ty)) if n0 > tx and n0 > ty else None


def average_rank_r(pdf, a, b):
    both = pdf[[a, b]].dropna()
    r = both.rank().corr().loc[a, b]
    return None if r != r else r


def values(report):
    return {(r.column_a, r.column_b): r.correlation for r in report.collect()}


def close(got, want):
    assert got.keys() == want.keys()
    for pair, value in want.items():
        assert (got[pair] is None) == (value is None), pair
        if value is not None:
            assert got[pair] == pytest.approx(value, abs=1.1e-4), pair


def pairs(pdf):
    names = list(pdf.columns)
    return [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]


def test_pearson(spark, pdf):
    want = {}
    for a, b in pairs(pdf):
        r = pdf[a].corr(pdf[b])
        want[a, b] = None if r != r else r
    close(values(correlation_report(frame(spark, pdf))), want)


@pytest.mark.parametrize("chunks", [5, 1])
def test_pearson_in_several_chunks_and_in_one_scan(spark, pdf, monkeypatch, chunks):
    whole = values(correlation_report(frame(spark, pdf)))
    monkeypatch.setattr(corr, "PAIRS_PER_CHUNK", 3)
    monkeypatch.setattr(corr, "MAX_CHUNKS", chunks)
    assert values(correlation_report(frame(spark, pdf))) == whole


@pytest.mark.parametrize("rows_per_bucket", [1000, 25])
def test_spearman(spark, pdf, rows_per_bucket):
    want = {p: average_rank_r(pdf, *p) for p in pairs(pdf)}
    close(values(correlation_report(frame(spark, pdf), "spearman", None, rows_per_bucket)), want)


def test_kendall(spark, pdf):
    want = {(a, b): kendall(pdf[a].to_numpy(), pdf[b].to_numpy()) for a, b in pairs(pdf)}
    close(values(correlation_report(frame(spark, pdf), "kendall")), want)


def test_kendall_cut_into_smaller_groups(spark, pdf, monkeypatch):
    some = pdf[["a", "b", "d"]]
    whole = values(correlation_report(frame(spark, some), "kendall"))
    monkeypatch.setattr(corr, "LEAF_CELLS", 40)
    monkeypatch.setattr(corr, "CUTS", 6)
    assert values(correlation_report(frame(spark, some), "kendall")) == whole


def test_labels_order_and_top(spark):
    rng = random.Random(4)
    xs = [rng.random() for _ in range(50)]
    df = spark.createDataFrame([(x, 2 * x, -x, rng.random()) for x in xs], "w double, x double, y double, z double")
    report = correlation_report(df)
    rows = report.collect()
    assert [abs(r.correlation) for r in rows] == sorted((abs(r.correlation) for r in rows), reverse=True)
    found = {(r.column_a, r.column_b): (r.strength, r.direction) for r in rows}
    assert found["w", "x"] == ("strong", "positive")
    assert found["w", "y"] == ("strong", "negative")
    assert top_correlations(report, 3).count() == 3
    edge = correlation_report(df.select("w", F.lit(1.0).alias("one"))).first()
    assert (edge.correlation, edge.strength, edge.direction) == (None, "weak", "none")


def test_errors(spark):
    df = spark.createDataFrame([(1.0, "x")], "a double, t string")
    with pytest.raises(ValueError, match="at least 2"):
        correlation_report(df)
    with pytest.raises(ValueError, match="Unknown method"):
        correlation_report(df.withColumn("b", F.lit(1)), "phi")


def test_many_columns_against_each_pair(spark):
    """200 columns with gaps, an offset of 1e6 and a flat one; every pair over the rows where both are present."""
    rng = np.random.default_rng(11)
    common = rng.normal(size=(300, 1))
    x = rng.normal(size=(300, 200)) + common * rng.random(200) + np.where(np.arange(200) % 5 == 0, 1e6, 0.0)
    x[:, 7] = 0.1
    x[rng.random(x.shape) < 0.15] = np.nan
    x[:150, 8], x[150:, 9] = np.nan, np.nan  # no row in common
    wide = frame(spark, pd.DataFrame(x, columns=[f"v{i}" for i in range(200)]))
    pairs = [(i, j) for i in range(200) for j in range(i + 1, 200)]
    numbers = wide.toDF(*[f"c{i}" for i in range(200)])
    found = {r["pair"]: r["r"] for r in corr._gram(numbers, pairs).collect()}
    assert len(found) == len(pairs)
    for k, (i, j) in enumerate(pairs):
        both = ~(np.isnan(x[:, i]) | np.isnan(x[:, j]))
        if 7 in (i, j) or not both.any():
            assert found[k] is None
        else:
            assert abs(found[k] - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-9


def test_many_columns_are_not_laid_out_as_pairs(spark):
    names = ", ".join(f"rand({i}) AS v{i}" for i in range(12))
    wide = spark.sql(f"SELECT {names} FROM range(50)")
    plan = correlation_report(wide)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    empty = correlation_report(wide.where("v0 < 0"))
    assert empty.count() == 66 and empty.where("correlation IS NOT NULL").count() == 0


def test_spearman_reads_its_input_once(spark, monkeypatch):
    """Counting, cutting and ranking read a written table, so the scan and the dealing of rows happen once."""
    written, stage = [], corr.stage
    monkeypatch.setattr(corr, "stage", lambda df, name, *more: written.append(name) or stage(df, name, *more))
    df = spark.range(500).selectExpr("cast(id % 7 as double) as a", "cast(id * id % 31 as double) as b", "cast(id as double) as c")
    assert corr.correlation_report(df, "spearman", rows_per_bucket=100).count() == 3
    assert written == ["numbers", "cells"]
