import numpy as np
import pandas as pd
import pytest

from cohortflow.operators.outlier import removal_report, remove_outliers


def frame(spark, pdf):
    rows = [tuple(None if v is None or v != v else float(v) for v in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf.columns))


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(1)
    out = pd.DataFrame({"id": np.arange(300.0), "a": rng.normal(size=300), "b": rng.normal(size=300), "flat": 1.0})
    out.loc[7, "a"] = 40.0
    out.loc[9, "b"] = np.nan
    return out


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("direct_rows", [1000, 50])
@pytest.mark.parametrize("reach", [None, 0.5])
def test_quartile_fences(spark, pdf, reach, direct_rows):
    keep = pd.Series(True, index=pdf.index)
    for c in ("a", "b", "flat"):
        q1, q3 = pdf[c].quantile(0.25), pdf[c].quantile(0.75)
        m = reach or 1.5
        keep &= pdf[c].between(q1 - m * (q3 - q1), q3 + m * (q3 - q1))
    out = remove_outliers(frame(spark, pdf), "iqr", "a,b,flat", reach, direct_rows)
    assert ids(out) == pdf.id[keep].tolist()


def test_zscore(spark, pdf):
    keep = pd.Series(True, index=pdf.index)
    for c in ("a", "b"):
        keep &= ((pdf[c] - pdf[c].mean()) / pdf[c].std()).abs() <= 2
    out = remove_outliers(frame(spark, pdf), "zscore", ["a", "b", "flat"], "2")
    assert ids(out) == pdf.id[keep].tolist()
    one = frame(spark, pdf.head(1))
    assert remove_outliers(one, "zscore", "a").count() == 0


@pytest.mark.parametrize("direct_rows", [10_000, 100])
def test_isolation_forest_drops_the_share_and_finds_the_planted_row(spark, pdf, direct_rows):
    df = frame(spark, pdf.dropna())
    out = remove_outliers(df, "isolation_forest", "a,b", 0.1, direct_rows)
    kept = ids(out)
    assert 0.85 * 299 <= len(kept) <= 0.92 * 299
    assert 7.0 not in kept
    extremes = pdf.dropna().assign(r=lambda d: d.a**2 + d.b**2)
    dropped = extremes[~extremes.id.isin(kept)]
    assert dropped.r.mean() > 3 * extremes[extremes.id.isin(kept)].r.mean()


def test_isolation_forest_checks(spark, pdf):
    df = frame(spark, pdf)
    for share in (0, 0.5, -1):
        with pytest.raises(ValueError, match="share to drop"):
            remove_outliers(df, "isolation_forest", "a", share)
    with pytest.raises(ValueError, match="no gaps"):
        remove_outliers(df, "isolation_forest", "b")
    with pytest.raises(ValueError, match="Unknown method"):
        remove_outliers(df, "lof", "a")


def test_report(spark, pdf):
    df = frame(spark, pdf)
    row = removal_report(df, remove_outliers(df, "zscore", "a")).first()
    assert (row.rows_before, row.rows_after, row.rows_removed) == (300, 299, 1)
    assert row.percent_removed == pytest.approx(100 / 300)
    assert removal_report(df.filter("id < 0"), df.filter("id < 0")).first().percent_removed == 0


def test_isolation_forest_does_not_depend_on_partitions(spark):
    rows = [(i, float(i * i % 101), float(i % 37)) for i in range(3000)] + [(9000 + i, 50.0, 20.0) for i in range(1500)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    kept = [
        sorted(r.id for r in remove_outliers(df.repartition(n), "isolation_forest", "a,b", 0.1).collect())
        for n in (2, 7)
    ]
    assert kept[0] == kept[1] and len(kept[0]) < len(rows)
