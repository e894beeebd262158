import numpy as np
import pandas as pd
import pytest

from cohortflow.operators.cluster import cluster_patients, instrument_scores, range_scores

SCHEMA = (
    "person_id long, measurement_id long, measurement_source_value string, value_as_number double, "
    "range_low double, range_high double"
)
NAMES = ["ham_d_a", "ham_d_b", "psqi_x", "psqi_cumulative", "cdr_sum"]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    out, m = [], 0
    for person in range(60):
        level = [0.0, 10.0, 30.0][person % 3]
        for k, name in enumerate(NAMES):
            if rng.random() < 0.1:
                continue
            for _ in range(rng.integers(1, 3)):
                value = float(level + k + rng.normal())
                low, high = (None, None) if name == "cdr_sum" else (5.0, 20.0 if k else 0.0)
                out.append((person, m, name, value, low, high))
                m += 1
    out.append((99, m, "psqi_x", None, 1.0, 2.0))  # no value at all
    out.append((0, None, "psqi_x", None, None, None))
    out.append((1, m + 1, "never", None, None, None))
    return out


@pytest.fixture(scope="module")
def pdf(rows):
    return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def pivot(pdf):
    return pdf.pivot_table(index="person_id", columns="measurement_source_value", values="value_as_number", aggfunc="mean")


def brute_range(pdf):
    d = pdf[pdf.range_low.notna() & pdf.range_high.notna()]
    above = ((d.value_as_number - d.range_high) / d.range_high.replace(0, np.nan)).clip(lower=0).fillna(0)
    below = ((d.range_low - d.value_as_number) / d.range_low.replace(0, np.nan)).clip(lower=0).fillna(0)
    g = pd.DataFrame({"p": d.person_id, "a": above, "b": below, "o": (above > 0) | (below > 0)}).groupby("p").sum()
    return {p: (round(r.a * 100, 2), round(r.b * 100, 2), int(r.o)) for p, r in g.iterrows()}


def test_range_scores(df, pdf):
    want = brute_range(pdf)
    got = {r.person_id: tuple(r)[1:] for r in range_scores(df).collect()}
    assert got.keys() == set(pdf.person_id)
    for person, scores in got.items():
        assert scores == pytest.approx(want.get(person, (0, 0, 0)), abs=0.011)


def test_no_limits_gives_zeros(spark):
    df = spark.createDataFrame([(1, 1, "a", 3.0, None, None)], SCHEMA)
    assert tuple(range_scores(df).first()) == (1, 0.0, 0.0, 0)
    zero = spark.createDataFrame([(1, 1, "a", 3.0, 4.0, 0.0)], SCHEMA)
    assert tuple(range_scores(zero).first()) == (1, 0.0, 25.0, 1)
    negative = spark.createDataFrame([(1, 1, "a", -30.0, -40.0, -20.0)], SCHEMA)
    assert tuple(range_scores(negative).first()) == (1, 50.0, 25.0, 1)


def test_instrument_scores(df, pivot):
    got = {r.person_id: r for r in instrument_scores(df).collect()}
    assert got.keys() == set(pivot.index)
    for person, row in pivot.iterrows():
        assert got[person].ham_d_total == pytest.approx(row[["ham_d_a", "ham_d_b"]].sum(), abs=0.006)
        assert got[person].psqi_total == pytest.approx(np.nansum([row["psqi_x"]]), abs=0.006)
        cdr = got[person].cdr_score
        assert (cdr is None) == np.isnan(row["cdr_sum"])
        assert cdr is None or cdr == pytest.approx(row["cdr_sum"], abs=0.006)


def standardised(pivot):
    x = pivot.fillna(pivot.mean()).to_numpy()
    return (x - x.mean(axis=0)) / x.std(axis=0)


@pytest.mark.parametrize("algorithm", ["kmeans", "agglomerative", "spectral"])
def test_planted_groups_are_found(df, pivot, pdf, algorithm):
    out = cluster_patients(df, 3, algorithm, "range", restarts=3)
    rows = {r.person_id: r for r in out.patients.collect()}
    assert rows.keys() == set(pivot.index)
    groups = {g: {rows[p].cluster for p in pivot.index if p % 3 == g} for g in range(3)}
    assert all(len(found) == 1 for found in groups.values())
    assert len(set.union(*groups.values())) == 3
    want = brute_range(pdf)
    means = {g: np.mean([want[p][2] + want[p][0] / 100 for p in pivot.index if p % 3 == g]) for g in range(3)}
    ranked = sorted(means, key=means.get)
    for g, label in zip(ranked, ("Low Risk", "Moderate Risk", "High Risk")):
        assert {rows[p].cluster_label for p in pivot.index if p % 3 == g} == {label}
    counted = pdf.groupby("person_id").measurement_id.count()
    assert all(rows[p].num_measurements == counted[p] for p in pivot.index)
    assert out.patients.columns == [
        "person_id", "pca_x", "pca_y", "cluster", "cluster_label",
        "abnormality_score", "deficiency_score", "out_of_range_count", "num_measurements",
    ]
    assert sorted(r.n for r in out.sizes.collect()) == [20, 20, 20]


def test_projection(df, pivot):
    out = cluster_patients(df, 2, "kmeans", "instrument", restarts=1)
    z = standardised(pivot)
    _, s, vt = np.linalg.svd(z - z.mean(axis=0), full_matrices=False)
    vt = vt * np.sign(vt[np.arange(len(vt)), np.abs(vt).argmax(axis=1)])[:, None]
    xy = z @ vt[:2].T
    rows = {r.person_id: r for r in out.patients.collect()}
    for i, person in enumerate(pivot.index):
        assert (rows[person].pca_x, rows[person].pca_y) == pytest.approx(tuple(xy[i]), abs=1e-4)
    assert out.explained_variance == pytest.approx(tuple((s**2 / (s**2).sum())[:2]), abs=1e-9)
    assert {r.cluster_label for r in rows.values()} == {"Cluster 0", "Cluster 1"}
    by_label = pd.DataFrame([(r.cluster_label, r.ham_d_total) for r in rows.values()]).groupby(0)[1].mean()
    assert by_label["Cluster 0"] < by_label["Cluster 1"]


def test_no_limit_broken_falls_back_to_the_standardised_mean(spark, rows, pivot):
    df = spark.createDataFrame([r[:4] + (None, None) for r in rows], SCHEMA)
    out = cluster_patients(df, 3, restarts=2)
    labels = {r.person_id: r.cluster_label for r in out.patients.collect()}
    for g, label in enumerate(("Low Risk", "Moderate Risk", "High Risk")):
        assert {labels[p] for p in pivot.index if p % 3 == g} == {label}


def test_errors(df):
    for bad in ({"algorithm": "dbscan"}, {"scoring": "x"}, {"n_clusters": 0}):
        with pytest.raises(ValueError):
            cluster_patients(df, **bad)
    with pytest.raises(ValueError, match="range_low"):
        cluster_patients(df.drop("range_low"))
    with pytest.raises(ValueError, match="measurement_id"):
        cluster_patients(df.drop("measurement_id"), scoring="instrument")
