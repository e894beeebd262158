import numpy as np
import pytest

from cohortflow.operators import cluster, spectral


def _rings(n, seed):
    """Two rings around one centre, which no straight line parts; every third point is on the inner one."""
    rng = np.random.default_rng(seed)
    angle = rng.uniform(0, 2 * np.pi, n)
    radius = np.where(np.arange(n) % 3 == 0, 1.0, 4.0) + rng.normal(0, 0.08, n)
    return np.stack([radius * np.cos(angle), radius * np.sin(angle)], axis=1)


def _points(spark, x):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "person_id long, z array<double>").repartition(4)


def test_nearest_graph_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spectral, "GROUP_NODES", 300)
    monkeypatch.setattr(spectral, "BLOCK_NODES", 100)
    x = np.random.default_rng(1).normal(size=(1_500, 4))
    nodes = _points(spark, x).select("z", "person_id").toDF("z", "node")
    gaps = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(gaps, np.inf)
    true = [set(row[:10].tolist()) for row in np.argsort(gaps, axis=1)]
    edges = spectral.nearest_graph(nodes, len(x)).collect()
    weight = {(r["a"], r["b"]): r["w"] for r in edges}
    assert all(weight[b, a] == w and w in (0.5, 1.0) for (a, b), w in weight.items())
    found = sum(w * 2 for w in weight.values()) / 2  # every directed neighbour counts once
    assert found == len(x) * 10
    hit = sum((a, b) in weight for a in range(len(x)) for b in true[a])
    assert hit >= 0.85 * len(x) * 10


@pytest.mark.parametrize(("n", "coarse", "group"), [(900, 60, 200), (300, 400, 4_000)])
def test_rings_that_k_means_cannot_part(spark, monkeypatch, n, coarse, group):
    monkeypatch.setattr(spectral, "COARSE", coarse)
    monkeypatch.setattr(spectral, "GROUP_NODES", group)
    monkeypatch.setattr(spectral, "BLOCK_NODES", 128)
    x = _rings(n, 3)
    measured = [
        (i, 10 * i + j, f"m{j}", float(v), None, None) for i, row in enumerate(x) for j, v in enumerate(row)
    ]
    schema = (
        "person_id long, measurement_id long, measurement_source_value string, value_as_number double, "
        "range_low double, range_high double"
    )
    df = spark.createDataFrame(measured, schema)
    sides = {}
    for algorithm in ("spectral", "kmeans"):
        out = cluster.cluster_patients(df, 2, algorithm, restarts=2).patients
        sides[algorithm] = [r["cluster"] for r in out.select("person_id", "cluster").orderBy("person_id").collect()]
    inner = np.arange(n) % 3 == 0
    parted = {a: abs(np.corrcoef(inner, np.array(c))[0, 1]) for a, c in sides.items()}
    assert parted["spectral"] == pytest.approx(1.0) and parted["kmeans"] < 0.5


def test_equal_points_and_few_points(spark):
    x = np.array([[0.0, 0.0]] * 50 + [[9.0, 9.0]] * 40 + [[5.0, -5.0]])
    for k in (3, 5):
        found, columns = spectral.embedding(_points(spark, x), k)
        rows = found.collect()
        assert len(rows) == 3 and len(columns) == k
        assert len({tuple(r[c] for c in columns) for r in rows}) == 3


def test_many_components(spark, monkeypatch):
    """More components than the coarsest graph has nodes."""
    monkeypatch.setattr(spectral, "COARSE", 6)
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(20, 2)) * 1_000, 12, axis=0) + rng.normal(size=(240, 2))
    found, columns = spectral.embedding(_points(spark, x), 3)
    assert found.count() == 240 and found.where("isnan(e0) OR e0 IS NULL").count() == 0
