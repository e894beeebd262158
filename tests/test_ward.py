import numpy as np
import pytest

from cohortflow.operators import spectral, ward


def _points(spark, x):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "person_id long, z array<double>").repartition(4)


def _same(one, other):
    """Share of points on which the best pairing of two groupings agrees; pairs are taken by size."""
    table = np.zeros((max(one) + 1, max(other) + 1))
    np.add.at(table, (one, other), 1)
    return table.max(axis=1).sum() / len(one)


def _got(spark, x, k):
    found = {tuple(r["z"]): r["cluster"] for r in ward.labels(_points(spark, x), k).collect()}
    return np.array([found[tuple(row)] for row in x])


@pytest.mark.parametrize("k", [2, 5, 9])
def test_rounds_equal_brute_force(spark, monkeypatch, k):
    """No neighbour is missed here, so every merge is Ward's; far pairs wait for the end."""
    monkeypatch.setattr(ward, "LAST", 40)
    monkeypatch.setattr(spectral, "BLOCK_NODES", 1_000)
    rng = np.random.default_rng(k)
    x = np.round(rng.normal(size=(400, 3)) + 3 * rng.integers(0, 3, size=(400, 1)), 3)
    x = np.concatenate([x, x[:40], [[90.0, 90.0, 90.0], [95.0, 90.0, 90.0], [-80.0, 0.0, 0.0], [-80.0, 7.0, 0.0]]])
    want = ward.greedy(x, np.ones(len(x)), k)
    got = _got(spark, x, k)
    assert len(set(got)) == k and _same(got, want) == 1.0 and _same(want, got) == 1.0


def test_trees_and_groups_agree_on_two_thousand_points(spark, monkeypatch):
    monkeypatch.setattr(ward, "LAST", 300)
    monkeypatch.setattr(spectral, "GROUP_NODES", 600)
    monkeypatch.setattr(spectral, "BLOCK_NODES", 200)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(5, 4)) * 6
    x = centres[rng.integers(0, 5, 2_000)] + rng.normal(size=(2_000, 4))
    assert _same(_got(spark, x, 5), ward.greedy(x, np.ones(len(x)), 5)) >= 0.99


@pytest.mark.parametrize(("width", "digits"), [(3, 6), (12, 6), (2, 1)])
def test_a_round_misses_no_nearest_group(spark, monkeypatch, width, digits):
    """Against all pairs: other weights, far points and (rounded) equal gaps; small leaves and blocks."""
    monkeypatch.setattr(spectral, "GROUP_NODES", 100)
    monkeypatch.setattr(spectral, "BLOCK_NODES", 30)
    rng = np.random.default_rng(width)
    x = np.unique(np.round(rng.normal(size=(1_500, width)) * rng.choice([1.0, 1.0, 8.0], (1_500, 1)), digits), axis=0)
    n = rng.choice([1.0, 2.0, 40.0], len(x))
    rows = [(i, [float(v) for v in row], float(w)) for i, (row, w) in enumerate(zip(x, n, strict=True))]
    groups = spark.createDataFrame(rows, "node long, z array<double>, n double").repartition(4)
    got = {(r["a"], r["b"]) for r in ward._mutual(groups, len(x), 3).collect()}
    cost = n[:, None] * n / (n[:, None] + n) * ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(cost, np.inf)
    near = cost.argmin(axis=1)  # of equal ones the lowest id
    least = cost[np.arange(len(x)), near]
    limit = max(least[a] for a, _ in got)
    assert got == {(a, int(b)) for a, b in enumerate(near) if near[b] == a < b and least[a] <= limit}
    assert 0.70 <= (least <= limit).mean() <= 0.78


def test_neither_leaves_nor_the_end_change_the_result(spark, monkeypatch):
    """Points without groups, where every missed neighbour shows in the cut; some of them come twice."""
    x = np.random.default_rng(7).normal(size=(1_200, 5))
    x = np.concatenate([x, x[:200]])
    want = ward.greedy(*(v.astype(float) for v in np.unique(x, axis=0, return_counts=True)), 3)
    want = dict(zip(map(tuple, np.unique(x, axis=0)), want.tolist(), strict=True))
    want = np.array([want[tuple(row)] for row in x])
    for last, leaf, block in ((4_000, 4_000, 256), (300, 120, 40)):
        monkeypatch.setattr(ward, "LAST", last)
        monkeypatch.setattr(spectral, "GROUP_NODES", leaf)
        monkeypatch.setattr(spectral, "BLOCK_NODES", block)
        got = _got(spark, x, 3)
        assert _same(got, want) == _same(want, got) == 1.0


@pytest.mark.parametrize("rows", [[0], [3, 5], [29], list(range(30))])
def test_values_without_distance_go_as_one_pair_at_a_time(spark, monkeypatch, rows):
    x = np.random.default_rng(3).normal(size=(30, 2))
    x[rows, 1] = np.nan
    nodes = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "node long, z array<double>")
    for k in (1, 2, 4):
        got = {r["node"]: r["cluster"] for r in ward._in_order(nodes, rows[0], k).collect()}
        assert [got[i] for i in range(30)] == ward.greedy(x, np.ones(30), k).tolist()
    monkeypatch.setattr(ward, "LAST", 10)
    assert ward.labels(_points(spark, x), 2).select("cluster").distinct().count() == 2


def test_cut_parts_evenly():
    """The widest coordinate has one value in most rows, the next one in half of them; the third parts in the middle."""
    x = np.zeros((100, 3))
    x[:5, 0], x[:30, 1], x[:, 2] = 1_000.0, 50.0, np.arange(100) / 100
    dim, cut = ward._cut(x)
    assert dim == 2 and (x[:, 2] > cut).sum() == 50
    assert ward._cut(np.zeros((4, 2)))[1] == np.inf
    assert ward._cut(np.array([[0.0], [5.0], [5.0], [5.0]])) == (0, 0.0)


def test_equal_costs_and_few_points(spark, monkeypatch):
    monkeypatch.setattr(ward, "LAST", 10)
    grid = np.array([[float(i), float(j)] for i in range(12) for j in range(12)])  # every gap is a tie
    assert len(set(_got(spark, grid, 2))) == 2
    assert sorted(_got(spark, np.array([[1.0, 1.0], [1.0, 1.0], [2.0, 2.0]]), 3).tolist()) == [0, 0, 1]


def test_four_thousand_points_take_no_round(spark, monkeypatch):
    """Up to LAST groups every merge is Ward's; beyond the former 1,000 the trees missed some."""
    monkeypatch.setattr(ward, "_mutual", None)
    x = np.random.default_rng(1).normal(size=(3_000, 3))
    want = ward.greedy(x, np.ones(len(x)), 3)
    assert _same(_got(spark, x, 3), want) == 1.0


def test_one_pair_at_a_time_equals_the_plain_search():
    x = np.round(np.random.default_rng(2).normal(size=(150, 2)), 1)  # with ties
    weights, sets = np.ones(len(x)), [{i} for i in range(len(x))]
    centres = x.copy()
    while len(sets) > 4:
        gap = ((centres[:, None] - centres[None]) ** 2).sum(axis=2)
        cost = weights[:, None] * weights / (weights[:, None] + weights) * gap
        np.fill_diagonal(cost, np.inf)
        a, b = sorted(np.unravel_index(np.argmin(cost), cost.shape))
        centres[a] = (centres[a] * weights[a] + centres[b] * weights[b]) / (weights[a] + weights[b])
        weights[a] += weights[b]
        sets[a] |= sets.pop(b)
        centres, weights = np.delete(centres, b, 0), np.delete(weights, b)
    found = ward.greedy(x, np.ones(len(x)), 4)
    assert sorted(map(sorted, sets)) == sorted(sorted(map(int, np.flatnonzero(found == c))) for c in range(4))
