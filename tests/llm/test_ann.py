import math

import numpy as np
import pytest

from cohortflow.llm import ann
from cohortflow.llm.common import pick, read

SCHEMA = "vec_id long, embedding array<float>, label int, node string, vec string"


def _brute(rows, k):
    """All usable rows: nearest ids and scores per query, ties to the smaller id."""
    good = {
        (i, tuple(v)) for i, v, *_ in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = {}
    for i, v in good:
        if i % 20 == 0:
            scored = [(-float(np.dot(np.array(v, float), np.array(w, float))), j) for j, w in good if j != i]
            out[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return out


def _got(rows, k):
    found = ann.nearest(ann.build(rows, k), pick(rows, "vec_id", "embedding").where("vec_id % 20 = 0"), k).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def _recall(got, want):
    return np.mean([len({j for j, _ in got[i]} & {j for j, _ in w}) / len(w) for i, w in want.items()])


def test_recall_and_order_on_the_table(spark):
    rows = read(spark, "/root/testdata/sf0.1", "embeddings")
    got = _got(rows, 20)
    want = _brute([tuple(r) for r in rows.select("vec_id", "embedding").collect()], 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert _recall(got, want) >= 0.95
    exact = {(i, j): s for i, w in want.items() for j, s in w}
    assert all(abs(s - exact[i, j]) < 1e-12 for i, v in got.items() for j, s in v if (i, j) in exact)
    assert all([-s for _, s in v] == sorted(-s for _, s in v) for v in got.values())


def test_copies_lengths_and_unusable_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.5, 2)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, [0.5, 0.25, -1.0, 2.0, 0.0, 1.0, 0.125, 3.0]) for i in range(200)]  # a common vector
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] + [1.0] * 7), (2060, [None] + [1.0] * 7)]
    rows += [(2080, [float("inf")] + [1.0] * 7), (2100, []), (2120, [1.0, 2.0]), (None, [1.0] * 8), (20, rows[20][1])]
    rows = [(*r, 1, "x", "y") for r in rows]
    want = _brute([r for r in rows if r[0] != 2120], 20)
    got = _got(spark.createDataFrame(rows, SCHEMA).repartition(4), 20)
    assert got.keys() == want.keys()
    assert _recall(got, want) >= 0.97
    assert [j for j, _ in got[1000]] == [j for j, _ in want[1000]] == list(range(1001, 1021))


@pytest.mark.parametrize("longer", [3.9, 1e3, 1e200])
def test_one_long_vector_spoils_nothing(spark, longer):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(20_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[777] *= longer
    asked = np.arange(40, 20_000, 400)
    asked = np.append(asked, 777)
    frame = [(int(i), v.tolist()) for i, v in enumerate(x)]
    rows = spark.createDataFrame(frame, "vec_id long, embedding array<double>").repartition(8)
    queries = rows.where(rows["vec_id"].isin([int(i) for i in asked]))
    got = {}
    for r in ann.nearest(ann.build(rows, 20), queries, 20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    right = []
    for i in asked:
        s = x @ (x[i] / np.linalg.norm(x[i] / np.abs(x[i]).max()) / np.abs(x[i]).max())
        s[i] = -np.inf
        right.append(len(got[i] & set(np.argsort(-s)[:20].tolist())) / 20)
    assert len(got[777]) == 20 and np.mean(right) >= 0.9


def test_products_beyond_a_double():
    a = np.array([[1e200, -1e200], [1e200, 1.0], [3.0, 4.0]])
    b = np.array([[1e200, 2e200], [1e200, 1.0], [1.0, 2.0]])
    assert ann._products(a, b).tolist() == [-math.inf, math.inf, 11.0]


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_few_vectors(spark, n):
    rows = [(20 * i, [float(i + 1), 1.0], 0, "", "") for i in range(n)]
    got = _got(spark.createDataFrame(rows, SCHEMA), 20)
    want = {i: w for i, w in _brute(rows, 20).items() if w}
    assert {i: [j for j, _ in v] for i, v in got.items()} == {i: [j for j, _ in w] for i, w in want.items()}
