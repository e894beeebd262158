import math
import zlib

import numpy as np

from cohortflow.llm import quality, trees
from cohortflow.llm.common import read


def test_forest_traversal_equals_a_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    y = (x[:, 0] * x[:, 1] + 0.3 * x[:, 2] > 0).astype(float)
    forest = trees.fit(x, y, trees=25, depth=3)

    def walk(row):
        total = forest.base
        for feature, cut, leaf in zip(forest.feature, forest.cut, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
            total += leaf[node - len(feature)]
        return total

    assert np.allclose(forest.margin(x), [walk(r) for r in x])
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.9


def test_one_class_ties_and_no_rows():
    assert 0.5 < trees.fit(np.ones((5, 2)), np.ones(5)).probability(np.zeros((1, 2)))[0] < 1
    assert trees.fit(np.zeros((0, 2)), np.zeros(0)).probability(np.zeros((3, 2))).tolist() == [0.5] * 3
    same = trees.fit(np.ones((6, 2)), np.array([0, 1, 0, 1, 1, 1.0])).probability(np.ones((1, 2)))[0]
    assert abs(same - 5 / 8) < 0.1


def test_statistics_are_finite():
    for text in (None, "", " \n ", "a", "x" * 100_000, "é" * 10, "a b " * 50_000):
        values = quality.statistics(text)
        assert len(values) == len(quality.STATISTICS) and all(math.isfinite(v) for v in values)
    assert quality.statistics(None) == quality.statistics("")


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = quality.op2_quality(spark, sf).collect()
    labels = {r["doc_id"]: r["quality"] for r in read(spark, sf, "labels").collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    for r in rows[:200]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.98


def test_messy_empty_and_unlabelled(spark, messy, no_docs):
    labels = spark.createDataFrame(
        [(1, 1, "x"), (1, 1, "x"), (8, 0, "x"), (9, 0, "x"), (6, 1, "x"), (6, 0, "x"), (None, 1, "x"), (12, None, "x")],
        "doc_id long, quality int, label string",
    )
    forest = quality.train(messy, labels, quality.remainder(quality.F.col("doc_id"), 3) != 7)
    scores = quality.quality_scores(messy, forest)
    assert scores.count() == messy.count() and scores.where("score BETWEEN 0 AND 1").count() == messy.count()
    kept = quality.keep_good(messy, labels)
    assert kept.columns == messy.columns
    assert quality.quality_scores(no_docs, forest).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert set(r["score"] for r in quality.quality_scores(messy, quality.train(messy, none, quality.F.lit(True))).collect()) == {0.5}
    assert quality.keep_good(no_docs, none).count() == 0
