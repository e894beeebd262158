import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from cohortflow.llm import dedup, jaccard, mixing, packing, quality
from cohortflow.llm.common import read
from cohortflow.session import stage
from tests.llm.test_jaccard import _brute

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    """Every stage on all that its predecessor kept, each held against a plain computation."""
    docs = read(spark, SF, "documents")
    columns = docs.columns
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, SF), "test")
        rows, before = out.collect(), docs.collect()
        if name == "quality":
            forest = quality.train(docs, read(spark, SF, "labels"), F.lit(True))
            good = forest.probability(quality.matrix([r["text"] for r in before])) >= 0.5
            want = [r["doc_id"] for r, g in zip(before, good) if g]
            assert 0.5 < np.mean(good) < 1
        elif name == "exact dedup":
            last = {r["text"]: r["doc_id"] for r in sorted(before, key=lambda r: r["doc_id"])}
            want = list(last.values())
        elif name == "near dedup":
            found = _brute([(r["doc_id"], r["text"]) for r in before], 5, 80)
            want = [d for d, _, c in found if d == c]
        elif name == "mixing":
            copies = mixing.mixed_sizes(docs).collect()
            want = [r["doc_id"] for r in copies for _ in range(r["copies"])]
        else:
            pieces = [-(-len(packing.token_ids(r["text"])) // 1024) for r in before]
            assert len(rows) == sum(pieces)
            used = len({r["sequence_id"] for r in rows})
            assert used <= 1.02 * -(-sum(r["length"] for r in rows) // 1024) + 1
            want = [r["doc_id"] for r, n in zip(before, pieces) for _ in range(n)]
        assert sorted(r["doc_id"] for r in rows) == sorted(want), name
        if name != "packing":
            assert out.columns == columns
        kept[name] = len(rows)
        docs = out
    run = corpus_pipeline.run(spark, SF)
    assert run.count() == kept["packing"]


def test_stages_on_messy_and_empty_tables(spark, messy, no_docs):
    for docs in (messy.drop("d"), no_docs.drop("d")):
        for name, step in corpus_pipeline.STAGES:
            if name != "quality":  # learns from labels by id; held apart in its own test
                out = step(spark, docs, SF)
                assert name == "packing" or out.columns == docs.columns
                out.count()


def test_exact_then_near_leave_no_copies(spark):
    rows = [(i, f"alpha beta gamma delta number {i // 3} " * 8, "en", "s", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = stage(dedup.exact_dedup(docs), "test")
    assert left.count() == 20
    assert jaccard.keep_one(left).count() == jaccard.keep_one(left.repartition(3)).count() <= 20
