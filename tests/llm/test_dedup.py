import hashlib
from collections import defaultdict

from cohortflow.llm import dedup
from pyspark.sql import functions as F


def _groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(-1 if doc_id is None else doc_id)
    return groups


def test_against_brute_force(spark, messy):
    rows = [(r[0], r[1]) for r in messy.collect()]
    settled = dedup.settle(dedup.digests(messy)).withColumn("kept", F.col("row") == F.col("winner.row")).collect()
    groups = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in _groups(rows).items()}
    assert len(settled) == len(rows)
    kept = defaultdict(int)
    for r in settled:
        ids = groups[r["digest"].hex()]
        assert r["group_size"] == len(ids)
        assert (-1 if r["winner"]["doc_id"] is None else r["winner"]["doc_id"]) == max(ids)
        kept[r["digest"].hex()] += r["kept"]
    assert set(kept.values()) == {1}


def test_frequent_and_rare_digests_agree(spark):
    # Far more groups than the sketch reports, with one that holds a third of all rows.
    rows = [(i, "common") for i in range(3000)] + [(10_000 + i, f"text {i // 2}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    out = dedup.settle(dedup.digests(docs)).select("doc_id", "winner.doc_id", "group_size").collect()
    assert len(out) == 9000
    for doc_id, keep_id, size in out:
        want = (2999, 3000) if doc_id < 10_000 else (doc_id | 1, 2)
        assert (keep_id, size) == want


def test_survivors_keep_their_columns(messy):
    kept = dedup.exact_dedup(messy)
    assert kept.columns == messy.columns
    got = sorted((r[1] or "", -1 if r[0] is None else r[0]) for r in kept.collect())
    assert got == sorted((t, max(ids)) for t, ids in _groups((r[0], r[1]) for r in messy.collect()).items())


def test_empty_table(no_docs):
    assert dedup.settle(dedup.digests(no_docs)).count() == 0
    assert dedup.exact_dedup(no_docs).count() == 0
