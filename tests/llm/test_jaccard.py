import random
from collections import defaultdict

import numpy as np
import pytest

from cohortflow.llm import jaccard
from cohortflow.llm.common import connected, read


def _set(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def _brute(rows, k, percent):
    sets = [_set(text, k) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for gram in s:
            holders[gram].append(i)
    shared = defaultdict(int)
    for docs in holders.values():
        for x, a in enumerate(docs):
            for b in docs[x + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            root[find(a)] = find(b)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            lowest[find(i)] = min(lowest.get(find(i), doc_id), doc_id)
    return sorted((-1 if d is None else d, len(sets[i]), lowest.get(find(i), -1)) for i, (d, _) in enumerate(rows))


def _got(docs, k, percent):
    out = jaccard.near_groups(docs, k, percent).collect()
    none = lambda v: -1 if v is None else v
    return sorted((none(r["doc_id"]), r["n_shingles"], none(r["component_id"])) for r in out)


def _edited(rng, words, share):
    return [rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in words]


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_against_brute_force(spark, k, percent):
    rng = random.Random(k)
    vocabulary = [f"w{i}" for i in range(60)]
    rows, n = [], 0
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 30, 120]))]
        for share in (0, 0.003, 0.01, 0.02, 0.05, 0.15):
            text = _edited(rng, base, share)
            rows.append((n, " ".join(text if rng.random() < 0.7 else text[: int(len(text) * 0.93)])))
            n += 1
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = _got(docs, k, percent)
    assert got == _brute(rows, k, percent)
    assert len({c for *_, c in got}) < len(rows)


def test_a_large_group_of_near_copies(spark):
    """Each of 400 copies differs in places of its own, so links join some pairs and not others."""
    rng = random.Random(9)
    base = [f"v{rng.randrange(500)}" for _ in range(150)]
    rows = [(i, " ".join(_edited(rng, base, rng.choice([0.002, 0.015, 0.03])))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert _got(docs, 3, 90) == _brute(rows, 3, 90)


def test_no_pair_is_tried_twice(spark, monkeypatch):
    """Documents of shared blocks: many pairs fail under one gram and meet again under another."""
    rng = random.Random(12)
    blocks = [[f"b{i}w{rng.randrange(400)}" for _ in range(12)] for i in range(14)]
    rows = [(i, " ".join(w for b in rng.sample(blocks, 9) for w in b) + f" end{i}") for i in range(120)]
    rows += [(200 + i, rows[i][1] + " more") for i in range(20)]
    tried, verified = [], jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda pairs, *rest: tried.append({tuple(r) for r in pairs.collect()}) or verified(pairs, *rest))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _got(docs, 3, 50) == _brute(rows, 3, 50)
    assert len(tried) == 2 and tried[0] and not tried[0] & tried[1]


def test_messy_and_empty(messy, no_docs):
    rows = [(r[0], r[1]) for r in messy.collect()]
    assert _got(messy, 3, 90) == _brute(rows, 3, 90)
    assert jaccard.near_groups(no_docs).count() == 0
    assert jaccard.keep_one(no_docs).count() == 0


def test_one_of_each_group_stays(messy):
    kept = jaccard.keep_one(messy, 3, 90)
    assert kept.columns == messy.columns
    ids = sorted(r[0] for r in kept.collect() if r[0] is not None)
    assert ids == [1, 2, 3, 4, 6, 7, 8, 9, 10, 12]


def test_prefix_and_overlap_bounds():
    for percent in (50, 80, 90, 100):
        for n in range(1, 200):
            least = -(-percent * n // 100)  # of its own set a partner must share
            assert jaccard.prefix_length(n, percent) == n - least + 1
            for m in range(n, min(2 * n, n + 20)):
                need = jaccard.overlap_needed(np.array([n]), np.array([m]), percent)[0]
                assert 100 * need >= percent * (n + m - need) and 100 * (need - 1) < percent * (n + m - need + 1)


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1200)]
    pairs += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(70)] + [(5, 5)]
    root = {x: x for p in pairs for x in p}
    for _ in range(200):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = dict(map(tuple, connected(spark.createDataFrame(pairs, "a long, b long")).collect()))
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_table(spark, tables):
    docs = read(spark, tables, "documents")
    assert _got(docs, 5, 80) == _brute([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80)
