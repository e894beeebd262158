import random

import numpy as np
import pytest
import xxhash

from cohortflow.llm import simhash
from cohortflow.llm.common import read


def _print(text, words=3):
    """Bit by bit and shingle by shingle."""
    split = (text or "").encode().lower().split()
    k = min(words, len(split))
    shingles = [b" ".join(split[i : i + k]) for i in range(len(split) - k + 1)] if split else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def _components(rows, bits):
    """``(doc_id, print)`` rows against all others."""
    prints = sorted({p for _, p in rows})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    values = np.array(prints, np.uint64)
    for p in prints:
        for q in values[np.bitwise_count(values ^ np.uint64(p)) <= bits].tolist():
            root[find(p)] = find(q)
    low = {}
    for doc_id, p in rows:
        if doc_id is not None:
            low[find(p)] = min(doc_id, low.get(find(p), doc_id))
    none = lambda v: -1 if v is None else v
    return sorted((none(d), f"{p:016x}", none(low.get(find(p)))) for d, p in rows)


def _got(docs, words=3, bits=3):
    rows = simhash.near_prints(docs, words, bits).select("doc_id", "fingerprint", "component_id").collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows)


def _edited(rng, text, share):
    return " ".join(rng.choice(["new", "word", "here"]) if rng.random() < share else w for w in text.split(" "))


def _texts(rng, n):
    base = [" ".join(rng.choices([f"w{i}" for i in range(400)], k=rng.randrange(1, 120))) for _ in range(n)]
    return base + [_edited(rng, rng.choice(base), rng.choice([0, 0.01, 0.03])) for _ in range(n)]


def _hard(rng, n):
    """Fingerprints at random, and around some of them many that differ in one to five bits, chains too."""
    found = [rng.getrandbits(64) for _ in range(n)]
    for p in found[: n // 4]:
        for _ in range(rng.randrange(1, 12)):
            p_near = p
            for bit in rng.sample(range(64), rng.randrange(1, 6)):
                p_near ^= 1 << bit
            found.append(p_near)
            p = p_near if rng.random() < 0.3 else p
    return found


@pytest.mark.parametrize("words", [1, 3, 5])
def test_fingerprints(words):
    rng = random.Random(words)
    texts = [None, "", " \t\x0b", "one", "One two", "a b c", "\u00dc \u00a0x \U0001f600 Z z", "x" * 9000, "a " * 20_000]
    texts += _texts(rng, 40)
    assert [simhash.fingerprint(t, words) for t in texts] == [_print(t, words) for t in texts]


def test_seed_and_order_are_those_of_spark(spark):
    (row,) = spark.sql("SELECT lower(hex(xxhash64('one two three'))) AS h").collect()
    assert f"{simhash.fingerprint('ONE two\tthree'):016x}" == row["h"].zfill(16)


def test_against_brute_force(spark, messy, tables):
    rng = random.Random(5)
    rows = [(r[0], r[1]) for r in messy.collect()] + [(1000 + i, t) for i, t in enumerate(_texts(rng, 150))]
    rows += [(r[0] + 5000, r[1]) for r in read(spark, tables, "documents").select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = _components([(d, _print(t)) for d, t in rows], 3)
    assert len({r[2] for r in want}) < len({r[1] for r in want})
    assert _got(docs) == want


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 6])
def test_trees_lose_no_partner(bits):
    """Every link has its one end at home where the other visits, in some tree; shards stay small."""
    rng = random.Random(bits)
    prints = np.array(sorted(set(_hard(rng, 1_500))), np.uint64)
    trees = [simhash.grow(prints[::3], mask, reach, 8) for mask, reach in simhash.parts(bits)]
    assert sum(bin(m).count("1") for m, _ in simhash.parts(bits)) == 64
    met = set()
    for tree in trees:
        shard, row, home = simhash.visits(tree, prints)
        assert np.array_equal(np.sort(row[home]), np.arange(len(prints)))  # at home exactly once
        assert len(np.unique(shard[home])) > 10
        for s in np.unique(shard):
            here = row[shard == s]
            for p in row[(shard == s) & home]:
                near = here[np.bitwise_count(prints[here] ^ prints[p]) <= bits]
                met.update((int(p), int(q)) for q in near)
    for p in range(len(prints)):
        near = np.flatnonzero(np.bitwise_count(prints ^ prints[p]) <= bits)
        assert all((p, int(q)) in met for q in near)


@pytest.mark.parametrize(("bits", "shard", "homes", "visitors"), [(3, 64, 4096, 65536), (3, 256, 40, 100), (6, 64, 16, 4096)])
def test_components_in_shards_and_blocks(spark, monkeypatch, bits, shard, homes, visitors):
    rng = random.Random(homes)
    prints = _hard(rng, 1_200)
    center = rng.getrandbits(64)
    # One crowded ball, which no split can part: it is compared in blocks.
    prints += [center ^ sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(600)]
    rows = [(i, p) for i, p in enumerate(prints)]
    monkeypatch.setattr(simhash, "SHARD_ROWS", shard)
    monkeypatch.setattr(simhash, "BLOCK_HOMES", homes)
    monkeypatch.setattr(simhash, "BLOCK_VISITORS", visitors)
    table = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in rows], "doc_id long, print long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, words: docs)
    assert _got(table, bits=bits) == _components(rows, bits)


def test_a_crowd_gives_a_forest_and_not_its_pairs():
    rng = random.Random(3)
    crowd = np.array([sum(1 << b for b in rng.sample(range(64), 1)) for _ in range(2_000)], np.uint64)
    a, b = simhash.forest(crowd[:500], crowd, 3)
    assert len(a) == len(np.unique(crowd)) - 1 and len(np.unique(b)) == 1


def test_empty_table(no_docs):
    assert simhash.near_prints(no_docs).count() == 0
