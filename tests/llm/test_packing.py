import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortflow.llm import packing
from cohortflow.llm.common import read


def _placed(histogram, capacity):
    found = packing.plan(histogram, capacity)
    length = np.array([n for n, k in histogram.items() for _ in range(k)], np.int64)
    number = np.array([i for _, k in histogram.items() for i in range(k)], np.int64)
    sequence, offset = packing.place(found, length, number)
    filled = {}
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), length.tolist())):
        assert filled.get(s, 0) == o
        filled[s] = o + n
    assert all(v <= capacity for v in filled.values())
    return len(filled)


def _one_by_one(histogram, capacity):
    """Best-fit decreasing, item by item."""
    rooms = []
    for n in sorted((n for n, k in histogram.items() for _ in range(k)), reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            rooms.append(capacity - n)
        else:
            rooms[rooms.index(fit)] = fit - n
    return len(rooms)


def _fewest(items, capacity):
    """The least number of sequences, by trying everything."""
    best = [len(items)]

    def put(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= items[i]:
                left = list(rooms)
                left[left.index(room)] -= items[i]
                put(i + 1, left)
        put(i + 1, [*rooms, capacity - items[i]])

    put(0, [])
    return best[0]


_COUNTS = st.integers(3, 40).flatmap(
    lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(1, 30), min_size=1, max_size=c))
)


@settings(max_examples=150, deadline=None)
@given(_COUNTS)
def test_plan_is_valid_and_no_worse_than_best_fit(case):
    capacity, histogram = case
    used = _placed(histogram, capacity)
    total = sum(n * k for n, k in histogram.items())
    assert -(-total // capacity) <= used <= _one_by_one(histogram, capacity)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9))
def test_reduction_never_loses_the_optimum(items):
    capacity = 12
    count = np.bincount(items, minlength=capacity + 1)
    fixed = packing.reduce_dominated(count, capacity)
    rest = [n for n in range(1, capacity + 1) for _ in range(count[n])]
    assert sum(p.bins for p in fixed) + _fewest(sorted(rest, reverse=True), capacity) == _fewest(sorted(items, reverse=True), capacity)
    held = sorted(rest + [n for p in fixed for n, k in p.holds for _ in range(k * p.bins)])
    assert held == sorted(items)


def test_nothing_to_pack():
    assert len(packing.plan({}).key) == 0


def test_ids_equal_the_tokenizers_library(spark, tables):
    exact = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    texts = [r["text"] for r in read(spark, tables, "documents").limit(300).collect()]
    odd = [None, "", " ", "<|endoftext|> x", "a" * 9000, "é\U0001f600\n\n  x", "1" * 5000, "   ", "x" * 4001 + " y"]
    for text in texts + odd:
        want = [*exact.encode(text or "", add_special_tokens=False).ids, packing.END]
        assert packing.token_ids(text).tolist() == want


def _check(docs, rows, capacity):
    texts = sorted((-1 if r[0] is None else r[0], tuple(packing.token_ids(r[1]).tolist())) for r in docs.collect())
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(-1 if r["doc_id"] is None else r["doc_id"], []).append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    want = {}
    for doc_id, ids in texts:
        first = len(ids) - (-(-len(ids) // capacity) - 1) * capacity
        for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
            part = np.array(ids[max(0, end - capacity) : end], "<u4")
            want.setdefault(doc_id, []).append((piece, max(0, end - capacity), len(part), zlib.crc32(part.tobytes())))
    got = {d: sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in v) for d, v in by_doc.items()}
    assert got == {d: sorted(v) for d, v in want.items()}


def test_all_documents(spark, tables):
    docs = read(spark, tables, "documents").select("doc_id", "text")
    rows = packing.op3_packing(spark, tables).collect()
    _check(docs, rows, packing.CAPACITY)
    used = len({r["sequence_id"] for r in rows})
    assert used <= 1.01 * -(-sum(r["length"] for r in rows) // packing.CAPACITY)


def test_messy_and_empty(messy, no_docs):
    _check(messy, packing.pack(packing.pieces(messy, 100), 100).collect(), 100)
    assert packing.pack(packing.pieces(no_docs)).count() == 0


def test_sequences_hold_the_documents_ids(messy):
    out = packing.sequences(messy.limit(6), 64).collect()
    assert all(len(r["ids"]) == sum(r["lengths"]) <= 64 for r in out)
    want = sorted(i for r in messy.limit(6).collect() for i in packing.token_ids(r[1]).tolist())
    assert sorted(i for r in out for i in r["ids"]) == want
