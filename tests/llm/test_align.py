import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortflow.llm import align
from cohortflow.llm.common import read


def _brute(rows, a, b):
    """Document by document, token by token; ``a`` and ``b`` give lists of (id, bytes) or None."""
    out, documents, links_of = [], Counter(), []
    for doc_id, text in rows:
        tokens_a, tokens_b = a(text) if text else [], b(text) if text else []
        raw = (" " + (text or "")).encode()
        if not text or any(b"".join(t for _, t in x) != raw for x in (tokens_a, tokens_b)):
            out.append([doc_id, 0, 0, 0, 0, ""])
            links_of.append(Counter())
            continue
        ends = []
        for tokens in (tokens_a, tokens_b):
            at, mine = 0, []
            for _, t in tokens:
                at += len(t)
                mine.append(at)
            ends.append(mine)
        groups = defaultdict(lambda: ([], []))
        cuts = sorted(set(ends[0]) & set(ends[1]))
        for side, tokens in enumerate((tokens_a, tokens_b)):
            for (i, _), end in zip(tokens, ends[side], strict=True):
                groups[min(c for c in cuts if c >= end)][side].append(i)
        links = Counter((x, y) for c in cuts for x in groups[c][0] for y in groups[c][1])
        written = ";".join("|".join(",".join(map(str, side)) for side in groups[c]) for c in cuts)
        digest = hashlib.sha256(written.encode()).hexdigest()
        out.append([doc_id, len(tokens_a), len(tokens_b), len(cuts), sum(links.values()), digest])
        links_of.append(links)
        documents.update(links.keys())
    best = Counter()
    for (x, _), n in documents.items():
        best[x] = max(best[x], n)
    for row, links in zip(out, links_of, strict=True):
        row[5:5] = [
            sum(n for p, n in links.items() if documents[p] == best[p[0]]),
            sum(n * documents[p] for p, n in links.items()),
        ]
    return sorted((tuple(-1 if v is None else v for v in row) for row in out), key=repr)


def _public():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    # Byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ..
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in plain]
    back = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(rest)}
    byte_bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    byte_bpe.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def a(text):
        ids = byte_bpe.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(back[c] for c in byte_bpe.id_to_token(i))) for i in ids]

    def b(text):
        ids = pieces.encode(text)
        of = [pieces.id_to_piece(i) for i in ids]
        return [
            (i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("\u2581", " ").encode())
            for i, p in zip(ids, of, strict=True)
        ]

    return a, b


def _got(docs, **settings):
    rows = align.alignment(docs, **settings).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
    return sorted((tuple(-1 if v is None else v for v in r) for r in rows.collect()), key=repr)


SPECIAL = [
    "<|endoftext|> and <s> in </s> text <unk> <0x41>",
    "two  blanks   and \t tabs \r\n lines \n\n\n",
    "\u2581 marks a blank elsewhere",
    "\u00dcn\u00efcode \U0001f600\U0001f468\u200d\U0001f469 \u4e2d\u6587\u5b57 \u0430\u0431\u0432 e\u0301 \ufb01 \u00bd",
    " leading and trailing ",
    "x" * 700 + "ab" * 900 + " " * 300 + "1234567890" * 50,
    "a",
    " ",
    "\n",
    "\x00 \x01 \x7f",
]


def test_public_tokenizers_against_brute_force(spark, messy, tables):
    rows = [(r[0], r[1]) for r in messy.collect() if len(r[1] or "") < 60_000]
    rows += [(100 + i, t) for i, t in enumerate(SPECIAL)] + [(200, SPECIAL[3]), (201, SPECIAL[5])]
    rows += [(r[0], r[1]) for r in read(spark, tables, "documents").select("doc_id", "text").where("length(text) < 2000").limit(60).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = _brute(rows, *_public())
    assert sum(r[4] > 0 for r in want) > 40
    assert _got(docs) == want


def _toy(seed: int) -> align.Tokenizers:
    """Greedy cutters over two alphabets of pieces that seldom end together; the letter z is changed by B."""
    rng = random.Random(seed)
    tables = []
    for _ in "ab":
        pieces = {"".join(rng.choices("pq ", k=rng.randrange(2, 6))) for _ in range(12)}
        tables.append(sorted({*"pqz ", *pieces}))

    def cut(text, table):
        ids, at = [], 0
        while at < len(text):
            piece = max((p for p in table if text.startswith(p, at)), key=len)
            ids.append(table.index(piece))
            at += len(piece)
        return ids

    return align.Tokenizers(
        lambda text: cut(text, tables[0]),
        lambda texts: [cut(" " + t, tables[1]) for t in texts],
        [p.encode() for p in tables[0]],
        [p.encode().replace(b"z", b"y") for p in tables[1]],
    )


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(("lane", "links", "broadcast"), [(512, 4_000_000, 10**6), (3, 40, 10**6), (2, 3, 5), (512, 10, 0.5)])
def test_lanes_parts_and_joins_give_the_same(spark, monkeypatch, seed, lane, links, broadcast):
    pair = _toy(seed)
    rng = random.Random(9)
    rows = [(i, "".join(rng.choices("pq z" if i % 9 == 0 else "pq ", k=rng.randrange(0, 80)))) for i in range(120)]
    rows += [(None, None), (7, rows[7][1]), (500, "pq" * 300), (501, "p" * 500)]
    a = lambda t: [(i, pair.bytes_a[i]) for i in pair.encode_a(" " + t)]
    b = lambda t: [(i, pair.bytes_b[i]) for i in pair.encode_b([t])[0]]
    want = _brute(rows, a, b)
    found = align.align([t for _, t in rows], pair, lane)
    assert sorted(found.digests) == sorted(r[7] for r in want) and found.times.sum() == found.n_links.sum()
    monkeypatch.setattr(align, "LINKS", links)
    again = align.align([t for _, t in rows], pair, lane)
    for one, other in zip(found, again, strict=True):
        assert np.array_equal(one, other)
    if lane == 2 or broadcast < 10**6:
        monkeypatch.setattr(align, "BROADCAST_PAIRS", max(1, int(broadcast)))
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert _got(docs, tokenizers=_Toy(seed)) == want


class _Toy:
    """A toy pair that tasks can make for themselves."""

    def __init__(self, seed):
        self.seed = seed

    def __call__(self):
        return _toy(self.seed)


def test_steps_are_bounded_by_the_lane():
    ends = np.arange(1, 20_001)
    cuts = align.merge_cuts(ends, ends * 1, np.array([0, 20_000]), np.array([0, 20_000]), lane=100)
    assert np.array_equal(cuts[:, 0], cuts[:, 1]) and len(cuts) == 20_000


def test_empty_table(no_docs):
    assert align.alignment(no_docs).count() == 0
