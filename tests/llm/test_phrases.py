import random
import re
from collections import Counter

import pytest

from cohortflow.llm import phrases


def _brute(rows, longest=3, least=10, covered=50, top=2000):
    """Straight from the rule: count every contiguous phrase, cut, cover, rank."""
    held, size = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            size[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    held.setdefault(lang, Counter())[tuple(words[i : i + n])] += 1
    out = []
    for lang, f in held.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    around[p[i : i + m]] = max(around[p[i : i + m]], a)
        ranked = []
        for p, a in candidates.items():
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if around[p] == 0 or 100 * around[p] < covered * a:
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, size[lang], -score))
    return sorted(out)


def _docs(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


def _got(docs, **settings):
    return sorted(map(tuple, phrases.collocations(docs, **settings).collect()))


@pytest.mark.parametrize(("longest", "least", "covered", "top"), [(3, 10, 50, 2000), (2, 3, 50, 7), (4, 2, 80, 50)])
def test_against_brute_force(spark, longest, least, covered, top):
    rng = random.Random(longest)
    words = ["a", "B", "b", "c", "\u00fc", "\u00dc", "\U0001f600", "\uffee", "\u00a0x", "de", "fg"]
    rows = []
    for _ in range(200):
        parts = rng.choices(words, k=rng.randrange(0, 25))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r\n"]) for w in parts)
        rows.append((text, rng.choice(["en", "de", None, "und"])))
    settings = {"longest": longest, "least": least, "covered": covered, "top": top}
    want = _brute(rows, **settings)
    assert len(want) > 5
    assert _got(_docs(spark, rows).repartition(5), **settings) == want


def test_padding_is_no_phrase_and_covered_pairs_go(spark):
    rows = [("new york city", "en")] * 12 + [("new york.", "en")] * 2 + [("york. city new", "en")] * 30
    got = {r[2]: r for r in _got(_docs(spark, rows))}
    assert set(got) == {"new york city", "city new"}  # both pairs inside are covered: 12 of 14, 12 of 12
    assert got["new york city"][3:6] == (12, 14, 42) or got["new york city"][3:6] == (12, 44, 12)
    assert _got(_docs(spark, rows)) == _brute(rows)


def test_products_beyond_64_bits(spark):
    found = spark.createDataFrame(
        [("en", ["x"], 4 * 10**12), ("en", ["y"], 3 * 10**12), ("en", ["x", "y"], 3 * 10**12 - 1)],
        "lang string, words array<string>, a long",
    )
    (row,) = phrases.scored(found).collect()
    a = 3 * 10**12 - 1
    assert row["score"] == 10**6 * a * a // (12 * 10**24)


def test_a_sieve_of_few_bits_lets_more_through_and_changes_nothing(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(" ".join(rng.choices("abcdefgh", k=40)), rng.choice(["en", "de"])) for _ in range(150)]
    want = _brute(rows, least=12)
    windows = phrases.windows(_docs(spark, rows))
    few = phrases.sieved(windows, least=12).where("w3 IS NOT NULL").count()
    assert _got(_docs(spark, rows), least=12) == want
    monkeypatch.setattr(phrases, "SIEVE_NUMBERS", (1, 1))
    monkeypatch.setattr(phrases, "SIEVE_ROW", 1)
    assert phrases.sieved(windows, least=12).where("w3 IS NOT NULL").count() > 3 * few > 0
    assert _got(_docs(spark, rows), least=12) == want


def test_ranking_in_parts_gives_the_same(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(" ".join(rng.choices("abcdefghijklmnop", k=60)), "en") for _ in range(100)]
    want = _brute(rows, top=40)
    monkeypatch.setattr(phrases, "RANKED_ROWS", 20)
    assert _got(_docs(spark, rows), top=40) == want


def test_messy_and_empty(spark, messy, no_docs):
    rows = [(r[1], r[2]) for r in messy.collect()]
    want = _brute(rows, least=2)
    assert want and _got(messy, least=2) == want
    assert _got(no_docs) == []
    assert _got(_docs(spark, [(None, None), ("", "en"), (" . \t\n", "en")])) == []
