import zlib

import numpy as np
import pytest

from cohortflow.llm import toxicity
from cohortflow.llm.common import read

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def costs(spark):
    return toxicity.character_costs(toxicity.count_characters(read(spark, SF, "documents")))


@pytest.fixture(scope="module")
def common(spark):
    return toxicity.common_words(toxicity.count_words(read(spark, SF, "documents")))


def test_character_counts(spark):
    docs = spark.createDataFrame([("Ab ab",), (None,), ("",), ("a1b é",)], "text string")
    counts = toxicity.count_characters(docs)
    a, b, edge, other = 1, 2, toxicity.EDGE, toxicity.OTHER
    assert counts[edge, a, b] == 2 and counts[edge, edge, a] == 3 and counts[a, b, edge] == 2
    assert counts[edge, edge, other] == 1 and counts[a, b, a] == 0


def test_costs_are_probabilities(costs):
    assert np.allclose(np.exp(-costs).sum(axis=2), 1)


@pytest.mark.parametrize(
    ("seen", "meant"),
    [("m0r0n", "moron"), ("stuuupid", "stupid"), ("idiooot", "idiot"), ("p@thetic", "pathetic"), ("$cum", "scum"),
     ("i.d.i.o.t", "idiot"), ("l0s3r", "loser"), ("stup!d!!", "stupid"), ("w-o-r-t-h-l-e-s-s", "worthless"),
     ("hello,", "hello"), ("2.0.", "2.0"), ("über", "über"), ("2024", "2024")],
)
def test_restored_words(costs, seen, meant):
    assert toxicity.restore_word(seen, costs) == meant


def test_spaced_letters(costs, common):
    assert toxicity.deobfuscate("you  are an I D I O T I say", costs, common) == "you are an idiot i say"
    assert toxicity.deobfuscate("a b c", costs, common) == "a b c"
    assert toxicity.deobfuscate(None, costs, common) == ""


def test_word_ends_are_the_cheapest(costs, common):
    """Against every way to cut short runs."""

    def cost(words):
        total = 0.0
        for word in words.split():
            spelt, a, b = toxicity.RARE, toxicity.EDGE, toxicity.EDGE
            for s in [*map(toxicity._symbol, word), toxicity.EDGE]:
                spelt += costs[a, b, s]
                a, b = b, s
            total += min(spelt, common.get(word, spelt))
        return total

    for run in ("idioti", "isthis", "abook", "a"):
        cuts = [run[0]]
        for ch in run[1:]:
            cuts = [c + blank + ch for c in cuts for blank in ("", " ")]
        assert abs(cost(toxicity.restore_run(run, costs, common)) - min(map(cost, cuts))) < 1e-9
    assert toxicity.restore_run("l0s3r", costs, common).replace(" ", "") == "loser"
    assert toxicity.word_ends("", costs, common) == []


def test_words_without_hope_have_no_weight(costs):
    """The shortcut against the whole search, for words near the lexicon and far from it."""
    weights = {"loser$": 3.0, "mor": 2.0, "idiot$": 3.0, "assess$": 1.5, "aab": 2.5, "noo$": 1.0}
    model = toxicity.Model(costs, weights, toxicity.trees.constant(0.5))
    words = ["loser", "losser", "lloserr", "losers", "moor", "mmoorr", "moral", "m0ral", "aaab", "ab", "abc", "aabb", "noooo"]
    words += ["no", "asses", "asess", "hello", "2024", "...", "", "idi", "idiott!", "(idiot)", "straße", "éé", "a1b2"]
    for word in words:
        assert model.look_up(word) == model._look_up(word), word


def test_common_words_are_taken_as_they_are(spark, costs):
    docs = spark.createDataFrame([("all " * 5 + "alll x1 the the the a1",), (None,), ("",)], "text string")
    words = toxicity.count_words(docs)
    assert {r["word"]: r["n"] for r in words.collect()} == {"all": 5, "alll": 1, "x1": 1, "the": 3, "a1": 1}
    assert toxicity.common_words(words) == {"all": np.log(11 / 5), "the": np.log(11 / 3)}
    assert toxicity.readings("pass", costs) and not toxicity.readings("pass", costs, {"pass": 1.0})


def test_viterbi_finds_the_cheapest_path(costs):
    """Against trying every reading of short words."""

    def every(word, last=""):
        if not word:
            yield 0.0, ""
            return
        ch, rest = word[0], word[1:]
        options = [(0.0, ch)] if ch.isalpha() else [(toxicity.SKIPPED, "")]
        if not ch.isalpha():
            options += [(toxicity.DISGUISED + np.log(len(toxicity.READINGS[ch])), r) for r in toxicity.READINGS[ch]]
        if ch == last:
            options.append((toxicity.DROPPED, ""))
        for price, letter in options:
            for cost, tail in every(rest, ch):
                yield price + cost, letter + tail

    def total(cost, word):
        a = b = toxicity.EDGE
        for s in [*map(toxicity._symbol, word), toxicity.EDGE]:
            cost += costs[a, b, s]
            a, b = b, s
        return cost

    for word in ("1d10t", "ssstup!d", "l00ser", "a*b1"):
        best = min(total(c, w) for c, w in every(word))
        chosen = toxicity.viterbi(word, costs)
        assert abs(min(total(c, w) for c, w in every(word) if w == chosen) - best) < 1e-9


def test_held_out_accuracy_and_disguises(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    learn = toxicity.remainder(toxicity.F.col("doc_id"), 4) != 2
    model = toxicity.train(docs, labels, learn)
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in known if zlib.crc32(str(i).encode()) % 4 == 2]
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(docs, model).collect()}
    right = [(scores[i] >= 0.3) == known[i] for i in held if i in scores]
    found = [scores[i] >= 0.3 for i in held if known[i]]
    assert np.mean(right) > 0.97 and np.mean(found) > 0.9
    clean = "the and thing was here that other one of it from this place and then went on " * 4
    odd = clean + "you m0r0n you i d i o t what a l0s3r such stuuuupid p@thetic tr@sh so d1sgusting " + clean
    low, high = model.score([clean, odd])[:, 0]
    assert low < 0.3 <= high


@pytest.mark.parametrize(
    "insult",
    ["what a l o s e r", "you are a m o r o n", "y o u i d i o t", "I D I O T I say", "mmoorroonn", "mo-ron", "id.iot"],
)
def test_disguises_in_a_clean_document_are_looked_up(costs, insult):
    weights = {"loser$": 3.0, "moron$": 3.0, "idiot$": 3.0}
    model = toxicity.Model(costs, weights, toxicity.trees.constant(0.5))
    clean = "a well-known letter from this place, e.g. a book of o l d maps and then all went on "
    strong = toxicity.STATISTICS.index("strong")
    plain, odd = model.matrix([clean * 4, clean * 2 + insult + " " + clean * 2])[:, strong]
    assert (plain, odd) == (0.0, 1.0)


def test_messy_empty_and_unlabelled(spark, messy, no_docs):
    labels = spark.createDataFrame([(1, 1), (8, 0), (9, 0), (6, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(messy, labels, toxicity.F.lit(True))
    scores = toxicity.toxicity_scores(messy, model)
    assert scores.where("score BETWEEN 0 AND 1").count() == messy.count()
    assert toxicity.toxicity_scores(no_docs, model).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    blank = toxicity.train(no_docs, none, toxicity.F.lit(True))
    assert blank.score(["any", None])[:, 0].tolist() == [0.5, 0.5]
