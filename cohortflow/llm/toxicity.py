"""Toxicity: noisy-channel deobfuscation, then a lexicon and boosted trees over the restored words.

1. The words of all documents are counted in a table that grows with them. A character trigram model comes
   from the whole table; the words that are common in it are taken as they are.
2. A word that does not look like one (digits or marks inside, letters drawn out or spaced out) is seen
   as a noisy copy of the word its author meant. Viterbi search finds the likeliest word in the lattice
   of readings of its characters, under the character model and the costs of the channel. In a run of
   spaced characters a second Viterbi pass decides which blanks end a word: common words cost what their
   counts say, all others what their characters say.
3. The restored words are looked up in a lexicon of words and word beginnings that mark toxic
   documents, learned from a bounded sample of labelled ones, and trees score what the lookups add up to.

Texts are read where they lie; gathered are trigram counts, common words (a bounded number, as each makes up
a fixed share of all) and the sample's features. Most words are no copy of any entry of the lexicon however
they are read, which their first letters tell; the lattice is built for the others.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Container, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import trees
from cohortflow.llm.common import pick, read, uniform
from cohortflow.llm.quality import TRAIN_DOCS, blocks, labelled, remainder, rows_of
from cohortflow.session import stage

#: Symbols of the character model: a word's edge, a to z, and any other letter.
EDGE, OTHER, SYMBOLS = 0, 27, 28
#: Readings of a character that is not a letter.
READINGS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a",
    "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "#": "h", "*": "aeiou",
}
#: Costs of the channel (negative logarithms): a disguised letter, a mark left out, one letter of a run dropped.
DISGUISED, SKIPPED, DROPPED = 0.7, 8.0, 1.0
COMMON = 100_000  #: a common word is one in so many words at least, so there are no more common words than that
RARE, LONGEST = 2.0, 32  #: what a word costs more that is spelt by its characters, and its letters at most
SPACED = 4  #: single characters in a row that are read as one word
_SPLIT_UP = re.compile(r"\w(?:[._*~-]\w){3,}", re.UNICODE)
_DOUBLED = re.compile(r"(.)\1", re.DOTALL)
_REPEATS = re.compile(r"(.)\1+", re.DOTALL)
_INSIDE = re.compile(r"(?<=\w)[._*~-]+(?=\w)", re.UNICODE)
_DRAWN_OUT = re.compile(r"(.)\1\1", re.DOTALL)
_EDGES = "\"'`.,;:?)]}>%&^~_-=…"
SURE = 5  #: letters that a beginning has at least where it is found inside a run or across a mark
#: Lexicon entries, at most, and the documents that an entry must occur in, at least.
LEXICON, SUPPORT = 20_000, 3
STATISTICS = ("words", "strong", "weak", "strong_share", "weak_share", "total", "highest", "restored")
_MEMO = 200_000


def _symbols(text: str) -> np.ndarray:
    """Symbol per character of a lower-case text; -1 for what no word consists of."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = np.full(len(codes), -1, np.int64)
    low = (codes >= 97) & (codes <= 122)
    out[low] = codes[low] - 96
    out[(codes >= 0xC0) & (codes < 0x2000) & (codes != 0xD7) & (codes != 0xF7)] = OTHER
    out[(codes == 32) | ((codes >= 9) & (codes <= 13))] = EDGE
    return out


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n``: how often each lower-case word occurs in all texts; written, as it grows with them."""
    words = pick(docs, "text").select(F.explode(F.split(F.lower("text"), r"\s+")).alias("word")).where("word <> ''")
    return stage(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "toxicity-words")


def common_words(words: DataFrame) -> dict[str, float]:
    """Words of letters that make up one part in ``COMMON`` of all words at least, which ``COMMON`` words at most do.

    Their values are negative log probabilities.
    """
    total = words.agg(F.sum("n")).first()[0] or 0
    common = words.where((F.col("n") * COMMON >= total) & (F.col("n") >= SUPPORT))
    common = common.where(F.col("word").rlike(r"^\p{L}+$"))
    return {r["word"]: float(np.log(total / r["n"])) for r in common.select("word", "n").collect()}


def count_characters(docs: DataFrame) -> np.ndarray:
    """Trigram counts over all texts, ``SYMBOLS`` cubed."""
    return characters_of(count_words(docs))


def characters_of(words: DataFrame) -> np.ndarray:
    """Trigram counts over ``words (word, n)``; what a task gathers is bounded by the alphabet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3)
        for batch in batches:
            for piece in blocks(batch, "word"):
                held, times = piece.column("word").to_pylist(), piece.column("n").to_numpy()
                s = _symbols(f"  {' '.join(held)} ")
                weights = np.repeat(times, [len(w) + 1 for w in held])  # a word's letters and the blank behind it
                a, b, c = s[:-2], s[1:-1], s[2:]
                a = np.where(b == EDGE, EDGE, a)  # what a word begins with does not depend on the word before
                whole = (a >= 0) & (b >= 0) & (c >= 0) & ((b > 0) | (c > 0))
                at = (a * SYMBOLS + b)[whole] * SYMBOLS + c[whole]
                total += np.bincount(at, weights=weights[whole], minlength=SYMBOLS**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], names=["at", "n"])

    parts = words.select("word", "n").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    counts = np.zeros(SYMBOLS**3)
    for row in parts.collect():
        counts[row["at"]] = row["n"]
    return counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def character_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probability of a symbol after two others; unseen contexts fall back to fewer symbols."""
    one = counts.sum(axis=(0, 1)) + 1
    p1 = one / one.sum()
    two = counts.sum(axis=0)
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (counts + 5 * p2[None]) / (counts.sum(axis=2, keepdims=True) + 5)
    return -np.log(p3)


def _symbol(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else OTHER


def viterbi(word: str, costs: np.ndarray) -> str:
    """The likeliest word behind the characters of ``word``.

    Each character offers its readings; a mark may be skipped; from a run of one letter some may be
    dropped. States are the last two symbols, so time is linear in the word's length.
    """
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(EDGE, EDGE): (0.0, None)}
    last = ""
    for ch in word:
        if ch.isalpha():
            readings = [(0.0, ch)]
        else:
            readings = [(DISGUISED + np.log(len(READINGS.get(ch, "x"))), r) for r in READINGS.get(ch, "")]
            readings.append((SKIPPED, ""))
        if ch == last:
            readings.append((DROPPED, ""))
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in best.items():
            row = costs[a, b]
            for price, letter in readings:
                if letter:
                    s = _symbol(letter)
                    state, total, trace = (b, s), cost + price + row[s], (letter, path)
                else:
                    state, total, trace = (a, b), cost + price, path
                if state not in after or total < after[state][0]:
                    after[state] = (total, trace)
        best, last = after, ch
    ends = [(cost + costs[a, b, EDGE], path) for (a, b), (cost, path) in best.items()]
    path = min(ends, key=lambda e: e[0])[1]
    letters = []
    while path is not None:
        letters.append(path[0])
        path = path[1]
    return "".join(reversed(letters))


def restore_word(word: str, costs: np.ndarray, common: Container[str] = ()) -> str:
    """A lower-case word as its author meant it: itself, unless it looks disguised and is not ``common``."""
    core = word.strip(_EDGES).rstrip("!#$*%&")
    if core in common:
        return core
    if _SPLIT_UP.fullmatch(core):
        core = re.sub(r"[._*~-]", "", core)
    if core.isalpha():
        return viterbi(core, costs) if _DRAWN_OUT.search(core) else core
    if any(ch.isalpha() for ch in core) and any(ch in READINGS for ch in core):
        return viterbi(core, costs) or core
    return core


def restore(text: str | None, read_word: Callable[[str], object], join: Callable[[str], object] | None = None) -> list:
    """``read_word`` of each lower-case word of a text; characters spaced out singly are put together first."""
    out, run = [], []
    for word in (text or "").lower().split():
        if len(word) == 1:
            run.append(word)
            continue
        if run:
            out += [(join or read_word)("".join(run))] if len(run) >= SPACED else map(read_word, run)
            run = []
        out.append(read_word(word))
    if run:
        out += [(join or read_word)("".join(run))] if len(run) >= SPACED else map(read_word, run)
    return out


def word_ends(letters: str, costs: np.ndarray, common: dict[str, float]) -> list[str]:
    """The likeliest words that ``letters`` consist of; words that are not common have ``LONGEST`` letters at most."""
    symbols = [_symbol(ch) for ch in letters]
    best = [(0.0, 0)] + [(np.inf, 0)] * len(letters)  # cost up to here, and where the last word begins
    for i in range(len(letters)):
        before, a, b, spelt = best[i][0], EDGE, EDGE, RARE
        for j in range(i, min(len(letters), i + LONGEST)):
            spelt += costs[a, b, symbols[j]]
            a, b = b, symbols[j]
            price = before + min(common.get(letters[i : j + 1], np.inf), spelt + costs[a, b, EDGE])
            if price < best[j + 1][0]:
                best[j + 1] = (price, i)
    out, at = [], len(letters)
    while at:
        out.append(letters[best[at][1] : at])
        at = best[at][1]
    return out[::-1]


def restore_run(run: str, costs: np.ndarray, common: dict[str, float]) -> str:
    """The words behind lower-case characters that were spaced out, one blank apart."""
    return " ".join(word_ends(restore_word(run, costs), costs, common))


def deobfuscate(text: str | None, costs: np.ndarray, common: dict[str, float]) -> str:
    """The restored text: lower-case words, one blank apart."""
    return " ".join(restore(text, lambda w: restore_word(w, costs, common), lambda r: restore_run(r, costs, common)))


def _beginnings(word: str) -> list[str]:
    return [word[:n] for n in range(3, min(len(word), 9))] + [f"{word}$"] if len(word) > 2 else []


def readings(word: str, costs: np.ndarray, common: Container[str] = ()) -> list[str]:
    """Other words that a lower-case word may be meant as: without marks inside it, or without doubled letters."""
    core = word.strip(_EDGES).rstrip("!#$*%&")
    out = []
    if core in common:
        return out
    joined = _INSIDE.sub("", core)
    if joined != core and any(ch.isalpha() for ch in joined):
        out.append(restore_word(joined, costs))
    if joined.isalpha() and _DOUBLED.search(joined):
        out.append(viterbi(joined, costs))
    return out


def _sure(entries: list[str]) -> list[str]:
    """Whole words, and beginnings that are long enough to be no chance."""
    return [e for e in entries if e.endswith("$") or len(e) >= SURE]


#: What is found for a word that no entry speaks of: no weight, not restored.
NOTHING = (0.0, False)


@dataclass
class Model:
    """What scoring needs: character costs, lexicon weights, trees, common words."""

    costs: np.ndarray
    weights: dict[str, float]
    forest: trees.Forest
    common: dict[str, float] = field(default_factory=dict)
    memo: dict[str, tuple[float, bool]] = field(default_factory=dict)
    longest: int = field(init=False)  #: letters of the longest entry
    stems: frozenset[str] = field(init=False)  #: all entries without repeats of a letter

    def __post_init__(self) -> None:
        self.longest = max((len(entry.rstrip("$")) for entry in self.weights), default=0)
        self.stems = frozenset(_REPEATS.sub(r"\1", entry) for entry in self.weights)

    def _hopeless(self, word: str) -> bool:
        """Whether the word is of letters and no entry can match it, whatever repeats are dropped.

        Dropping repeats leaves the word without any repeat unchanged, so an entry that matches a
        reading begins, without repeats, like the word without repeats.
        """
        core = word.strip(_EDGES).rstrip("!#$*%&")
        if not core.isalpha():
            return not core
        start = _REPEATS.sub(r"\1", core)
        return f"{start}$" not in self.stems and self.stems.isdisjoint([start[:n] for n in range(1, 9)])

    def look_up(self, word: str) -> tuple[float, bool]:
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) >= _MEMO:
                self.memo.clear()
            found = self.memo[word] = NOTHING if self._hopeless(word) else self._look_up(word)
        return found

    def _look_up(self, word: str) -> tuple[float, bool]:
        meant = restore_word(word, self.costs, self.common)
        weight = max((self.weights.get(b, 0.0) for b in _beginnings(meant)), default=0.0)
        restored = weight > 0 and meant not in word
        for other in readings(word, self.costs, self.common):
            high = max((self.weights.get(b, 0.0) for b in _sure(_beginnings(other))), default=0.0)
            if high > weight:
                weight, restored = high, True
        return (weight, restored) if weight > 0 else NOTHING

    def look_up_run(self, run: str) -> tuple[float, bool]:
        """Of single characters put together: the words that the lattice ends, and words that begin and end at any character."""
        weight, restored = self.look_up(run)
        meant = restore_word(run, self.costs)
        for word in word_ends(meant, self.costs, self.common):
            high = max((self.weights.get(b, 0.0) for b in _sure(_beginnings(word))), default=0.0)
            if high > weight:
                weight, restored = high, True
        for a in range(len(meant) - 2):
            for b in range(a + 3, min(len(meant), a + self.longest) + 1):
                part = meant[a:b]
                high = max(self.weights.get(e, 0.0) for e in (f"{part}$", *_sure([part])))
                if high > weight:
                    weight, restored = high, True
        return weight, restored

    def matrix(self, texts: Sequence[str | None]) -> np.ndarray:
        return np.array([self._statistics(t) for t in texts]).reshape(len(texts), len(STATISTICS))

    def _statistics(self, text: str | None) -> list[float]:
        words = (text or "").lower().split()
        alone = b"".join([b"1" if len(w) == 1 else b"0" for w in words])
        if b"1" * SPACED in alone:  # a run of spaced characters
            found = restore(text, self.look_up, self.look_up_run)
        else:
            memo, look_up = self.memo, self.look_up
            found = [memo[w] if w in memo else look_up(w) for w in words]
        if not found:
            return [0.0] * len(STATISTICS)
        hit = [f for f in found if f[0] > 0]
        hits = [w for w, _ in hit]
        strong = sum(w >= 2.5 for w in hits)
        n = len(found)
        return [
            float(np.log1p(n)), float(strong), float(len(hits)), strong / n, len(hits) / n,
            sum(hits) / n, max(hits, default=0.0), float(sum(r for _, r in hit)),
        ]

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        return self.forest.probability(self.matrix(texts))[:, None]


def _weights(rows: list, n0: str, n1: str, total0: float, total1: float) -> dict[str, float]:
    """Lower bounds of the log ratio of document frequencies, for entries that speak for toxic documents."""
    out = {}
    for r in rows:
        a, b = r[n1], r[n0]
        if a < SUPPORT:
            continue
        odds = np.log((a + 0.5) / (total1 + 1)) - np.log((b + 0.5) / (total0 + 1))
        low = odds - np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        if low > 0.7:
            out[r["entry"]] = float(low)
    return out


def train(docs: DataFrame, labels: DataFrame, learn: Column, limit: int = TRAIN_DOCS) -> Model:
    """Counts the characters of all documents, then fits lexicon and trees on the labelled sample.

    The sample is cut in two: the trees see each half through the other half's lexicon. Without
    labelled documents the lexicon is empty and the score constant.
    """
    words = count_words(docs)
    costs, common = character_costs(characters_of(words)), common_words(words)
    sample = labelled(docs, labels, "toxic", learn, limit)
    sample = sample.withColumn("half", (uniform(F.col("doc_id"), seed="half") < 0.5).cast("int"))
    sample = sample.select("doc_id", "half", F.col("label").cast("int").alias("label"), "text")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, str] = {}

        def meant(word: str) -> str:
            if word not in memo:
                if len(memo) >= _MEMO:
                    memo.clear()
                memo[word] = restore_word(word, costs, common)
            return memo[word]

        for batch in batches:
            for block in blocks(batch, "text"):
                part = block.to_pydict()
                seen: list[Counter] = [Counter() for _ in range(4)]
                for half, label, text in zip(part["half"], part["label"], part["text"], strict=True):
                    words = set(restore(text, meant))
                    seen[2 * half + label].update({b for w in words for b in _beginnings(w)})
                keys = list(set().union(*seen))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), *[pa.array([c[k] for k in keys], pa.int64()) for c in seen]],
                    names=["entry", "a0", "a1", "b0", "b1"],
                )

    counted = sample.mapInArrow(entries, "entry string, a0 long, a1 long, b0 long, b1 long").groupBy("entry")
    counted = counted.agg(*[F.sum(c).alias(c) for c in ("a0", "a1", "b0", "b1")])
    counted = counted.withColumn("n0", F.expr("a0 + b0")).withColumn("n1", F.expr("a1 + b1"))
    best = counted.where(F.col("n1") >= SUPPORT).where("n1 > n0 * 0.05")
    best = best.orderBy(F.expr("(n1 + 0.5) / (n0 + 0.5) * sqrt(n1)").desc(), "entry").limit(LEXICON).collect()
    totals = {(r["half"], r["label"]): r["count"] for r in sample.groupBy("half", "label").count().collect()}
    t = {(h, y): float(totals.get((h, y), 0)) for h in (0, 1) for y in (0, 1)}
    by_half = [  # the lexicon of the other half
        _weights(best, "b0", "b1", t[1, 0], t[1, 1]),
        _weights(best, "a0", "a1", t[0, 0], t[0, 1]),
    ]
    blank = trees.constant(0.5)
    seen_by = [Model(costs, w, blank, common) for w in by_half]
    found = []
    for half in (0, 1):
        part = sample.where(F.col("half") == half).select("doc_id", "label", "text")
        found.append(rows_of(part, "text", seen_by[half].matrix, STATISTICS).toPandas())
    rows = np.concatenate([f[["label", *STATISTICS]].sort_values(["label", *STATISTICS]).to_numpy(float) for f in found])
    forest = trees.fit(rows[:, 1:], rows[:, 0], trees=40, depth=3)
    weights = _weights(best, "n0", "n1", t[0, 0] + t[1, 0], t[0, 1] + t[1, 1])
    return Model(costs, weights, forest, common)


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` per row of ``docs``: probability that a document is toxic, from its whole text.

    Null texts count as empty; all empty texts share a score. Repeated rows score alike, and an empty
    table gives an empty result.
    """
    return rows_of(pick(docs, "doc_id", "text"), "text", model.score, ["score"])


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; documents whose remainder is 2 are held out."""
    docs = read(spark, sf_dir, "documents")
    model = train(docs, read(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 4) != 2)
    return toxicity_scores(docs, model).select(
        "doc_id",
        (remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
