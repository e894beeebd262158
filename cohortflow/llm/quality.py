"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a document come from its text alone: lengths, character classes, repetition of
words, word pairs and lines, punctuation habits. The trees are fitted in the driver on a bounded sample
of labelled documents, flattened into arrays, and every text is scored where it lies, in one pass
without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import trees
from cohortflow.llm.common import pick, read, uniform

#: Labelled documents that a classifier is fitted on, at most (in expectation: a hash threshold chooses them).
TRAIN_DOCS = 20_000
#: Bytes of text that become Python objects at a time, at most (or one text).
BLOCK_BYTES = 4_000_000

STATISTICS = (
    "bytes", "words", "lines", "word_length", "longest_word", "letters", "capitals", "digits", "blanks", "marks",
    "pipes", "high_bytes", "entropy", "distinct_words", "top_word", "top_pair", "doubled", "distinct_lines",
    "line_words", "final_stops", "marked_words", "capital_words", "short_words", "colons", "braces",
)

_CLASS = np.zeros((256, 9))
_CLASS[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256)), 0] = 1  # letters, roughly
_CLASS[65:91, 1] = 1
_CLASS[48:58, 2] = 1
_CLASS[[9, 10, 11, 12, 13, 32], 3] = 1
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()], 4] = 1
_CLASS[ord("|"), 5] = 1
_CLASS[128:, 6] = 1
_CLASS[[ord(":"), ord("=")], 7] = 1
_CLASS[[ord(c) for c in "{}[]<>();"], 8] = 1
_PLAIN_ENDS = frozenset(".,;:?!\"')")


def statistics(text: str | None) -> list[float]:
    """The values of ``STATISTICS``; a null text counts as empty, and an empty one has zeros throughout."""
    raw = (text or "").encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    shares = (counts @ _CLASS) / n
    p = counts[counts > 0] / n
    words = text.split()
    w = max(len(words), 1)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    length = max(len(lines), 1)
    pairs = Counter(zip(words, words[1:], strict=False))
    ends = [x[-1] for x in words]
    marked = sum(not e.isalnum() and e not in _PLAIN_ENDS for e in ends)
    doubled = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        np.log1p(n),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        sum(map(len, words)) / w,
        np.log1p(max(map(len, words), default=0)),
        shares[0],
        shares[1],
        shares[2],
        shares[3],
        shares[4],
        shares[5],
        shares[6],
        float(-(p * np.log2(p)).sum()),
        len(seen) / w,
        max(seen.values(), default=0) / w,
        max(pairs.values(), default=0) / w,
        doubled / w,
        len(set(lines)) / length,
        np.log1p(len(words) / length),
        sum(x.rstrip()[-1] in ".!?" for x in lines) / length,
        marked / w,
        sum(x.isupper() and len(x) > 1 for x in words) / w,
        sum(len(x) <= 3 for x in words) / w,
        shares[7],
        shares[8],
    ]


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have ``most`` bytes at most (or are a single row)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def matrix(texts: Sequence[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts]).reshape(len(texts), len(STATISTICS))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as an empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % modulus


def labelled(docs: DataFrame, labels: DataFrame, column: str, learn: Column, limit: int = TRAIN_DOCS) -> DataFrame:
    """``doc_id, text, label`` of a bounded sample of the labelled documents that ``learn`` (on doc_id) admits.

    Ids that are labelled both ways, or null, teach nothing. The sample is chosen by a hash of the id.
    """
    known = pick(labels, "doc_id", column).where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & learn)
    known = known.groupBy("doc_id").agg(F.min(column).alias("label"), F.max(column).alias("other"))
    known = known.where("label = other AND label IN (0, 1)").select("doc_id", F.col("label").cast("double").alias("label"))
    count = known.count()
    sample = known.where(uniform(F.col("doc_id"), seed="labelled") < limit / max(count, 1))
    return pick(docs, "doc_id", "text").join(F.broadcast(sample), "doc_id")  # about ``limit`` rows


def rows_of(df: DataFrame, text: str, make: Callable[[Sequence], np.ndarray], columns: Sequence[str]) -> DataFrame:
    """``df`` with the column ``text`` replaced by double ``columns`` that ``make`` computes from blocks of texts."""
    kept = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, text):
                values = make(part.column(text).to_pylist())
                arrays = [part.column(c) for c in kept] + [pa.array(values[:, j]) for j in range(len(columns))]
                yield pa.RecordBatch.from_arrays(arrays, names=kept + list(columns))

    types = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + [f"`{c}` double" for c in columns])
    return df.mapInArrow(run, types)


def train(docs: DataFrame, labels: DataFrame, learn: Column, limit: int = TRAIN_DOCS) -> trees.Forest:
    """The forest for ``labels.quality``; constant where nothing is labelled."""
    sample = labelled(docs, labels, "quality", learn, limit).select("label", "doc_id", "text")
    found = rows_of(sample, "text", matrix, STATISTICS).toPandas()  # about ``limit`` rows
    found = found.sort_values(["doc_id", *STATISTICS], kind="stable")
    return trees.fit(found[list(STATISTICS)].to_numpy(float), found["label"].to_numpy(float))


def quality_scores(docs: DataFrame, forest: trees.Forest) -> DataFrame:
    """``doc_id, score`` per row of ``docs``: probability that a document is good, from its whole text.

    Null texts count as empty; all empty texts share a score. Repeated rows score alike, and an empty
    table gives an empty result.
    """
    narrow = pick(docs, "doc_id", "text")

    def score(texts: Sequence[str | None]) -> np.ndarray:
        return forest.probability(matrix(texts))[:, None]

    return rows_of(narrow, "text", score, ["score"])


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, with all their columns."""
    forest = train(docs, labels, F.lit(True))
    inner = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*inner)
    text = inner[docs.columns.index("text")]

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, text):
                scores = forest.probability(matrix(part.column(text).to_pylist()))
                yield part.filter(pa.array(scores >= least))

    return rows.mapInArrow(good, rows.schema).toDF(*docs.columns)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; documents whose remainder is 1 are held out."""
    docs = read(spark, sf_dir, "documents")
    forest = train(docs, read(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 3) != 1)
    return quality_scores(docs, forest).select(
        "doc_id",
        (remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
