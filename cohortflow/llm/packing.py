"""Best-fit packing of token pieces into sequences, after a Martello-Toth dominance reduction.

Lengths are whole numbers up to the capacity, so a histogram of them is all that planning needs: at
most ``capacity`` counts, whatever the number of documents. On it small sets that provably dominate
every alternative are fixed first (Martello and Toth's reduction, applied to whole length classes at
once); the rest goes through best-fit decreasing, again class by class. The plan is a list of bin
patterns with multiplicities, no longer than a few times the capacity.

The pieces themselves are tokenised once and written to the shared folder. Each is numbered within its
length, first within its task, then by the counts of the tasks before, and looks its place up in the
plan. No piece is sorted or grouped.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.llm.common import pick, read, small
from cohortflow.llm.quality import blocks
from cohortflow.session import stage

CAPACITY = 1024
END = 2  #: the id that ends a document
#: Names of the vocabulary: for the tokenizers library, and as ranks for the faster tiktoken.
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Texts with longer runs without white space go to tokenizers, whose time does not grow with their square.
LONG_RUN = re.compile(r"\S{4000}")
SPECIAL = "<|endoftext|>"
_SHIFT = 40


@lru_cache(maxsize=2)
def _encoders(vocabulary: str, ranks: str):
    import base64
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(ranks), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return fast, Tokenizer.from_file(public_tokenizers.path(vocabulary))


def token_ids(text: str | None, vocabulary: str = VOCABULARY, ranks: str = RANKS) -> np.ndarray:
    """Ids of a text as the tokenizers library gives them without added special tokens, then ``END``.

    tiktoken gives the same ids several times faster; texts it would treat otherwise (a special
    token's name) or slowly (very long runs) go to tokenizers. A null text counts as empty.
    """
    fast, exact = _encoders(vocabulary, ranks)
    text = text or ""
    if SPECIAL in text or LONG_RUN.search(text):
        ids = exact.encode(text, add_special_tokens=False).ids
    else:
        ids = fast.encode_ordinary(text)
    return np.array([*ids, END], dtype="<u4")


def pieces(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A written table of pieces: ``doc_id, piece, start, length, ids_crc32, part, place`` (and ``ids``).

    Documents longer than the capacity are cut into full pieces; the first may be shorter. ``place``
    numbers the pieces of one length within ``part``, the task that made them.
    """
    narrow = pick(docs, "doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    columns = [f"doc_id {kind}", "piece int", "start long", "length long", "ids_crc32 long", "part int", "place long"]
    names = [c.split()[0] for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for block in blocks(batch, "text"):
                out: list[tuple] = []
                for row, text in enumerate(block.column("text").to_pylist()):
                    ids = token_ids(text)
                    first = len(ids) - (-(-len(ids) // capacity) - 1) * capacity
                    for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
                        start = max(0, end - capacity)
                        raw = ids[start:end]
                        n = len(raw)
                        out.append((row, piece, start, n, zlib.crc32(raw.tobytes()), part, seen[n], raw))
                        seen[n] += 1
                rows, *values, raws = zip(*out, strict=True)
                arrays = [block.column("doc_id").take(pa.array(rows, pa.int64()))]
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                arrays += [pa.array(v, t) for v, t in zip(values, types, strict=True)]
                if with_ids:
                    arrays.append(pa.array([r.astype(np.int32) for r in raws], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=names + ["ids"] * with_ids)

    return stage(narrow.mapInArrow(run, ", ".join(columns + ["ids array<int>"] * with_ids)), "pack-pieces")


class Pattern(NamedTuple):
    """``bins`` sequences that each hold these ``(length, copies)``."""

    bins: int
    holds: tuple[tuple[int, int], ...]


def _reachable(lengths: list[int], room: int) -> int:
    """Bit set of the sums up to ``room`` that two or more items of these lengths can make."""
    mask = (1 << (room + 1)) - 1
    any_sum = 1
    for n in lengths:
        step = n
        while step <= room:
            any_sum |= (any_sum << step) & mask
            step *= 2
    two = 0
    for n in lengths:
        two |= ((any_sum & ~1) << n) & mask
    return two


def reduce_dominated(count: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Fixes dominating sets and takes their items out of ``count`` (items per length), in place.

    A set dominates all others that hold its item j if it fills the sequence, or if no more than one
    partner fits beside j and the set has the largest such partner, or if no two or more items that
    fit beside j together exceed that partner. Such a set can be fixed without losing the optimum.
    """
    fixed: list[Pattern] = []

    def fix(a: int, b: int | None) -> None:
        bins = int(count[a] if b is None else count[a] // 2 if a == b else min(count[a], count[b]))
        if bins:
            count[a] -= bins
            if b is not None:
                count[b] -= bins
            fixed.append(Pattern(bins, ((a, 1),) if b is None else ((a, 2),) if a == b else ((a, 1), (b, 1))))

    fix(capacity, None)
    for n in range(capacity - 1, capacity // 2, -1):
        fix(n, capacity - n)
    if capacity % 2 == 0:
        fix(capacity // 2, capacity // 2)
    changed = True
    while changed:
        changed = False
        for n in np.flatnonzero(count)[::-1]:
            n = int(n)
            while count[n]:
                count[n] -= 1  # the partners of one item of this length
                lengths = [int(k) for k in np.flatnonzero(count[: capacity - n + 1])]
                count[n] += 1
                if not lengths:
                    fix(n, None)
                    changed = True
                    break
                partner = lengths[-1]
                above = _reachable(lengths, capacity - n) >> (partner + 1)
                if above:
                    break
                before = count[n]
                fix(n, partner)
                if count[n] == before:  # one item left that would be its own partner
                    break
                changed = True
    return fixed


def best_fit(count: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Best-fit decreasing over length classes: each item goes to the fullest sequence it fits into.

    Sequences with equal room are one group, and the items of a class fill groups at once, which gives
    what placing them one by one would give.
    """
    groups: dict[int, list[tuple[int, tuple]]] = {}
    for n in np.flatnonzero(count)[::-1]:
        n, left = int(n), int(count[n])
        while left:
            room = min((r for r in groups if r >= n), default=capacity)
            fits = room // n
            if room == capacity and room not in groups:
                bins, holds = -(-left // fits), ()
            else:
                bins, holds = groups[room].pop()
                if not groups[room]:
                    del groups[room]
            full = min(bins, left // fits)
            if full:
                groups.setdefault(room - n * fits, []).append((full, (*holds, (n, fits))))
                left -= full * fits
                bins -= full
            if bins and left and left < fits:
                groups.setdefault(room - n * left, []).append((1, (*holds, (n, left))))
                left, bins = 0, bins - 1
            if bins and holds:
                groups.setdefault(room, []).append((bins, holds))
    return [Pattern(bins, holds) for found in groups.values() for bins, holds in found]


class Plan(NamedTuple):
    """Runs of piece numbers within a length: where each starts, and the sequences it fills."""

    key: np.ndarray
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The packing of ``histogram`` (pieces per length) as runs, sorted by length and number."""
    count = np.zeros(capacity + 1, np.int64)
    for n, many in histogram.items():
        count[n] = many
    patterns = reduce_dominated(count, capacity) + best_fit(count, capacity)
    used = np.zeros(capacity + 1, np.int64)
    runs, sequence = [], 0
    for bins, holds in patterns:
        offset = 0
        for n, copies in holds:
            runs.append(((n << _SHIFT) + int(used[n]), copies, sequence, offset))
            used[n] += bins * copies
            offset += n * copies
        sequence += bins
    columns = np.array(sorted(runs), np.int64).reshape(-1, 4).T
    return Plan(*columns)


def place(found: Plan, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces of these lengths and numbers."""
    key = (length << _SHIFT) + number
    run = np.searchsorted(found.key, key, side="right") - 1
    inside = key - found.key[run]
    sequence = found.sequence[run] + inside // found.copies[run]
    return sequence, found.offset[run] + inside % found.copies[run] * length


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a written table of ``pieces``; an empty table stays empty.

    Repeated documents are packed as often as they occur; null ids are kept.
    """
    held = stage(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = held.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    found = plan({r["length"]: r["n"] for r in histogram}, capacity)
    upto = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, 0))
    ahead = small(held.select("part", "length", (upto - F.col("n")).alias("ahead")), held.count())
    numbered = cut.join(ahead, ["part", "length"]).withColumn("number", F.col("place") + F.col("ahead"))
    numbered = numbered.drop("part", "place", "ahead")
    kept = [c for c in numbered.columns if c != "number"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = place(found, batch.column("length").to_numpy(), batch.column("number").to_numpy())
            arrays = [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "sequence_id", "offset"])

    types = [f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema if f.name != "number"]
    return numbered.mapInArrow(run, ", ".join([*types, "sequence_id long", "offset long"]))


def sequences(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, ids, lengths``: the packed sequences; at most ``capacity`` ids meet in a group."""
    packed = pack(pieces(docs, capacity, with_ids=True), capacity)
    held = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return packed.groupBy("sequence_id").agg(held.alias("h")).select(
        "sequence_id", F.flatten("h.ids").alias("ids"), F.col("h.length").alias("lengths")
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1,024 tokens."""
    packed = pack(pieces(read(spark, sf_dir, "documents")))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
