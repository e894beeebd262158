"""Cross-tokenizer alignment: lockstep vectorised merging of two token streams.

Both tokenizers cut the same bytes. A cut of both is a byte offset where a token of either ends; between
two such offsets lies a group, and every token of A in it is linked with every token of B in it.

The two lists of end offsets are merged for all documents of a block at once: one state vector holds a
pointer into A and one into B for every lane, and each step moves the pointer whose token ends first, or
both where they end together, which is a cut. Lanes that are through are compacted away. A long document
has several lanes, each for a run of its A tokens, so the number of steps is bounded too.

How many documents hold an id pair is counted over all documents. The links of a document are written
once, as distinct pairs with their numbers; no text is tokenised twice.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.llm.common import pick, read
from cohortflow.llm.quality import blocks
from cohortflow.session import stage

#: Names of the vocabularies: A as ranks of the byte-level BPE, B as a sentencepiece model.
RANKS_A, MODEL_B = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: A tokens of one lane, at most.
LANE = 512
#: Bytes of text that are aligned at a time, at most (or one text).
TEXT_BYTES = 1_000_000
#: Links of a block that are spelled out at a time.
LINKS = 4_000_000
#: Id pairs that are broadcast, at most (24 bytes each); pairs that more documents hold go first.
BROADCAST_PAIRS = 1_000_000


class Tokenizers(NamedTuple):
    """Two encoders of a text, and the bytes of every id of either."""

    encode_a: Callable[[str], list[int]]
    encode_b: Callable[[list[str]], list[list[int]]]
    bytes_a: list[bytes]
    bytes_b: list[bytes]


@lru_cache(maxsize=2)
def public_pair(ranks: str = RANKS_A, model: str = MODEL_B) -> Tokenizers:
    """A: byte-level BPE (tiktoken, with the ids of the tokenizers library); B: sentencepiece."""
    import public_tokenizers
    import sentencepiece
    import tiktoken

    with open(public_tokenizers.path(ranks), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    # No special tokens, so their names in a text are text.
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    bytes_a = [b""] * (max(table.values()) + 1)
    for token, i in table.items():
        bytes_a[i] = token
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
    bytes_b = []
    for i in range(pieces.vocab_size()):
        piece = pieces.id_to_piece(i)
        bytes_b.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    return Tokenizers(fast.encode_ordinary, lambda texts: pieces.encode(texts, num_threads=1), bytes_a, bytes_b)


def merge_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Rows ``(a, b)`` of tokens that end together, in order: the cuts of all documents.

    ``ends_*`` are end offsets of all tokens of a block, growing over all documents; ``first_*`` say
    where the tokens of each document begin, with the number of all tokens at the end.
    """
    counts = np.diff(first_a)
    lanes = -(-counts // lane)
    doc = np.repeat(np.arange(len(counts)), lanes)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    a = first_a[doc] + nth * lane
    stop_a = np.minimum(a + lane, first_a[doc + 1])
    # A lane goes on to the end of its last A token, and starts in B behind the A token before its own.
    before = np.where(nth > 0, ends_a[np.maximum(a - 1, 0)], -1)
    b = np.maximum(np.searchsorted(ends_b, before, side="right"), first_b[doc])
    stop_b = np.minimum(np.searchsorted(ends_b, ends_a[stop_a - 1], side="right"), first_b[doc + 1])
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    open_ = (a < stop_a) & (b < stop_b)
    while True:
        if not open_.all():
            a, b, stop_a, stop_b = a[open_], b[open_], stop_a[open_], stop_b[open_]
        if not len(a):
            break
        x, y = ends_a[a], ends_b[b]
        cut = x == y
        found_a.append(a[cut])
        found_b.append(b[cut])
        a = a + (x <= y)
        b = b + (y <= x)
        open_ = (a < stop_a) & (b < stop_b)
    cuts = np.stack([np.concatenate(found_a), np.concatenate(found_b)], axis=1)
    return cuts[np.argsort(cuts[:, 0], kind="stable")]


class Aligned(NamedTuple):
    """What one block of documents gives; ``keys`` and ``times`` lie one document after the other."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    keys: np.ndarray
    times: np.ndarray
    n_keys: np.ndarray


def align(texts: list[str | None], pair: Tokenizers, lane: int = LANE) -> Aligned:
    """Groups and links of ``texts``. Without text, or where a tokenizer changes the bytes, there are none."""
    whole = [t or "" for t in texts]
    ids_a = [pair.encode_a(" " + t) if t else [] for t in whole]
    ids_b = pair.encode_b(whole)
    for i, text in enumerate(whole):
        raw = (" " + text).encode()
        same = text and b"".join(map(pair.bytes_a.__getitem__, ids_a[i])) == raw
        if not same or b"".join(map(pair.bytes_b.__getitem__, ids_b[i])) != raw:
            ids_a[i], ids_b[i] = [], []
    n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
    first_a, first_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
    flat_a, flat_b = (
        np.fromiter(chain.from_iterable(ids), np.int64, n.sum()) for ids, n in ((ids_a, n_a), (ids_b, n_b))
    )
    # Documents have equal bytes in A and B, so offsets that run on over all of them stay comparable.
    size_a, size_b = (np.fromiter(map(len, table), np.int64, len(table)) for table in (pair.bytes_a, pair.bytes_b))
    ends_a, ends_b = np.cumsum(size_a[flat_a]), np.cumsum(size_b[flat_b])
    cuts = merge_cuts(ends_a, ends_b, first_a, first_b, lane)
    doc = np.searchsorted(first_a, cuts[:, 0], side="right") - 1
    n_groups = np.bincount(doc, minlength=len(texts))
    # Every document ends with a cut, so groups reach from cut to cut over all documents.
    in_a, in_b = (np.diff(np.concatenate([[-1], cuts[:, k]])) for k in (0, 1))
    n_links = np.zeros(len(texts), np.int64)
    np.add.at(n_links, doc, in_a * in_b)
    digests = _digests(flat_a, flat_b, cuts, n_groups, pair)
    keys, times, n_keys = _pairs(flat_a, flat_b, cuts, in_a, in_b, doc, len(texts), pair)
    return Aligned(n_a, n_b, n_groups, n_links, digests, keys, times, n_keys)


@lru_cache(maxsize=1)
def _written(size: int) -> list[str]:
    """Every id with what may follow it: ``,`` within a side, ``|`` behind A, ``;`` behind B."""
    return [f"{i}{mark}" for i in range(size) for mark in ",|;"]


def _digests(a: np.ndarray, b: np.ndarray, cuts: np.ndarray, n_groups: np.ndarray, pair: Tokenizers) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per document; the empty text without groups."""
    line = np.zeros(len(a) + len(b), np.int64)
    group_a = np.searchsorted(cuts[:, 0], np.arange(len(a)))
    group_b = np.searchsorted(cuts[:, 1], np.arange(len(b)))
    mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    mark_a[cuts[:, 0]], mark_b[cuts[:, 1]] = 1, 2
    before_b = np.concatenate([[0], cuts[:, 1] + 1])
    line[np.arange(len(a)) + before_b[group_a]] = a * 3 + mark_a
    line[np.arange(len(b)) + cuts[group_b, 0] + 1] = b * 3 + mark_b
    written = _written(max(len(pair.bytes_a), len(pair.bytes_b)))
    out, start, done = [], 0, 0
    for n in n_groups:
        if not n:
            out.append("")
            continue
        done += int(n)
        stop = int(cuts[done - 1].sum()) + 2
        text = "".join(map(written.__getitem__, line[start:stop].tolist()))
        out.append(hashlib.sha256(text[:-1].encode()).hexdigest())
        start = stop
    return out


def _pairs(a, b, cuts, in_a, in_b, doc, docs: int, pair: Tokenizers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``a << 32 | b`` per document, how often each is linked there, and how many there are."""
    width_b, width = len(pair.bytes_b), len(pair.bytes_a) * len(pair.bytes_b)
    keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    size = in_a * in_b
    upto = np.cumsum(size)
    start = 0
    while start < len(size):
        stop = int(np.searchsorted(upto, (upto[start - 1] if start else 0) + LINKS, side="right"))
        if stop == start:  # one group of very many links: pairs of distinct ids, with their counts
            stop = start + 1
            ids, n = zip(*(np.unique(x[e - k + 1 : e + 1], return_counts=True) for x, e, k in (
                (a, cuts[start, 0], in_a[start]), (b, cuts[start, 1], in_b[start]))), strict=True)
            keys.append((doc[start] * width + ids[0][:, None] * width_b + ids[1]).ravel())
            times.append((n[0][:, None] * n[1]).ravel())
        else:
            part, of = slice(start, stop), np.repeat(np.arange(start, stop), size[start:stop])
            nth = np.arange(len(of)) - np.repeat(upto[part] - size[part] - (upto[start] - size[start]), size[part])
            at_a = cuts[of, 0] - in_a[of] + 1 + nth // in_b[of]
            at_b = cuts[of, 1] - in_b[of] + 1 + nth % in_b[of]
            found, n = np.unique(doc[of] * width + a[at_a] * width_b + b[at_b], return_counts=True)
            keys.append(found)
            times.append(n)
        start = stop
    if len(keys) > 2:
        keys, where = np.unique(np.concatenate(keys), return_inverse=True)
        summed = np.zeros(len(keys), np.int64)
        np.add.at(summed, where, np.concatenate(times))
    else:  # one part, which is distinct and sorted already
        keys, summed = keys[-1], times[-1]
    n_keys = np.bincount(keys // width, minlength=docs)
    id_a, id_b = np.divmod(keys % width, width_b)
    return (id_a << 32) | id_b, summed, n_keys


def aligned(docs: DataFrame, tokenizers: Callable[[], Tokenizers] = public_pair, lane: int = LANE) -> DataFrame:
    """A written table: ``row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times``."""
    narrow = pick(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    kind = narrow.schema["doc_id"].dataType.simpleString()
    numbers = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers()
        for batch in batches:
            for block in blocks(batch, "text", TEXT_BYTES):
                got = align(block.column("text").to_pylist(), pair, lane)
                offsets = pa.array([0, *accumulate(got.n_keys.tolist())], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("row"),
                        block.column("doc_id"),
                        *[pa.array(getattr(got, name), pa.int64()) for name in numbers],
                        pa.array(got.digests, pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(got.keys, pa.int64())),
                        pa.ListArray.from_arrays(offsets, pa.array(got.times, pa.int64())),
                    ],
                    names=["row", "doc_id", *numbers, "groups_sha256", "pairs", "times"],
                )

    columns = ["row long", f"doc_id {kind}", *[f"{n} long" for n in numbers]]
    columns += ["groups_sha256 string", "pairs array<long>", "times array<long>"]
    return stage(narrow.mapInArrow(run, ", ".join(columns)), "align-documents")


def pair_counts(links: DataFrame) -> DataFrame:
    """A written table ``pair, held, best``: documents that hold an id pair, and whether its A id has no higher one."""
    held = links.groupBy("pair").agg(F.count(F.lit(1)).alias("held"))
    # An A id has no more pairs than B has ids.
    highest = F.max("held").over(W.partitionBy(F.shiftright("pair", 32)))
    return stage(held.select("pair", "held", (F.col("held") == highest).alias("best")), "align-pairs")


def alignment(docs: DataFrame, tokenizers: Callable[[], Tokenizers] = public_pair) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row of ``docs``.

    Null and empty texts, and texts whose bytes a tokenizer changes, have no tokens: zeros and an empty
    digest. Rows that repeat an id are documents of their own. An empty table gives an empty result.
    """
    found = aligned(docs, tokenizers)
    links = found.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))
    counts = pair_counts(links)
    sums = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("held") * F.col("times")).alias("count_sum"),
    ]
    pairs, held = counts.agg(F.count(F.lit(1)), F.sum("held")).first()
    if pairs <= BROADCAST_PAIRS:
        parts = [links.join(F.broadcast(counts), "pair")]
    else:
        # All links over a number of pairs: no more pairs than that are held as often, and no key behind
        # them is held more often.
        often = held // BROADCAST_PAIRS + 1
        hot = counts.where(F.col("held") >= often)
        marked = links.join(F.broadcast(hot), "pair", "left")
        rest = marked.where("held IS NULL").select("pair", "row", "times")
        parts = [marked.where("held IS NOT NULL"), rest.join(counts.where(F.col("held") < often), "pair")]
    summed = [part.groupBy("row").agg(*sums) for part in parts]
    per_row = summed[0]
    if len(summed) > 1:
        per_row = summed[0].unionByName(summed[1]).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    nothing = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("n_best", "count_sum")]
    return found.join(per_row, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", *nothing, "groups_sha256"
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents aligned between the byte-level BPE of 50,257 ids and the sentencepiece model of 32,000."""
    return alignment(read(spark, sf_dir, "documents"))
