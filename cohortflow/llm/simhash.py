"""SimHash near-duplicates through vantage-point trees over the fingerprints.

1. One pass over the texts gives a 64-bit fingerprint per document: bit by bit the majority of the XXH64
   hashes of its word shingles. Equal fingerprints are one node from here on.
2. Fingerprints that differ in at most ``bits`` bits differ by at most one in one of ``bits // 2 + 1`` parts
   of the 64 bits. The Hamming distance within a part is a metric of its own, and it spreads far more,
   measured against the reach of one, than the distance over all bits does. So every part has a tree.
3. A tree is grown in the driver on a bounded sample of the fingerprints. Each node holds a vantage point
   and a radius; what lies within goes to the inner branch, the rest to the outer one. The vantage
   point and the radius that promise the fewest comparisons are taken; where none promises fewer, the
   branch ends in a shard.
4. Every fingerprint is at home in one shard of each tree and visits all shards whose boundary lies within
   its reach: the triangle inequality rules the others out. Homes are compared with visitors, shard by
   shard and exactly, over all 64 bits. Shards with more rows than a task should hold are compared in
   blocks. A shard gives a spanning forest of its links, never all pairs; components join the forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import connected, pick, read, small
from cohortflow.llm.quality import blocks
from cohortflow.session import stage

WORDS, BITS, SEED = 3, 3, 42
#: Fingerprints that trees are grown on, at most (in expectation: a hash chooses them), and at most every eighth.
SAMPLE = 65_536
#: Fingerprints at home in a shard, about; sampled ones among them at least.
SHARD_ROWS, SHARD_SAMPLE = 1_024, 8
#: Vantage points that a node tries. A split has to save this share of the comparisons.
VANTAGES, SAVED = 6, 0.05
#: Homes and visitors that one task compares at a time, at most.
BLOCK_HOMES, BLOCK_VISITORS = 4_096, 65_536
_PAIRS = 4_000_000


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority bits of the shingles' hashes, repeats included; 0 without words. A to Z are lower-cased."""
    split = (text or "").encode("utf-8", "replace").lower().split()
    if not split:
        return 0
    joined = b" ".join(split)
    ends = np.cumsum([len(w) + 1 for w in split]) - 1
    k = min(words, len(split))
    stops = ends[k - 1 :].tolist()
    starts = [0, *(ends[: len(split) - k] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[i:j], SEED) for i, j in zip(starts, stops, strict=True)]
    held = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8_192):
        part = np.array(hashes[at : at + 8_192], "<u8").view(np.uint8).reshape(-1, 8)
        held += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * held > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """A written table ``doc_id, print``, the fingerprint as a signed long."""
    narrow = pick(docs, "doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                found = np.array([fingerprint(t, words) for t in block.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "print"]
                )

    return stage(narrow.mapInArrow(run, f"doc_id {kind}, print long"), "simhash-prints")


class Tree(NamedTuple):
    """Nodes of a vantage-point tree over the bits of ``mask``. A branch below 0 is the shard ``-1 - branch``."""

    mask: int
    reach: int
    vantage: np.ndarray
    radius: np.ndarray
    inner: np.ndarray
    outer: np.ndarray


def parts(bits: int) -> list[tuple[int, int]]:
    """``(mask, reach)``: what differs in ``bits`` bits at most differs in ``reach`` at most within one mask."""
    count = bits // 2 + 1
    ends = [64 * i // count for i in range(count + 1)]
    return [(((1 << (b - a)) - 1) << a, 1) for a, b in zip(ends, ends[1:], strict=False)]


def grow(sample: np.ndarray, mask: int, reach: int, least: int) -> Tree:
    """A tree whose shards hold at least about ``least`` of the ``sample`` and less than twice as many, if they can."""
    points = sample & np.uint64(mask)
    vantage, radius, inner, outer = [], [], [], []
    shards = 0
    everything = np.arange(len(points))
    waiting = [(everything, everything, None)]
    while waiting:
        homes, visitors, parent = waiting.pop()
        best = _split(points, homes, visitors, reach, least)
        if best is None:
            place, shards = -1 - shards, shards + 1
        else:
            place = len(vantage)
            v, r = best
            vantage.append(v)
            radius.append(r)
            inner.append(0)
            outer.append(0)
            near, far = (np.bitwise_count(points[x] ^ v).astype(np.int64) for x in (homes, visitors))
            waiting.append((homes[near > r], visitors[far + reach > r], (place, outer)))
            waiting.append((homes[near <= r], visitors[far - reach <= r], (place, inner)))
        if parent:
            parent[1][parent[0]] = place
    return Tree(mask, reach, np.array(vantage, np.uint64), *(np.array(x, np.int64) for x in (radius, inner, outer)))


def _split(points, homes, visitors, reach: int, least: int) -> tuple[np.uint64, int] | None:
    """The vantage point and radius with the fewest comparisons of homes and visitors, or none."""
    if len(homes) < 2 * least:
        return None
    best, cost = None, (1 - SAVED) * len(homes) * len(visitors)
    for v in np.unique(points[homes[np.linspace(0, len(homes) - 1, VANTAGES).astype(int)]]):
        near, far = (
            np.bincount(np.bitwise_count(points[x] ^ v), minlength=66 + reach).cumsum() for x in (homes, visitors)
        )
        r = np.arange(65)
        upto, seen = near[r], far[r + reach]
        beyond = np.where(r >= reach, len(visitors) - far[np.maximum(r - reach, 0)], len(visitors))
        compared = upto * seen + (len(homes) - upto) * beyond
        compared = np.where((upto >= least) & (len(homes) - upto >= least), compared, np.inf)
        at = int(np.argmin(compared))
        if compared[at] < cost:
            best, cost = (v, at), compared[at]
    return best


def visits(tree: Tree, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``shard, row, home`` for every shard that a fingerprint may have partners in."""
    row = np.arange(len(prints))
    node = np.full(len(prints), 0 if len(tree.vantage) else -1)
    home = np.ones(len(prints), bool)
    points = prints & np.uint64(tree.mask)
    out = []
    while len(row):
        done = node < 0
        out.append((-1 - node[done], row[done], home[done]))
        node, row, home = node[~done], row[~done], home[~done]
        d = np.bitwise_count(points[row] ^ tree.vantage[node]).astype(np.int64)
        r = tree.radius[node]
        to_in, to_out = d - tree.reach <= r, d + tree.reach > r
        node, row, home = (
            np.concatenate([tree.inner[node[to_in]], tree.outer[node[to_out]]]),
            np.concatenate([row[to_in], row[to_out]]),
            np.concatenate([(home & (d <= r))[to_in], (home & (d > r))[to_out]]),
        )
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def planted(different: DataFrame, rows: int, bits: int) -> list[Tree]:
    """One tree per part, grown on a sample of the ``rows`` different fingerprints."""
    share = min(1 / 8, SAMPLE / max(rows, 1))
    chosen = F.pmod(F.xxhash64("print"), F.lit(1 << 30)) < int(share * (1 << 30))
    found = different.where(chosen).select("print").toPandas()["print"].to_numpy(np.int64)
    sample = np.sort(found).view(np.uint64)
    least = max(SHARD_SAMPLE, int(SHARD_ROWS * share / 2))
    return [grow(sample, mask, reach, least) for mask, reach in parts(bits)]


def placed(different: DataFrame, trees: list[Tree]) -> DataFrame:
    """A written table ``tree, shard, home, print``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("print").to_numpy()
            for i, tree in enumerate(trees):
                shard, row, home = visits(tree, prints.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), i, np.int32)), pa.array(shard.astype(np.int32)), pa.array(home), pa.array(prints[row])],
                    names=["tree", "shard", "home", "print"],
                )

    made = different.select("print").mapInArrow(run, "tree int, shard int, home boolean, print long")
    return stage(made, "simhash-placed")


def in_blocks(rows: DataFrame) -> DataFrame:
    """``rows`` with ``i, j``: homes in block ``i`` meet visitors in block ``j``; most shards are one block."""
    homes, seen = F.sum(F.col("home").cast("long")), F.count(F.lit(1))
    sizes = rows.groupBy("tree", "shard").agg(
        F.ceil(homes / BLOCK_HOMES).cast("int").alias("high"), F.ceil(seen / BLOCK_VISITORS).cast("int").alias("wide")
    )
    crowded = stage(sizes.where("high > 1 OR wide > 1"), "simhash-crowded")
    known = rows.join(small(crowded, crowded.count()), ["tree", "shard"], "left")
    high, wide = (F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) for c in ("high", "wide"))
    mine = F.pmod(F.xxhash64("print"), high).cast("int")
    theirs = F.pmod(F.xxhash64("print", F.lit(1)), wide).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    as_home = known.where("home").withColumn("i", mine).withColumn("j", F.explode(every(wide)))
    as_visitor = known.withColumn("j", theirs).withColumn("i", F.explode(every(high)))
    both = as_home.unionByName(as_visitor.withColumn("home", F.lit(False)))
    return both.select("tree", "shard", "i", "j", "home", "print")


def forest(homes: np.ndarray, visitors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``a, b``: a spanning forest of the links between homes and visitors."""
    points = np.unique(np.concatenate([homes, visitors]))
    of_homes, of_visitors = np.searchsorted(points, homes), np.searchsorted(points, visitors)
    label = np.arange(len(points))
    step = max(1, _PAIRS // max(len(visitors), 1))
    for start in range(0, len(homes), step):
        near = np.bitwise_count(homes[start : start + step, None] ^ visitors) <= bits
        a, b = np.nonzero(near)
        _unite(label, of_homes[start + a], of_visitors[b])
    ends = np.flatnonzero(label != np.arange(len(points)))
    return points[ends], points[label[ends]]


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Labels of linked points become equal, in place: the higher root hangs on the lower one, until none is left."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        up = label[label]
        while not np.array_equal(up, label):
            label[:] = up
            up = label[label]


def links(different: DataFrame, rows: int, bits: int = BITS) -> DataFrame:
    """A written table ``a, b`` of links that join all that is linked; ``rows`` counts the fingerprints."""
    blocked = in_blocks(placed(different, planted(different, rows, bits)))

    def run(table: pa.Table) -> pa.Table:
        home = table.column("home").to_numpy()
        prints = table.column("print").to_numpy().view(np.uint64)
        a, b = forest(prints[home], prints[~home], bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    found = blocked.groupBy("tree", "shard", "i", "j").applyInArrow(run, "a long, b long")
    return stage(found.distinct(), "simhash-links")


def near_prints(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``.

    Null, empty and blank texts have the fingerprint zero and are linked like any other. Repeated rows
    and texts with equal fingerprints are always together. Null ids are no candidates for the smallest;
    a component without any other id has none. An empty table gives an empty result.
    """
    prints = fingerprints(docs, words)
    different = stage(prints.groupBy("print").agg(F.min("doc_id").alias("low")), "simhash-different")
    known = connected(links(different, different.count(), bits), "simhash-rounds")
    named = different.join(known.withColumnRenamed("node", "print"), "print", "left")
    named = stage(named.select("print", F.coalesce("component", "print").alias("component"), "low"), "simhash-named")
    lowest = stage(named.groupBy("component").agg(F.min("low").alias("component_id")), "simhash-lowest")
    resolved = stage(named.join(lowest, "component").select("print", "component_id"), "simhash-resolved")
    digits = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return prints.join(resolved, "print").select("doc_id", digits, "component_id")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their fingerprint and component, three-word shingles and three bits."""
    return near_prints(read(spark, sf_dir, "documents"))
