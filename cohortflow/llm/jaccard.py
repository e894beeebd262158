"""Jaccard join of documents on word n-grams: prefix, length, positional and suffix filters.

1. One pass over the texts gives each document's set size and a digest of its set, and counts in how
   many documents the n-grams of each of ``CELLS`` hash cells occur.
2. A second pass orders every set by rarity (cell count, then hash) and keeps its prefix: two sets that
   are similar enough share a gram of their prefixes. Equal sets are one node from here on.
3. Prefix grams are joined. Within the documents that share a gram each is first paired with the one
   that shares most of its prefix, so a group of near copies costs as many pairs as it has members, not
   their square. Pairs that survive the filters are verified once on the whole sets, and links become
   components.
4. Where documents that share a gram still lie in different components, pairs across components that
   the third step has not tried are tried as well; within a gram only neighbouring ranges of set sizes
   meet. Nothing is capped: a link that is left out lies within a component that is known.

The filters: sizes must be close enough (length); what the prefixes share, or can share with anyone, plus
what lies behind the one that ends first, bounds the overlap (positional); and so does what the two sets
have in each of ``PARTS`` hash parts (suffix).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import connected, pick, read, small
from cohortflow.llm.quality import blocks
from cohortflow.session import stage

#: Cells of the document frequency sketch. Rarity orders the grams; any order gives the same links.
CELLS = 1 << 18
PARTS = 64
#: Pairs of whole sets that Python holds at a time.
PAIRS_A_BATCH = 500
_WORDS = 300_000
_MIX = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


class Shingler:
    """64-bit hashes of the word n-grams of texts; A to Z are lower-cased, ASCII white space separates."""

    def __init__(self, words: int):
        self.words = words
        self.number: dict[bytes, int] = {}
        self.hashes = np.zeros(1024, np.uint64)
        # Powers of an odd constant, so that any n-gram length has its weights.
        self.weights = [np.uint64(pow(_MIX[i % len(_MIX)], 1 + i // len(_MIX), 1 << 64) | 1) for i in range(words)]

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        try:
            return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        except KeyError:
            if len(self.number) > _WORDS:
                self.number.clear()
            for word in words:
                if word not in self.number:
                    at = self.number[word] = len(self.number)
                    if at >= len(self.hashes):
                        self.hashes = np.resize(self.hashes, 2 * len(self.hashes))
                    self.hashes[at] = xxhash.xxh3_64_intdigest(word)
            return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def set_of(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; a text with fewer words is one gram, one without words has none."""
        words = (text or "").encode("utf-8", "replace").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        numbers = self._numbers(words)
        w = self.hashes[numbers]
        k = min(self.words, len(w))
        h = np.full(len(w) - k + 1, k, np.uint64)
        for i in range(k):
            h += w[i : len(w) - k + 1 + i] * self.weights[i]
        h ^= h >> np.uint64(31)
        h *= np.uint64(_MIX[1])
        h ^= h >> np.uint64(29)
        return np.unique(h)


def _digest(grams: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None


def _schema(*columns: str) -> str:
    return ", ".join(columns)


def profile(docs: DataFrame, words: int) -> DataFrame:
    """A written table: ``doc_id, key, n, digest`` per document, and rows ``cell, df`` of the sketch."""
    narrow = pick(docs, "doc_id", "text").withColumn("key", F.xxhash64("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "key", "n", "digest", "cell", "df"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, cells = Shingler(words), np.zeros(CELLS, np.int64)
        id_type = None
        for batch in batches:
            id_type = batch.column("doc_id").type
            for block in blocks(batch, "text"):
                sets = [shingler.set_of(t) for t in block.column("text").to_pylist()]
                cells += np.bincount(np.concatenate(sets).astype(np.int64) & (CELLS - 1), minlength=CELLS)
                m = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id"),
                        block.column("key"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s) for s in sets], pa.binary()),
                        pa.nulls(m, pa.int32()),
                        pa.nulls(m, pa.int64()),
                    ],
                    names=names,
                )
        at = np.flatnonzero(cells)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(at), id_type), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int64()),
                 pa.nulls(len(at), pa.binary()), pa.array(at, pa.int32()), pa.array(cells[at])],
                names=names,
            )

    columns = _schema(f"doc_id {kind}", "key long", "n long", "digest binary", "cell int", "df long")
    return stage(narrow.mapInArrow(run, columns), "jaccard-profile")


def rarity(profiled: DataFrame) -> np.ndarray:
    """Level per cell, higher for more frequent: eight levels for each doubling of the count."""
    counts = np.ones(CELLS)
    summed = profiled.where("cell IS NOT NULL").groupBy("cell").agg(F.sum("df").alias("df")).toPandas()
    counts[summed["cell"]] = summed["df"]
    return np.minimum(8 * np.log2(counts), 255).astype(np.uint64)


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1


def overlap_needed(n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Least number of shared grams with which two sets of these sizes are linked."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def nodes(docs: DataFrame, profiled: DataFrame, words: int, percent: int) -> DataFrame:
    """A written table with one row per different set: ``node, digest, doc_id, n, prefix, parts``.

    ``doc_id`` is one of its documents; ``prefix`` holds the rarest grams in order; ``parts`` the set's
    size in each hash part.
    """
    levels = rarity(profiled)
    narrow = pick(docs, "doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for block in blocks(batch, "text"):
                rows, digests, sizes, prefixes, parts = [], [], [], [], []
                for row, text in enumerate(block.column("text").to_pylist()):
                    grams = shingler.set_of(text)
                    if not len(grams):
                        continue
                    # Cell level in the top 8 bits, hash below: signed, so shifted into the positive half.
                    key = (levels[(grams & np.uint64(CELLS - 1)).astype(np.int64)] << np.uint64(55)) | (grams >> np.uint64(9))
                    p = prefix_length(len(grams), percent)
                    first = np.partition(key, p - 1)[:p] if p < len(key) else key
                    rows.append(row)
                    digests.append(_digest(grams))
                    sizes.append(len(grams))
                    prefixes.append(np.sort(first).astype(np.int64))
                    parts.append(np.bincount((grams >> np.uint64(58)).astype(np.int64), minlength=PARTS).astype("<i4").tobytes())
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in prefixes])]).astype(np.int32)
                flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array(digests, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                        pa.array(parts, pa.binary()),
                    ],
                    names=["doc_id", "digest", "n", "prefix", "parts"],
                )

    columns = _schema(f"doc_id {kind}", "digest binary", "n long", "prefix array<long>", "parts binary")
    made = narrow.mapInArrow(run, columns).dropDuplicates(["digest"])
    return stage(made.withColumn("node", F.monotonically_increasing_id()), "jaccard-nodes")


def _joined(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """``pairs (a, b)`` with the columns of both nodes, as ``a_x`` and ``b_x``."""
    for end in ("a", "b"):
        side = table.select(F.col("node").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in columns])
        pairs = pairs.join(side, end)
    return pairs


def plausible(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The ``pairs (a, b)`` that no filter rules out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {name: batch.column(name) for name in batch.schema.names}
            n_a, n_b = col["a_n"].to_numpy(), col["b_n"].to_numpy()
            need = overlap_needed(n_a, n_b, percent)
            parts = [np.frombuffer(b"".join(col[f"{e}_parts"].to_pylist()), "<i4").reshape(-1, PARTS) for e in "ab"]
            keep = np.minimum(*parts).sum(axis=1) >= need
            flat = [col[f"{e}_prefix"].flatten().to_numpy() for e in "ab"]
            ends = [col[f"{e}_prefix"].value_lengths().to_numpy().cumsum() for e in "ab"]
            for i in np.flatnonzero(keep):
                x, y = (f[e[i - 1] if i else 0 : e[i]] for f, e in zip(flat, ends, strict=True))
                shared = np.searchsorted(y, x, side="right") - np.searchsorted(y, x, side="left")
                behind = n_a[i] - len(x) if x[-1] <= y[-1] else n_b[i] - len(y)
                keep[i] = shared.sum() + behind >= need[i]
            yield pa.RecordBatch.from_arrays(
                [col["a"].filter(pa.array(keep)), col["b"].filter(pa.array(keep))], names=["a", "b"]
            )

    return _joined(pairs, found, "n", "prefix", "parts").mapInArrow(run, "a long, b long")


def whole_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``node, grams`` of the ``wanted (node, doc_id, digest)`` sets, from the texts of their documents."""
    inner = pick(docs, "doc_id", "text")
    ids = wanted.select(F.col("doc_id").alias("wanted_id")).distinct()
    rows = inner.join(small(ids, wanted.count()), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for block in blocks(batch, "text"):
                sets = [shingler.set_of(t) for t in block.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["digest", "grams"],
                )

    made = rows.select("text").mapInArrow(run, "digest binary, grams binary")
    return made.join(wanted.select("node", "digest"), "digest").dropDuplicates(["node"]).select("node", "grams")


def verified(pairs: DataFrame, docs: DataFrame, found: DataFrame, words: int, percent: int) -> DataFrame:
    """The ``pairs (a, b)`` that are links, each checked once on the whole sets."""
    tried = stage(plausible(pairs, found, percent), "jaccard-tried")
    ends = tried.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stage(found.join(ends, "node").select("node", "doc_id", "digest"), "jaccard-wanted")
    sets = stage(whole_sets(docs, wanted, words), "jaccard-sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a_grams"), batch.column("b_grams"), strict=True):  # views, no copies
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"]
            )

    # Rows hold two whole sets each: smaller batches than usual, and only for this job.
    conf, rows_a_batch = found.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = conf.get(rows_a_batch, "10000")
    conf.set(rows_a_batch, str(PAIRS_A_BATCH))
    try:
        return stage(_joined(tried, sets, "grams").mapInArrow(run, "a long, b long"), "jaccard-links")
    finally:
        conf.set(rows_a_batch, usual)


def _may_link(x: str, y: str, percent: int) -> str:
    """SQL test of two postings of one gram, by sizes, places and what their prefixes can share at most.

    The sizes say how many grams a linked pair shares (``need``), and so how long the prefixes of this
    pair are: a linked pair has a common gram within both. Of the set whose whole prefix ends first, every
    prefix gram that the other set holds is in the other's prefix too. So the overlap is at most the
    prefix grams that it shares with anyone (``sh``), plus what lies behind its prefix.
    """
    need = f"({percent} * ({x}.n + {y}.n) + {99 + percent}) div {100 + percent}"
    bound = f"CASE WHEN {x}.w <= {y}.w THEN {x}.sh + {x}.n - {x}.p ELSE {y}.sh + {y}.n - {y}.p END"
    tests = [
        f"100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n)",
        f"{x}.i <= {x}.n - {need} AND {y}.i <= {y}.n - {need}",
        f"{bound} >= {need}",
    ]
    return " AND ".join(tests)


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def components(docs: DataFrame, found: DataFrame, words: int, percent: int) -> DataFrame:
    """``node, component`` of every node that has a link."""
    postings = found.select("node", F.posexplode("prefix").alias("i", "gram"))
    held = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    shared = stage(postings.join(stage(held, "jaccard-held"), "gram"), "jaccard-shared")
    points = shared.groupBy("node").agg(F.count(F.lit(1)).alias("sh"))
    points = points.join(found.select("node", "n", "prefix"), "node").select(
        "node", F.struct("n", "sh", F.size("prefix").alias("p"), F.element_at("prefix", -1).alias("w")).alias("x")
    )
    shared = shared.join(stage(points, "jaccard-points"), "node").withColumn("x", F.col("x").withField("i", F.col("i")))
    shared = stage(shared.drop("i"), "jaccard-postings")
    # The lead of a gram shares most of its prefix: in a group of near copies, what they are copies of.
    first = F.max(F.struct("x.sh", (-F.col("node")).alias("order"), "x")).alias("lead")
    leads = stage(shared.groupBy("gram").agg(first).select("gram", (-F.col("lead.order")).alias("a"), F.col("lead.x").alias("y")), "jaccard-leads")
    stars = shared.join(leads, "gram").where("node <> a").where(_may_link("x", "y", percent))
    stars = stage(_ordered(stars, "a", "node").distinct(), "jaccard-stars")
    links = verified(stars, docs, found, words, percent)
    known = stage(connected(links, "jaccard-rounds"), "jaccard-known")
    # Grams whose documents are not all in one component yet; of two documents the star was all.
    open_ = shared.where("held > 2").join(known, "node", "left").withColumn("c", F.coalesce("component", "node"))
    open_ = stage(open_.select("gram", "node", "x", "c"), "jaccard-open")
    mixed = open_.groupBy("gram").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
    main = leads.join(mixed, "gram").join(known.withColumnRenamed("node", "a"), "a", "left")
    main = main.select("gram", "a", F.coalesce("component", "a").alias("main"))
    open_ = stage(open_.join(main, "gram"), "jaccard-mixed").where("node <> a")
    # Documents outside the lead's component meet all others of the gram; those inside need not meet.
    # Linked sets lie in the same range of sizes or in neighbouring ones.
    size_range = F.floor(F.log(F.col("x.n").cast("double")) / math.log(1.0001 * 100 / percent)).cast("int")
    open_ = open_.withColumn("r", size_range)
    strays = open_.where("c <> main").withColumn("r", F.explode(F.sequence(F.col("r") - 1, F.col("r") + 1)))
    strays = strays.select("gram", "r", F.col("node").alias("node_x"), "x", F.col("c").alias("c_x"))
    others = open_.select("gram", "r", F.col("node").alias("node_y"), F.col("x").alias("y"), F.col("c").alias("c_y"), "main")
    across = strays.join(others, ["gram", "r"]).where("c_x <> c_y AND (c_y = main OR node_x < node_y)")
    across = _ordered(across.where(_may_link("x", "y", percent)), "node_x", "node_y").distinct()
    across = across.join(stars, ["a", "b"], "left_anti")  # tried already, and no links across components
    more = verified(across, docs, found, words, percent)
    if more.isEmpty():
        return known
    trees = known.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected(trees.unionByName(more), "jaccard-rounds")


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, key, n_shingles, component_id`` per row of ``docs``; ``key`` is a hash of the text.

    Two documents are linked if their sets of word n-grams share ``percent`` of their union; the
    component id is the smallest doc_id reachable by links. Null, empty and blank texts have an empty
    set and stand alone. Equal sets (copies, repeated rows) are always together. Null ids are no
    candidates for the smallest. Empty tables give an empty result.
    """
    profiled = profile(docs, words)
    found = nodes(docs, profiled, words, percent)
    known = components(docs, found, words, percent)
    named = found.select("digest", "node").join(known, "node", "left")
    named = stage(named.select("digest", F.coalesce("component", "node").alias("component")), "jaccard-named")
    rows = profiled.where("cell IS NULL").select("doc_id", "key", F.col("n").alias("n_shingles"), "digest")
    copies = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("low"))
    lowest = stage(copies, "jaccard-copies").join(named, "digest")
    by_component = stage(lowest.groupBy("component").agg(F.min("low").alias("low")), "jaccard-lowest")
    resolved = stage(named.join(by_component, "component").select("digest", "low"), "jaccard-resolved")
    alone = rows.where("digest IS NULL").select("doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id"))
    grouped = rows.where("digest IS NOT NULL").join(resolved, "digest")
    return grouped.select("doc_id", "key", "n_shingles", F.col("low").alias("component_id")).unionByName(alone)


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which no similar one has a smaller id.

    Rows whose id is null stand for themselves and stay; so do all rows that carry a group's smallest id.
    """
    lost = near_groups(docs, words, percent).where("doc_id <> component_id")
    lost = lost.select(F.col("doc_id").alias("lost_id"), F.col("key").alias("lost_key")).distinct()
    lost = stage(lost, "jaccard-lost")
    inner = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*inner)
    doc_id, text = (F.col(inner[docs.columns.index(c)]) for c in ("doc_id", "text"))
    same = (doc_id == F.col("lost_id")) & (F.xxhash64(text) == F.col("lost_key"))
    return rows.join(small(lost, lost.count()), same, "left_anti").toDF(*docs.columns)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under links of nine tenths of three-word shingles."""
    return near_groups(read(spark, sf_dir, "documents"), words=3, percent=90).drop("key")


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM w),
x AS (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM s),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM x a JOIN x b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i WHERE 100 * c >= 90 * (na + nb - c) UNION ALL SELECT b, a FROM i WHERE 100 * c >= 90 * (na + nb - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, len(s.g) AS n_shingles, m.component_id FROM s
JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON s.doc_id = m.a
"""
