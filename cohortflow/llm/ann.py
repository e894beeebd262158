"""Approximate nearest neighbours by inner product: an NN-descent graph, searched greedily.

Equal vectors are one node with its smallest ids, so a vector that a third of all rows share costs no
more than any other. Nodes are dealt into ranges of length, so that one long vector decides nothing for
the others; no range spans more than a factor of four. Within its range every vector gets one more
coordinate that makes all lengths equal, so that the largest inner product is the smallest angle.

Building: a few random-hyperplane tables cut the nodes into small blocks, and exact neighbours within
the blocks give a first graph. Each round then joins every node's neighbours with one another (forward
and reverse ones, at least one of the two new), which makes neighbours of neighbours meet, and keeps
the best. Rounds end when few edges change.

Searching: in each range a query holds a beam of nodes and expands the best unexpanded ones through joins with the
graph and the vectors, until its beam has none left. Final scores are double inner products of the
original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.llm.common import pick, read
from cohortflow.session import stage

NEIGHBOURS, REVERSE = 48, 48
TABLES, BLOCK = 4, 800
ROUNDS, FEW = 6, 0.1  #: rounds at most; fewer new edges than this share end them
BEAM, EXPAND = 64, 16
ENTRIES = 8
SPAN, BINS = 2, 4  #: powers of two that a range of lengths spans at most, and bins per power
ENTRY_BYTES = 64 << 20  #: entry vectors are broadcast up to so many bytes
BUCKET_NODES = 4_000  #: nodes whose neighbourhoods, or whose vectors, one task holds
_SEED = 20240607


@dataclass
class Index:
    """Written tables: ``nodes (node, vec, members)`` and ``edges (node, near, sim, fresh)``."""

    nodes: DataFrame
    edges: DataFrame
    count: int
    places: DataFrame  #: ``node, range``
    ranges: int
    entries: DataFrame  #: ``node, range``: per range the longest nodes and some by hash, or all of a few; queries enter there too


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the rows that take part: an id, and a finite vector that is not zero.

    Where lengths differ, the commonest one counts, the longest of equally common ones.
    """
    rows = pick(rows, "vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: F.coalesce(x != 0, F.lit(False)))
    rows = rows.where(F.coalesce(finite & some, F.lit(False)))
    length = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("embedding") == (length["d"] if length else 0))


def _nodes(rows: DataFrame, keep: int) -> DataFrame:
    """One row per different vector with its ``keep`` smallest ids."""
    rank = F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))
    few = rows.distinct().withColumn("rank", rank).where(F.col("rank") <= keep)
    grouped = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    made = grouped.select(F.monotonically_increasing_id().alias("node"), F.col("embedding").alias("vec"), "members")
    return stage(made, "ann-nodes")


def _matrix(column: pd.Series | pa.Array) -> np.ndarray:
    if isinstance(column, pa.Array):
        flat = column.flatten().to_numpy()
        return flat.reshape(len(column), -1)
    return np.stack(column.to_numpy())


def _power(vec: Column) -> Column:
    """Binary logarithm of a vector's length, also where its square is beyond a double."""
    most = F.array_max(F.transform(vec, F.abs))
    square = F.aggregate(F.transform(vec, lambda x: x / most), F.lit(0.0), lambda a, x: a + x * x)
    return F.log2(most) + F.log2(square) / 2


def _ranges(bins: dict[int, int]) -> list[tuple[int, int, int]]:
    """First bin, last bin and nodes of each range, the longest range first; ``bins`` are counts by length."""
    out: list[tuple[int, int, int]] = []
    for b in sorted(bins, reverse=True):
        if out and b > out[-1][1] - SPAN * BINS:
            out[-1] = (b, out[-1][1], out[-1][2] + bins[b])
        else:
            out.append((b, b, bins[b]))
    return out


def _shorts(nodes: DataFrame) -> tuple[DataFrame, int]:
    """``node, power, range, short, t0..``: vectors of equal length in their range, and the block key in each table.

    The second value is the number of ranges.
    """
    sized = nodes.select("node", "vec", _power(F.col("vec")).alias("power"))
    counted = sized.groupBy(F.floor(F.col("power") * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    ranges = _ranges({r["bin"]: r["n"] for r in counted.collect()})  # a double has some 8,500 bins
    firsts, lasts = np.array([r[0] for r in ranges]), np.array([r[1] for r in ranges])
    bits = np.array([max(0, int(np.ceil(np.log2(r[2] / BLOCK)))) for r in ranges])
    d, most = nodes.agg(F.max(F.size("vec"))).first()[0], int(bits.max())
    planes = np.random.default_rng(_SEED).standard_normal((d, TABLES * most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, power = _matrix(batch.column("vec")), batch.column("power").to_numpy()
            at = np.searchsorted(-firsts, -np.floor(power * BINS))  # the first range that begins at or below
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
            signs = (x @ planes > 0).reshape(len(x), TABLES, most)
            signs &= (np.arange(most) < bits[at][:, None])[:, None, :]
            keys = (signs * (1 << np.arange(most))).sum(axis=2)
            share = np.exp2(np.minimum(0, power - (lasts[at] + 1) / BINS))
            x = np.hstack([x * share[:, None], np.sqrt(1 - share * share)[:, None]]).astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("power"), pa.array(at.astype(np.int32))]
                + [pa.array([v.tobytes() for v in x], pa.binary())]
                + [pa.array(keys[:, t].astype(np.int64)) for t in range(TABLES)],
                names=["node", "power", "range", "short", *[f"t{t}" for t in range(TABLES)]],
            )

    columns = ["node long", "power double", "range int", "short binary", *[f"t{t} long" for t in range(TABLES)]]
    return stage(sized.mapInArrow(run, ", ".join(columns)), "ann-shorts"), len(ranges)


def _entries(shorts: DataFrame) -> DataFrame:
    """``node, range``: per range its longest nodes and some by hash; all nodes where the range has few."""
    kept = []
    for by, most in ((F.desc("power"), ENTRIES), (F.xxhash64("node"), ENTRIES)):
        rank = F.row_number().over(W.partitionBy("range").orderBy(by, "node"))
        kept.append(shorts.select("node", "range", "power").withColumn("rank", rank).where(F.col("rank") <= most))
    few = shorts.groupBy("range").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= BEAM).select("range")
    kept.append(shorts.select("node", "range").join(F.broadcast(few), "range"))  # one row per range at most
    return stage(reduce(DataFrame.unionByName, [k.select("node", "range") for k in kept]).distinct(), "ann-entries")


def _best(node: np.ndarray, near: np.ndarray, sim: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best different ``near`` of each ``node``."""
    order = np.lexsort((near, -sim, node))
    found = pd.DataFrame({"node": node[order], "near": near[order], "sim": sim[order]})
    found = found.drop_duplicates(["node", "near"])
    return found[found.groupby("node").cumcount() < k]


def _first_graph(shorts: DataFrame) -> DataFrame:
    """Exact neighbours within the blocks of all tables; blocks that are too large are cut by a hash."""
    tables = F.array(*[F.struct(F.lit(t).alias("table"), F.col(f"t{t}").alias("block")) for t in range(TABLES)])
    rows = shorts.select("node", "range", "short", F.explode(tables).alias("b")).select("node", "range", "short", "b.*")
    sizes = rows.groupBy("range", "table", "block").agg(F.count(F.lit(1)).alias("held"))
    sizes = stage(sizes.withColumn("cuts", F.ceil(F.col("held") / (2 * BLOCK)).cast("int")), "ann-blocks")
    rows = rows.join(sizes.select("range", "table", "block", "cuts"), ["range", "table", "block"])
    rows = rows.withColumn("cut", F.pmod(F.xxhash64("node", "table"), F.col("cuts")).cast("int"))

    def near(block: pd.DataFrame) -> pd.DataFrame:
        ids = block["node"].to_numpy()
        if len(ids) < 2:
            return pd.DataFrame({"node": ids[:0], "near": ids[:0], "sim": np.zeros(0)})
        x = np.frombuffer(b"".join(block["short"]), "<f4").reshape(len(ids), -1).astype(np.float64)
        s = x @ x.T
        np.fill_diagonal(s, -np.inf)
        k = min(NEIGHBOURS, len(ids) - 1)
        at = np.argpartition(-s, k - 1, axis=1)[:, :k]
        return pd.DataFrame(
            {"node": np.repeat(ids, k), "near": ids[at].ravel(), "sim": np.take_along_axis(s, at, axis=1).ravel()}
        )

    return rows.groupBy("range", "table", "block", "cut").applyInPandas(near, "node long, near long, sim double")


def _keep_best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best neighbours of each node; an edge that was there before is not fresh."""
    merged = edges.groupBy("node", "near").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(W.partitionBy("node").orderBy(F.desc("sim"), "near"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def _round(edges: DataFrame, shorts: DataFrame, buckets: int) -> DataFrame:
    """Better neighbours that meet at a node both are linked with.

    Neighbourhoods are joined per bucket of nodes; a vector travels once to each bucket that needs it.
    """
    back = edges.select(F.col("near").alias("node"), F.col("node").alias("near"), "fresh")
    spread = F.row_number().over(W.partitionBy("node").orderBy(F.desc("fresh"), F.xxhash64("node", "near")))
    back = back.withColumn("rank", spread).where(F.col("rank") <= REVERSE).drop("rank")
    around = edges.select("node", "near", "fresh").unionByName(back)
    around = around.withColumn("bucket", F.pmod(F.xxhash64("node"), F.lit(buckets)))
    held = F.when(F.count(F.lit(1)) >= NEIGHBOURS, F.min("sim")).otherwise(-2.0).alias("worst")
    worst = edges.groupBy("node").agg(held)
    points = shorts.select("node", "short").join(worst, "node", "left").select(F.col("node").alias("near"), "short", F.coalesce("worst", F.lit(-2.0)).alias("worst"))
    needed = around.select("bucket", "near").distinct().join(points, "near")
    needed = needed.toDF("near", "place", "short", "worst")

    def meet(part: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        points = points.sort_values("near")
        ids, worst_of = points["near"].to_numpy(), points["worst"].to_numpy()
        x = np.frombuffer(b"".join(points["short"]), "<f4").reshape(len(ids), -1)
        part = part.groupby(["node", "near"], as_index=False)["fresh"].max().sort_values("node", kind="stable")
        node, fresh = part["node"].to_numpy(), part["fresh"].to_numpy(bool)
        at = np.searchsorted(ids, part["near"].to_numpy())
        starts = np.flatnonzero(np.r_[True, np.diff(node) != 0, True])
        best = (ids[:0], ids[:0], np.zeros(0))
        found, size = [best], 0
        for a, b in zip(starts, starts[1:], strict=False):
            new, m = fresh[a:b], at[a:b]
            if not new.any():
                continue
            y = x[m].astype(np.float64)
            s = y @ y.T
            useful = (new[:, None] | new[None, :]) & (s > worst_of[m][:, None])
            np.fill_diagonal(useful, False)
            i, j = np.nonzero(useful)
            found.append((ids[m[i]], ids[m[j]], s[i, j]))
            size += len(i)
            if size > 2_000_000:  # what has been found so far is cut to the best, so memory stays bounded
                kept = _best(*map(np.concatenate, zip(*found, strict=True)), NEIGHBOURS)
                found, size = [tuple(kept[c].to_numpy() for c in kept)], 0
        return _best(*map(np.concatenate, zip(*found, strict=True)), NEIGHBOURS)

    grouped = around.groupBy("bucket").cogroup(needed.groupBy("place"))
    return grouped.applyInPandas(meet, "node long, near long, sim double")


def build(rows: DataFrame, results: int = 20) -> Index:
    """The index over all usable rows; ``results`` is what a search will return at most."""
    nodes = _nodes(usable(rows), results + 1)
    count = nodes.count()
    none = rows.sparkSession.createDataFrame([], "node long, near long, sim double, fresh boolean")
    if not count:
        places = rows.sparkSession.createDataFrame([], "node long, range int")
        return Index(nodes, none, 0, places, 1, places)
    shorts, ranges = _shorts(nodes)
    places, entries = shorts.select("node", "range"), _entries(shorts)
    if count < 2:
        return Index(nodes, none, count, places, ranges, entries)
    edges = _keep_best(_first_graph(shorts).withColumn("fresh", F.lit(True)), NEIGHBOURS)
    edges = stage(edges, "ann-edges")
    buckets = max(8, count // BUCKET_NODES)
    for _ in range(ROUNDS):
        found = _round(edges, shorts, buckets).withColumn("fresh", F.lit(True))
        old = edges.withColumn("fresh", F.lit(False))
        edges = stage(_keep_best(old.unionByName(found), NEIGHBOURS), "ann-edges")
        if edges.where("fresh").count() < FEW * count * NEIGHBOURS:
            break
    return Index(nodes, edges, count, places, ranges, entries)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row; what is beyond a double is infinite with its sign, never NaN."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.einsum("ij,ij->i", a, b)
        far = np.flatnonzero(~np.isfinite(out))
        a, b = a[far], b[far]
        p, q = np.abs(a).max(axis=1, initial=0), np.abs(b).max(axis=1, initial=0)
        out[far] = np.einsum("ij,ij->i", a / p[:, None], b / q[:, None]) * np.maximum(p, q) * np.minimum(p, q)
    return out


def _scored(pairs: DataFrame, index: Index, queries: DataFrame) -> DataFrame:
    """``query, node, sim`` of those ``pairs (query, node)`` that beat the query's ``worst``.

    Pairs meet the vectors in parts of the nodes; a target travels once to each part that it needs.
    """
    parts = F.pmod(F.xxhash64("node"), F.lit(max(1, index.count // BUCKET_NODES)))
    pairs = pairs.withColumn("part", parts)
    targets = pairs.select("part", "query").distinct().join(queries, "query")
    none = F.lit(None).cast("array<double>")
    rows = pairs.select("part", "query", "node", none.alias("target"), F.lit(None).cast("double").alias("worst"))
    rows = rows.unionByName(targets.select("part", "query", F.lit(None).cast("long").alias("node"), "target", "worst"))
    vectors = index.nodes.select("node", "vec").withColumn("part", parts)

    def dot(rows: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        asked = rows[rows["node"].notna()]
        if not len(asked):
            return pd.DataFrame({"query": [], "node": [], "sim": []})
        targets, vectors = rows[rows["node"].isna()].sort_values("query"), vectors.sort_values("node")
        query, node = asked["query"].to_numpy(np.int64), asked["node"].to_numpy(np.int64)
        t, v = _matrix(targets["target"]), _matrix(vectors["vec"])
        i = np.searchsorted(targets["query"].to_numpy(np.int64), query)
        j = np.searchsorted(vectors["node"].to_numpy(np.int64), node)
        sim = np.empty(len(query))
        for a in range(0, len(query), 20_000):
            piece = slice(a, a + 20_000)
            sim[piece] = _products(t[i[piece]], v[j[piece]])
        worst = targets["worst"].to_numpy()[i]
        good = (sim > worst) | (worst == -np.inf)
        return pd.DataFrame({"query": query[good], "node": node[good], "sim": sim[good]})

    grouped = rows.groupBy("part").cogroup(vectors.groupBy("part"))
    return grouped.applyInPandas(dot, "query long, node long, sim double")


def _entered(index: Index, queries: DataFrame) -> DataFrame:
    """``query, node, sim`` of every query and the entry nodes of its range, scored where the query lies.

    The entry vectors are at most BEAM a range. Beyond ENTRY_BYTES the join is left to Spark; its rows
    are streamed too, so no task holds the queries of a range.
    """
    entries = stage(index.entries.join(index.nodes.select("node", "vec"), "node"), "ann-entry-vectors")
    held = entries.agg(F.sum(8 * F.size("vec"))).first()[0] or 0
    met = queries.select("query", "target", "range").join(F.broadcast(entries) if held <= ENTRY_BYTES else entries, "range")

    def dot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sim = _products(_matrix(batch.column("target")), _matrix(batch.column("vec")))
                yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("node"), pa.array(sim)], names=["query", "node", "sim"])

    return met.select("query", "node", "target", "vec").mapInArrow(dot, "query long, node long, sim double")


def search(index: Index, queries: DataFrame, beam: int = BEAM, expand: int = EXPAND) -> DataFrame:
    """``query, node, sim``: the ``beam`` best nodes found for ``queries (query, target, range, entry)``.

    A query stays in its range of the index. ``entry`` is a node of it (or null) at which the query enters the graph, beside the
    range's own few. Every query runs until all nodes of its beam are expanded; the beams of all queries move on together.
    """
    by_sim = W.partitionBy("query").orderBy(F.desc("sim"), "node")
    queries = stage(queries, "ann-queries")
    graph = index.edges.select("node", "near")
    low = F.lit(float("-inf"))
    own = queries.where("entry IS NOT NULL").select("query", F.col("entry").alias("node"))
    own = _scored(own, index, queries.select("query", "target", low.alias("worst")))
    state = _entered(index, queries).unionByName(own).dropDuplicates(["query", "node"])
    state = stage(state.withColumn("done", F.lit(False)), "ann-beam")
    while True:
        front = state.where("NOT done").withColumn("rank", F.row_number().over(by_sim)).where(F.col("rank") <= expand)
        front = stage(front.select("query", "node"), "ann-front")
        if front.isEmpty():
            return state.select("query", "node", "sim")
        reached = front.join(graph, "node").select("query", F.col("near").alias("node")).distinct()
        reached = reached.join(state.select("query", "node"), ["query", "node"], "left_anti")
        worst = state.groupBy("query").agg(F.when(F.count(F.lit(1)) >= beam, F.min("sim")).otherwise(low).alias("worst"))
        met = _scored(reached, index, queries.join(worst, "query").select("query", "target", "worst"))
        marked = state.join(front.withColumn("now", F.lit(True)), ["query", "node"], "left")
        marked = marked.select("query", "node", "sim", (F.col("done") | F.coalesce("now", F.lit(False))).alias("done"))
        both = marked.unionByName(met.withColumn("done", F.lit(False)))
        both = both.withColumn("rank", F.row_number().over(by_sim)).where(F.col("rank") <= beam)
        state = stage(both.drop("rank"), "ann-beam")


def nearest(index: Index, rows: DataFrame, results: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the usable ``rows``, which are themselves rows of the index.

    A query enters the graph at its own node. Its own id is no result; ties go to the smaller id. Rows
    that repeat an id and a vector count once. Fewer candidates than ``results`` give fewer rows.
    """
    rows = usable(rows).distinct()
    asked = rows.join(index.nodes.select("node", "vec"), F.col("embedding") == F.col("vec"))
    asked = stage(asked.select(F.col("vec_id").alias("query_id"), "node"), "ann-asked")
    queries = asked.select("node").distinct().join(index.nodes, "node").join(index.places.withColumnRenamed("range", "own"), "node")
    queries = queries.withColumn("range", F.explode(F.sequence(F.lit(0), F.lit(index.ranges - 1))))
    entry = F.when(F.col("own") == F.col("range"), F.col("node"))
    query = F.col("node") * index.ranges + F.col("range")  # one search per range
    queries = queries.select(query.alias("query"), F.col("vec").alias("target"), "range", entry.alias("entry"))
    found = search(index, queries).withColumn("query", F.expr(f"query DIV {index.ranges}")).join(index.nodes.select("node", "members"), "node")
    held = found.select("query", "sim", F.explode("members").alias("vec_id"))
    best = W.partitionBy("query").orderBy(F.desc("sim"), "vec_id")
    held = held.withColumn("place", F.row_number().over(best)).where(F.col("place") <= results + 1)
    held = stage(held, "ann-held")
    pairs = asked.join(held, asked["node"] == held["query"]).where("query_id <> vec_id")
    # Of results + 1 places one may be the query itself; places keep their order without it.
    own = asked.join(held, (asked["node"] == held["query"]) & (asked["query_id"] == held["vec_id"]))
    own = own.select(F.col("query_id").alias("own_id"), F.col("place").alias("own_place"))
    ranked = pairs.join(own, pairs["query_id"] == own["own_id"], "left")
    rank = F.col("place") - F.coalesce((F.col("own_place") < F.col("place")).cast("int"), F.lit(0))
    ranked = ranked.select("query_id", rank.cast("int").alias("rank"), "vec_id", F.col("sim").alias("score"))
    return ranked.where(F.col("rank") <= results)


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every embedding whose id is divisible by 20."""
    rows = read(spark, sf_dir, "embeddings")
    return nearest(build(rows, 20), pick(rows, "vec_id", "embedding").where("vec_id % 20 = 0"), 20)
