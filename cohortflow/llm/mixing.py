"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key ``-ln(u) / quality`` (``u`` uniform, from a hash of its id).
Within its source the documents are ordered by key and their sizes summed up to the source's token
budget: the part of its target that is left once whole epochs are taken. Documents up to the budget are
taken once more. What the first document that does not fit leaves over is filled, in key order, by all later
ones that still fit; a source then misses its target by less than the shortest document not taken.

The text is read once for a narrow table, which is written to the shared folder. A source is never
sorted as a whole: sums per ``(source, key cell)`` are enough to find the one cell in which the budget
ends, and only that cell is ordered. What it leaves over is less than one document holds, so of the
rows behind it few can be taken: of each size the first ones by key, as many as fit. These candidates
meet per source, and one aggregate over them in key order says which are taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.llm.common import pick, read, small, uniform, word_count
from cohortflow.session import stage

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Rows of the largest source that share a key cell: a 256th of them, within these bounds.
CELL_ROWS = (64, 20_000)
#: Passes over the edge cell; what they leave over goes through the cells behind it.
ROUNDS = 3


def quality(text: Column) -> Column:
    """Quality weight of a text in [0.25, 1.25]: a quarter plus the share of letters; 0.25 for no text."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.lit(0.25) + F.coalesce(letters / F.nullif(F.length(text), F.lit(0)), F.lit(0.0))


def keyed(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """``doc_id, source, size, key`` per row."""
    narrow = pick(docs, "doc_id", "source", "text")
    return narrow.select("doc_id", "source", word_count(F.col("text")).alias("size"), _key(seed).alias("key"))


def _key(seed: str) -> Column:
    return -F.log(uniform(F.col("doc_id"), seed=seed)) / quality(F.col("text"))


def targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``; one row per source.

    The sources in code point order (null last) carry the weights in turn. Sharing the excess of the
    capped sources by weight until none is above its cap ends where the caps are filled in order of
    cap / weight, which windows over the sources express. The windows see one row per source.
    """
    everything = W.partitionBy()
    cap = F.col("source_size") * max_epochs
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weighted = totals.withColumn("weight", F.element_at(F.array([F.lit(w) for w in weights]), place % len(weights) + 1))
    order = W.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum(cap).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - before) / left
    capped = weighted.withColumn("capped", level * F.col("weight") >= cap)
    spare = F.sum("source_size").over(everything) - F.sum(F.when(F.col("capped"), cap).otherwise(0)).over(everything)
    share = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), cap.cast("double")).otherwise(
        (spare * F.col("weight")).cast("double") / F.nullif(share, F.lit(0))
    )
    return capped.select("source", "source_size", target.alias("target"))


def plan(
    rows: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> tuple[DataFrame, int, DataFrame, int]:
    """One row per source with its target, whole epochs, and the last key that is taken once more.

    ``rows`` is a written table ``doc_id, source, size, key``. The second value is the row count. The
    third and fourth are the rows behind the last key that are taken too, and their count.
    """
    found = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    found = stage(found, "mix-sources")
    sources, most = found.agg(F.count(F.lit(1)), F.max("n")).first()
    cells = max(1, (most or 0) // min(max((most or 0) // 256, CELL_ROWS[0]), CELL_ROWS[1]))
    cell = _cell(F.lit(cells))
    budgets = targets(found.select("source", "source_size"), weights, max_epochs)
    epochs = F.floor(F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))).cast("long")
    budgets = budgets.withColumn("epochs", epochs)
    # Sizes are whole numbers, so what a budget has left is one too.
    budget = F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    budgets = stage(budgets.withColumn("budget", budget), "mix-budgets")
    least = F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least")
    summed = stage(rows.groupBy("source", cell.alias("cell")).agg(F.sum("size").alias("held"), least), "mix-cells")
    ahead = F.sum("held").over(W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, 0))
    edge = (
        summed.withColumn("upto", ahead)
        .join(small(budgets.withColumnRenamed("source", "s"), sources), F.col("source").eqNullSafe(F.col("s")))
        .where("budget > 0 AND upto - held <= budget AND upto > budget")
        .select(F.col("s"), F.col("cell").alias("edge"), (F.col("upto") - F.col("held")).alias("start"), "budget")
    )
    edge = stage(edge, "mix-edges")
    inside = rows.withColumn("cell", cell).join(
        small(edge, sources), F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("edge"))
    )
    order = W.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    left = inside.withColumn("left", F.col("budget") - F.col("start")).withColumn("free", F.lit(True))
    for r in range(ROUNDS):
        fits = F.col("free") & (F.col("size") <= F.col("left"))
        upto = F.sum(F.when(F.col("fits"), F.col("size")).otherwise(0)).over(order)
        left = left.withColumn("fits", fits).withColumn("take", F.col("fits") & (upto <= F.col("left")))
        left = left.withColumn(f"limit{r}", F.col("left")).withColumn(
            f"cut{r}", F.when(F.col("take"), F.struct("key", "doc_id"))
        )
        spent = F.sum(F.when(F.col("take"), F.col("size")).otherwise(0)).over(W.partitionBy("source"))
        left = left.withColumn("left", F.col("left") - spent).withColumn("free", F.col("free") & ~F.col("take"))
    cuts = [F.struct(F.max(f"limit{r}").alias("limit"), F.max(f"cut{r}").alias("cut")) for r in range(ROUNDS)]
    cut = left.groupBy("source").agg(F.array(*cuts).alias("cuts")).withColumnRenamed("source", "c")
    full = (
        budgets.join(edge.select("s", "edge", "start"), F.col("source").eqNullSafe(F.col("s")), "left")
        .join(cut, F.col("source").eqNullSafe(F.col("c")), "left")
        .withColumn("left", F.col("budget") - F.col("start"))
        .select("source", "source_size", "target", "epochs", "edge", "left", "cuts", F.lit(cells).alias("cells"))
    )
    full = stage(full, "mix-plan")
    picks = stage(_picks(rows, summed, full, sources), "mix-picks")
    return full, sources, picks, picks.count()


def _picks(rows: DataFrame, summed: DataFrame, full: DataFrame, sources: int) -> DataFrame:
    """``source, id, size, key`` of rows that follow the passes over the edge cell and still fit, in key order.

    What no longer fits never fits again, so the rows of one size that are taken are the first by key,
    as many at most as the size fits into what is left. Rows without words bring nothing nearer.
    """
    each = small(full.select(F.struct("*").alias("p")), sources)
    inside = rows.join(each, F.col("source").eqNullSafe(F.col("p.source")) & (_cell(F.col("p.cells")) == F.col("p.edge")))
    spent = F.sum(F.when(_within("p"), F.col("size")).otherwise(0))
    own = F.min(F.when(~_within("p") & (F.col("size") > 0), F.col("size")))
    inside = inside.groupBy("source").agg((F.max("p.left") - spent).alias("left"), own.alias("own"))
    behind = summed.join(each, F.col("source").eqNullSafe(F.col("p.source")) & (F.col("cell") > F.col("p.edge")))
    behind = behind.groupBy("source").agg(F.min("least").alias("least")).withColumnRenamed("source", "b")
    short = inside.join(behind, F.col("source").eqNullSafe(F.col("b")), "left").where(F.least("own", "least") <= F.col("left"))
    short = short.select(F.col("source").alias("s"), F.col("left").alias("rest"))
    short = stage(short.join(each, F.col("s").eqNullSafe(F.col("p.source"))), "mix-short")
    free = rows.join(small(short, sources), F.col("source").eqNullSafe(F.col("s"))).withColumn("cell", _cell(F.col("p.cells")))
    later = (F.col("cell") > F.col("p.edge")) | ((F.col("cell") == F.col("p.edge")) & ~_within("p"))
    free = free.where((F.col("size") > 0) & (F.col("size") <= F.col("rest")) & later)
    # Rows that repeat an id and a size are taken together.
    free = free.groupBy("source", "cell", "key", F.col("doc_id").cast("string").alias("id"), "size").agg(
        F.sum("size").alias("held"), F.max("rest").alias("rest")
    )
    free = stage(free.where("held <= rest").withColumn("most", F.floor(F.col("rest") / F.col("held"))), "mix-free")
    counted = free.groupBy("source", "cell", "held").agg(F.count(F.lit(1)).alias("n"), F.max("most").alias("most"))
    before = F.sum("n").over(W.partitionBy("source", "held").orderBy("cell").rowsBetween(W.unboundedPreceding, -1))
    counted = counted.withColumn("before", F.coalesce(before, F.lit(0))).where("before < most")
    counted = counted.select(F.col("source").alias("s"), F.col("cell").alias("c"), F.col("held").alias("h"), "before")
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")) & (F.col("held") == F.col("h"))
    place = F.row_number().over(W.partitionBy("source", "cell", "held").orderBy("key", "id"))
    first = free.join(counted, same).withColumn("place", F.col("before") + place).where("place <= most")

    # Bounded: the shortest document first, ``rest`` holds no more than rest / size of each size, and rest is
    # less than one document of the edge cell.
    order = F.array_sort(F.collect_list(F.struct("key", "id", "size", "held"))).alias("candidates")
    per_source = first.groupBy("source").agg(F.max("rest").alias("rest"), order)
    kind = per_source.schema["candidates"].dataType.simpleString()
    none = F.struct(F.col("rest").alias("left"), F.array().cast(kind).alias("taken"))

    def take(state: Column, row: Column) -> Column:
        after = F.struct((state["left"] - row["held"]).alias("left"), F.array_append(state["taken"], row).alias("taken"))
        return F.when(row["held"] <= state["left"], after).otherwise(state)

    taken = F.aggregate("candidates", none, take, lambda state: state["taken"])
    return per_source.select("source", F.explode(taken).alias("t")).select("source", "t.id", "t.size", "t.key")


def _cell(cells: Column) -> Column:
    """Grows with the key: ``exp(-key)`` is uniform for a weight of 1 and never far from it here."""
    return F.least(cells - 1, F.floor((1 - F.exp(-F.col("key"))) * cells)).cast("int")


def _within(of: str) -> Column:
    """Whether a row of the edge cell is taken by the passes over that cell."""
    within = F.exists(
        f"{of}.cuts", lambda c: (F.col("size") <= c["limit"]) & (F.struct("key", "doc_id") <= c["cut"])
    )
    return F.coalesce(within, F.lit(False))


def _copies(of: str) -> Column:
    """Copies of a row, from its ``size``, ``key``, ``doc_id`` and ``picked`` and the plan's columns under ``of``."""
    cell, edge = _cell(F.col(f"{of}.cells")), F.col(f"{of}.edge")
    # No edge: the target is met by whole epochs.
    more = F.coalesce((cell < edge) | ((cell == edge) & _within(of)), F.lit(False)) | F.col("picked")
    return F.col(f"{of}.epochs") + (more & (F.col("size") > 0)).cast("long")


def _planned(rows: DataFrame, per_source: DataFrame, sources: int, picks: DataFrame, picked: int) -> DataFrame:
    """``rows`` with the plan of their source as ``p``, and whether they are ``picked`` behind the edge cell."""
    per_source = small(per_source.select(F.struct("*").alias("p")), sources)
    joined = rows.join(per_source, F.col("source").eqNullSafe(F.col("p.source")))
    if not picked:
        return joined.withColumn("picked", F.lit(False))
    picks = small(picks.select(F.struct("*").alias("k")), picked)
    same = F.col("doc_id").cast("string").eqNullSafe(F.col("k.id")) & F.col("source").eqNullSafe(F.col("k.source"))
    same = same & (F.col("key") == F.col("k.key")) & (F.col("size") == F.col("k.size"))
    return joined.join(picks, same, "left").withColumn("picked", F.col("k").isNotNull())


def mixed_sizes(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per row: ``doc_id, source, size, source_size, target, copies, taken``.

    Null texts, empty texts and texts of white space have size 0 and take nothing. A null source is a
    source of its own, the last one. Rows that repeat an id share a key, and at the edge of a budget
    they are all taken or all left. Empty tables give an empty result.
    """
    rows = stage(keyed(docs), "mix-rows")
    return _planned(rows, *plan(rows, weights, max_epochs)).select(
        "doc_id",
        "source",
        "size",
        F.col("p.source_size").alias("source_size"),
        F.col("p.target").alias("target"),
        _copies("p").alias("copies"),
        (_copies("p") * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixture itself: the rows of ``docs``, each as often as it is taken, with its own columns.

    Texts without words carry no tokens and cannot bring a source nearer to its target; they are
    taken in whole epochs only.
    """
    planned = plan(stage(keyed(docs), "mix-rows"), weights, max_epochs)
    inner = [f"c{i}" for i in range(len(docs.columns))]
    at = {name: F.col(f"d.{inner[docs.columns.index(name)]}") for name in ("doc_id", "source", "text")}
    rows = docs.toDF(*inner).select(F.struct(*inner).alias("d"))
    rows = rows.select("d", at["doc_id"].alias("doc_id"), at["source"].alias("source"), at["text"].alias("text"))
    rows = rows.select("d", "doc_id", "source", word_count(F.col("text")).alias("size"), _key("mix").alias("key"))
    repeated = _planned(rows, *planned).select("d", F.explode(F.array_repeat(F.lit(0), _copies("p").cast("int"))).alias("copy"))
    return repeated.select("d.*").toDF(*docs.columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 5, 2, 1 of their sources."""
    return mixed_sizes(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "source"
    )


OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    -ln((CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5e0) / 4503599627370496e0)
      / (0.25e0 + coalesce(length(regexp_replace(text, '[^\p{L}]+', '', 'g'))::DOUBLE / nullif(length(text), 0), 0)) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
    sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(3 * source_size) OVER (ORDER BY 3e0 * source_size / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY 3e0 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    * weight >= 3 * source_size AS capped FROM w),
t AS (SELECT source, source_size, CASE WHEN capped THEN 3e0 * source_size ELSE
    ((total - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER ()) * weight)::DOUBLE
    / nullif(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 0)::DOUBLE END AS target FROM l),
e AS (SELECT *, CAST(floor(coalesce(target / nullif(source_size, 0), 0)) AS BIGINT) AS epochs FROM t),
c AS (SELECT d.doc_id, d.size, d.key, d.source, e.source_size, e.target, e.epochs,
    CASE WHEN d.size > 0 THEN row_number() OVER (PARTITION BY d.source, d.size > 0 ORDER BY d.key, d.doc_id, d.size) END AS place
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
g AS (SELECT source, 0::BIGINT AS place, CAST(floor(target - epochs * source_size) AS BIGINT) AS rest, false AS take FROM e
  UNION ALL SELECT c.source, c.place, g.rest - CASE WHEN c.size <= g.rest THEN c.size ELSE 0 END, c.size <= g.rest
  FROM g JOIN c ON c.source IS NOT DISTINCT FROM g.source AND c.place = g.place + 1),
r AS (SELECT c.*, c.epochs + CASE WHEN g.take THEN 1 ELSE 0 END AS copies
  FROM c LEFT JOIN g ON c.source IS NOT DISTINCT FROM g.source AND c.place = g.place)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies, source FROM r
"""
