"""Exact deduplication with a heavy-hitter split.

A frequent-items sketch of the Misra-Gries family (``approx_top_k``, merged over all partitions) names
the digests that may be frequent. Their groups are then counted exactly; the winners, at most
``HEAVY`` rows, are broadcast, and the rows of these groups are settled where they lie. Only the
remaining digests are shuffled, and none of them can hold more than about ``rows / TRACKED`` rows.

The text is read once, for a narrow table of digests that is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.llm.common import pick, read, small
from cohortflow.session import stage

#: Digests that the sketch reports and whose winners are broadcast, at most.
HEAVY = 1_000
#: Counters of the sketch. A digest of more than about 3.5 / TRACKED of all rows is never missed.
TRACKED = 16_384


def digests(docs: DataFrame) -> DataFrame:
    """A written table ``row, doc_id, digest``: one row per document, null texts as empty ones."""
    narrow = pick(docs, "doc_id", "text")
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    return stage(
        narrow.select(F.monotonically_increasing_id().alias("row"), "doc_id", digest.alias("digest")), "dedup-digests"
    )


def settle(rows: DataFrame) -> DataFrame:
    """``row, doc_id, digest, winner, group_size`` for a written table ``row, doc_id, digest``.

    ``winner`` is the struct ``(doc_id, row)`` of the row that stays: the largest id, and of rows that
    repeat an id and a text the last one read. Null ids are the smallest. An empty table gives none.
    """
    sketch = F.expr(f"approx_top_k(hex(digest), {HEAVY}, {TRACKED})")
    named = rows.agg(sketch.alias("found")).select(F.explode("found").alias("f")).where("f.count > 1")
    named = named.select(F.unhex("f.item").alias("heavy"))
    last = F.max(F.struct("doc_id", "row")).alias("winner")
    size = F.count(F.lit(1)).alias("group_size")
    # Verified: the sketch only proposes; sizes and winners are counted over all rows.
    named = stage(named, "dedup-named")
    verified = rows.join(F.broadcast(named), F.col("digest") == F.col("heavy")).groupBy("heavy").agg(last, size)
    verified = stage(verified, "dedup-winners")
    marked = rows.join(F.broadcast(verified), F.col("digest") == F.col("heavy"), "left")
    done = marked.where("heavy IS NOT NULL").select("row", "doc_id", "digest", "winner", "group_size")
    group = W.partitionBy("digest")
    rest = marked.where("heavy IS NULL").select("row", "doc_id", "digest")
    rest = rest.withColumn("winner", F.max(F.struct("doc_id", "row")).over(group))
    return done.unionByName(rest.withColumn("group_size", F.count(F.lit(1)).over(group)))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one row for each different text.

    Null texts count as empty ones. Of rows that agree in id and text, any one stays. Up to a counted
    bound the rows that go are broadcast, and no text is shuffled; beyond it, texts are shuffled once.
    """
    settled = settle(digests(docs))
    lost = settled.where("NOT doc_id <=> winner.doc_id").select("doc_id", "digest").distinct()
    twice = settled.where("doc_id <=> winner.doc_id AND row <> winner.row").select("doc_id", "digest").distinct()
    fate = stage(lost.withColumn("tied", F.lit(False)).unionByName(twice.withColumn("tied", F.lit(True))), "dedup-fate")
    fate = fate.select(F.col("doc_id").alias("fate_id"), F.col("digest").alias("fate_digest"), "tied")
    inner = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*inner)
    at = {name: F.col(inner[docs.columns.index(name)]) for name in ("doc_id", "text")}
    same = at["doc_id"].eqNullSafe(F.col("fate_id")) & (
        F.unhex(F.sha2(F.coalesce(at["text"], F.lit("")), 256)) == F.col("fate_digest")
    )
    counts = {r["tied"]: r["count"] for r in fate.groupBy("tied").count().collect()}
    kept = rows.join(small(fate.where("NOT tied"), counts.get(False, 0)), same, "left_anti")
    if not counts.get(True):
        return kept.toDF(*docs.columns)
    # Repeated rows are few, or at least far fewer than the documents: only they are grouped.
    tied = kept.join(fate.where("tied"), same, "left_semi").dropDuplicates(
        [inner[docs.columns.index(name)] for name in ("doc_id", "text")]
    )
    return kept.join(fate.where("tied"), same, "left_anti").unionByName(tied).toDF(*docs.columns)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text."""
    return settle(digests(read(spark, sf_dir, "documents"))).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


OP5_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
