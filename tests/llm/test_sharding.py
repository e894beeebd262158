import zlib
from collections import Counter

from cohortflow.llm import sharding
from cohortflow.llm.common import read
from pyspark.sql import functions as F


def test_curve_visits_neighbours(spark):
    bits, n = 3, 3
    size = 1 << bits
    cells = spark.range(size**n).select(*[(F.floor(F.col("id") / size**i) % size).cast("int").alias(f"x{i}") for i in range(n)])
    index = sharding.hilbert_index([F.col(f"x{i}") for i in range(n)], bits)
    rows = sorted(cells.select(index.alias("h"), "*").collect())
    assert [r["h"] for r in rows] == list(range(size**n))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[f"x{i}"] - b[f"x{i}"]) for i in range(n)) == 1


def _holds_law(rows, count):
    held = Counter(r["shard"] for r in rows)
    assert set(held) <= set(range(count))
    sizes = [held[s] for s in range(count)]
    assert max(sizes) - min(sizes) <= 1
    for s in held:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(held[s]))


def test_row_law_sizes_and_checksums(spark, tables):
    docs = read(spark, tables, "documents")
    rows = sharding.shards(docs).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]])
    _holds_law(rows, 8)
    again = sharding.shards(docs.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_sources_stay_together(spark, tables):
    rows = sharding.shards(read(spark, tables, "documents")).collect()
    spread = Counter(r["source"] for r in {(r["source"], r["shard"]): r for r in rows}.values())
    assert sum(spread.values()) / len(spread) < 5  # of 8 shards, 20 sources


def test_messy_few_and_no_rows(messy, no_docs):
    rows = sharding.shards(messy).collect()
    assert len(rows) == messy.count()
    _holds_law(rows, 8)
    _holds_law(sharding.shards(messy.limit(3)).collect(), 8)
    assert sharding.shards(no_docs).count() == 0


def test_written_shards(spark, tables, tmp_path):
    docs = read(spark, tables, "documents")
    sharding.write_shards(docs, f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [125] * 8


def test_written_rows_repeat_and_names_clash(spark, tmp_path):
    """Repeated ids and rows are written once each; columns named like the folder keep their values."""
    rows = [(1, "a", "s", "en", 7, 8, 9), (1, "a", "s", "en", 7, 8, 9), (1, "b", "s", None, 1, 2, 3), (None, None, None, "en", 4, 5, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, shard int, slot int, Shard int")
    sharding.write_shards(docs, f"{tmp_path}/clash", 2)
    back = spark.read.parquet(f"{tmp_path}/clash")
    assert back.columns == ["doc_id", "text", "source", "lang", "shard_", "slot", "Shard__", "shard"]
    found = sorted([tuple(r)[:7] for r in back.collect()], key=repr)
    assert found == sorted(rows, key=repr)
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [2, 2]
