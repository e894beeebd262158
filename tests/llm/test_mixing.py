import re
from collections import defaultdict
from fractions import Fraction

from cohortflow.llm import mixing
from cohortflow.llm.common import read


def _shares(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    """Targets by the rule as it is told: share by weight, cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = Fraction(sum(sizes.values())), set(names), {s: Fraction(0) for s in names}
    while left and open_:
        total = sum(weight[s] for s in open_)
        given = {s: out[s] + left * weight[s] / total for s in open_}
        left = Fraction(0)
        for s in list(open_):
            out[s] = min(given[s], Fraction(most * sizes[s]))
            if given[s] >= most * sizes[s]:
                left += given[s] - out[s]
                open_.discard(s)
    return out


def _words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_follow_the_rule(spark):
    for sizes in ({"a": 10, "b": 1000, None: 3}, {"a": 0, "b": 5}, {"x": 7}, {f"s{i}": i * i for i in range(12)}):
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
        want = _shares(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - float(want[s])) < 1e-6 for s in want)


def test_sizes_copies_and_nearness(spark, tables):
    docs = read(spark, tables, "documents")
    rows = mixing.mixed_sizes(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == len(texts)
    taken, target = defaultdict(int), {}
    for r in rows:
        assert r["size"] == _words(texts[r["doc_id"]])
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) < 0.05 * target[s] for s in target)
    again = mixing.mixed_sizes(docs.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_whole_epochs_come_before_a_part(spark):
    rows = [(i, "w " * 10, "big") for i in range(90)] + [(100 + i, "w " * 10, "z") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    # 1,000 words; "big" weighs 5 of 7, "z" is capped at 3 times its 100.
    got = {r["doc_id"]: r["copies"] for r in mixing.mixed_sizes(docs).collect()}
    assert all(got[100 + i] in (2, 3) for i in range(10)) and sum(got[100 + i] for i in range(10)) * 10 in (280, 290)
    assert sum(got[i] for i in range(90)) in (71, 72)


def test_more_quality_is_taken_more_often(spark):
    rows = [(i, "plain words only here" if i % 2 else "9 8 7 6", "s") for i in range(2000)]
    rows += [(9000 + i, "w " * 4, "t") for i in range(2000)]  # weighs less, so "s" is not taken whole
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.replace({"s": "u"}, subset=["source"])
    got = [r for r in mixing.mixed_sizes(docs).collect() if r["source"] == "u" and r["copies"]]
    good = sum(r["doc_id"] % 2 for r in got)
    assert good > 1.5 * (len(got) - good)


def test_the_query_itself_fills_what_is_left_over(spark, tmp_path):
    """The query on a small source with one very long document: nearer than its shortest document left."""
    hot = spark.range(30_000).selectExpr("id + 10000 AS doc_id", "'w w' AS text", "'hot' AS source")
    rows = [(i, "w " * (100 + 7 * i % 401), "z") for i in range(300)] + [(939, "w " * 100_000, "z")]
    docs = hot.unionByName(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [r for r in mixing.op1_mixing(spark, str(tmp_path)).collect() if r["source"] == "z"]
    missed = got[0]["target"] - sum(r["taken"] for r in got)
    assert 0 <= missed < min(r["size"] for r in got if not r["taken"])


def test_no_python_in_the_plan(spark, tables):
    plan = mixing.mix(read(spark, tables, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_what_a_long_document_leaves_over_is_filled_from_all_cells(spark):
    """A small source with one very long document, beside one that makes the key cells many."""
    hot = spark.range(30_000).selectExpr("id + 10000 AS doc_id", "'w w' AS text", "'hot' AS source")
    rows = [(i, "w " * (100 + 7 * i % 401), "z") for i in range(300)] + [(939, "w " * 100_000, "z")]
    docs = hot.unionByName(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    keys = {r["doc_id"]: r["key"] for r in mixing.keyed(docs).where("source = 'z'").collect()}
    got = [r for r in mixing.mixed_sizes(docs, (4, 1)).collect() if r["source"] == "z"]
    target = got[0]["target"]
    want, left = {}, target
    for r in sorted(got, key=lambda r: keys[r["doc_id"]]):
        want[r["doc_id"]] = int(r["size"] <= left)
        left -= r["size"] * want[r["doc_id"]]
    assert sum(want.values()) < len(want) and 0 < target < 100_000
    assert {r["doc_id"]: r["copies"] for r in got} == want
    assert left < min(r["size"] for r in got if not r["copies"])


def test_mix_repeats_rows_as_counted(spark, messy):
    counted = sorted((r["doc_id"] or -1, r["size"], r["copies"]) for r in mixing.mixed_sizes(messy).collect())
    mixed = mixing.mix(messy)
    assert mixed.columns == messy.columns
    got = defaultdict(int)
    for row in mixed.collect():
        got[(row[0] or -1, _words(row[1]))] += 1
    want = defaultdict(int)
    for doc_id, size, copies in counted:
        want[(doc_id, size)] += copies
    assert got == {k: v for k, v in want.items() if v}


def test_empty_table(no_docs):
    assert mixing.mixed_sizes(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0
