import json
import os

import pytest

from cohortflow.operators.relational import repeated_keys
from cohortflow.plans.sql_step import sanitize_table_name, sql_transform
from cohortflow.session import shared_folder
from cohortflow.sources import catalog, io

REQUESTS = [
    {
        "id": "r-1", "schema": "req_r_1", "dataset": "AFT", "use_case": "a", "status": " Approved ", "cohorts": [101, 102],
        "tables": [{"name": "person", "relation": "req_r_1.person"}, None, {"name": "visit", "relation": "req_r_1.visit"}],
        "concepts": [{"concept_id": 5, "cohort": 101, "subgroup": "x"}, {"cohort": 102, "source_field_name": "f"}],
    },
    {"id": "r-2", "schema": "req_r_2", "status": "pending", "cohorts": None},
]
VIEWS = [
    {"name": "people", "category": "Clinical", "columns": [
        {"name": "id", "type": "int", "accessible": True}, {"name": "secret", "type": "string", "accessible": False}, {"name": "v"}]},
    {"name": "closed", "columns": [{"name": "id", "accessible": False}]},
]


def lines(path, documents):
    path.write_text("\n".join(json.dumps(d) for d in documents))
    return str(path)


@pytest.fixture()
def requests(spark, tmp_path):
    return catalog.read_requests(spark, lines(tmp_path / "r.json", REQUESTS))


@pytest.fixture()
def views(spark, tmp_path):
    return catalog.read_views(spark, lines(tmp_path / "v.json", VIEWS))


@pytest.fixture()
def people(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (2, "y", None)], "id int, secret string, v double")
    df.createOrReplaceTempView("people")
    df.createOrReplaceTempView("closed")
    return df


def tuples(df):
    return sorted(map(tuple, df.collect()))


def test_request_frames(requests):
    assert tuples(catalog.requests_frame(requests)) == [
        ("r-1", "AFT", "a", " Approved ", "101, 102", "person", "req_r_1.person"),
        ("r-1", "AFT", "a", " Approved ", "101, 102", "visit", "req_r_1.visit"),
        ("r-2", "", "", "pending", "", "", ""),
    ]
    assert [r[-1] for r in tuples(catalog.requests_summary(requests))] == [2, 0]
    assert tuples(catalog.concepts_frame(requests)) == [("r-1", 0, 102, "", "f", ""), ("r-1", 5, 101, "x", "", "")]
    assert [r.id for r in catalog.approved(requests).collect()] == ["r-1"]


def test_resolve_and_select(requests):
    for key in (None, "r-1", "req_r_1"):
        assert catalog.resolve_request(requests, key)["id"] == "r-1"
    with pytest.raises(catalog.AccessError, match="Unknown"):
        catalog.resolve_request(requests, "r-9")
    with pytest.raises(catalog.AccessError, match="not approved"):
        catalog.resolve_request(requests, "r-2")
    with pytest.raises(catalog.AccessError, match="no approved"):
        catalog.resolve_request(requests.filter("id = 'r-2'"))
    with pytest.raises(catalog.AccessError, match="2 approved"):
        catalog.resolve_request(requests.union(requests))
    request = catalog.resolve_request(requests)
    assert catalog.select_tables(request) == ["person", "visit"]
    assert catalog.select_tables(request, ["visit", "person"]) == ["visit", "person"]
    with pytest.raises(catalog.AccessError, match="not granted"):
        catalog.select_tables(request, ["death"])


def test_views(spark, views, people):
    assert tuples(catalog.views_frame(views))[1] == ("people", "Clinical", "id", "int", "", True)
    assert catalog.view_columns(views, "people") == ["id"]
    assert io.granted_view(spark, views, "people").columns == ["id"]
    assert io.granted_view(spark, views, "people", 1).count() == 1
    assert list(io.granted_views(spark, views)) == ["people"]
    with pytest.raises(catalog.AccessError, match="may be read"):
        io.granted_view(spark, views, "closed")
    with pytest.raises(catalog.AccessError, match="Unknown view"):
        io.granted_view(spark, views, "nope")


def test_cohorts(spark):
    registry = {101: "North", 102: "South"}
    assert catalog.resolve_cohorts(registry, [101, 103, 102]) == catalog.CohortChoice([101, 102], False, [103])
    assert catalog.resolve_cohorts(registry, [101], " __all__ ").ids == [101]
    assert catalog.resolve_cohorts(registry, [], "South") == catalog.CohortChoice([102], True, [])
    mappings = spark.createDataFrame(
        [(101, "North", "O'Hara", True), (None, "x", "O'Hara", True), (5, None, "O'Hara", True), (6, "y", "O'Hara", False)],
        "cohort_id int, cohort_name string, org_name string, is_active boolean",
    )
    assert catalog.active_cohorts(mappings, "O'Hara") == {101: "North"}


def test_governed_rows(spark):
    north = spark.createDataFrame([(1, 5), (2, 6)], "person_id int, concept int")
    south = spark.createDataFrame([(1, 5), (2, 6)], "person_id int, concept int")
    grants = spark.createDataFrame([(101, 5), (102, 6)], "cohort int, concept_id int")
    rows = catalog.governed_relation({102: south, 101: north}, grants, "concept")
    assert rows.columns[0] == "cohort_id" or "cohort_id" in rows.columns
    assert tuples(rows.select("cohort_id", "person_id", "concept")) == [(101, 1, 5), (102, 2, 6)]
    whole = catalog.governed_relation({101: north, 102: south}, grants)
    assert whole.count() == 4
    assert catalog.cohort_join(whole, whole.select("cohort_id", "person_id"), "person_id").count() == 4
    counts = catalog.row_counts({"north": north, "whole": whole})
    assert [tuple(r) for r in counts.collect()] == [("north", 2), ("whole", 4)]
    with pytest.raises(catalog.AccessError):
        catalog.row_counts({"north": north}, ["south"])


def test_granted_table(spark, people):
    assert io.granted_table(spark, "people").count() == 2
    assert io.granted_table(spark, "people", "1").count() == 1
    assert [io.row_cap(x) for x in (None, "", " ", 0, "0", 7)] == [None] * 5 + [7]
    for bad in (-1, "x", "1.5"):
        with pytest.raises(ValueError):
            io.granted_table(spark, "people", bad)
    with pytest.raises(ValueError, match="Invalid table_name"):
        io.granted_table(spark, "people; drop")


def test_read_table_and_formats(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "a.parquet"))
    people.write.csv(str(tmp_path / "a.CSV"), header=True)
    people.write.csv(str(tmp_path / "a.tsv"), header=True, sep="\t")
    for name in ("a.parquet", "a.CSV", "a.tsv"):
        assert tuples(io.read_table(spark, str(tmp_path / name))) == tuples(people)
    with pytest.raises(ValueError, match="accepted"):
        io.read_table(spark, "x.xlsx")
    (tmp_path / "array.json").write_text('\n[{"a": 1},\n {"a": 2}]')
    (tmp_path / "lines.json").write_text('{"a": 1}\n{"a": 2}')
    for name in ("array.json", "lines.json"):
        assert tuples(io.read_format(spark, str(tmp_path / name), "JSON")) == [(1,), (2,)]
    assert io.read_format(spark, str(tmp_path / "a.parquet"), "odd").count() == 2


def test_outputs_come_from_the_first_one(spark, people, tmp_path):
    files = [{"path": str(tmp_path / f), "format": f} for f in ("csv", "json", "parquet")]
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            calls.add(len(batch))
            yield batch

    io.write_outputs(people.coalesce(1).mapInPandas(seen, people.schema), files)
    assert calls.value == 2
    for f in files:
        assert tuples(io.read_format(spark, f["path"], f["format"])) == tuples(people)
    io.write_fanout(people, [str(tmp_path / "x"), str(tmp_path / "y")], None)
    assert spark.read.parquet(str(tmp_path / "y")).count() == 2
    empty = io.empty_frame(spark, "a int, b string")
    io.write_output(empty, str(tmp_path / "empty"))
    assert spark.read.parquet(str(tmp_path / "empty")).columns == ["a", "b"]
    io.write_output(empty, str(tmp_path / "empty.csv"), "csv")
    assert io.read_table(spark, str(tmp_path / "empty.csv")).columns == ["a", "b"]
    with pytest.raises(ValueError):
        io.write_outputs(people, [])


def test_export(people, tmp_path):
    tables = {"person": people, "a/b c": people}
    dest = str(tmp_path / "out")
    assert io.export_tables(tables, dest) == [f"{dest}/person.parquet", f"{dest}/b_c.parquet"]
    assert os.path.exists(f"{dest}/person.parquet/_SUCCESS")
    assert io.export_tables(tables, dest, ["person"], "csv", max_rows=1) == [f"{dest}/person.csv"]
    with pytest.raises(ValueError, match="Already there"):
        io.export_tables(tables, dest, overwrite=False)
    with pytest.raises(ValueError, match="does not exist"):
        io.export_tables(tables, str(tmp_path / "none"), create_dir=False)
    with pytest.raises(ValueError, match="share a file"):
        io.export_tables({"a b": people, "a_b": people}, dest)
    for bad in ({"file_format": "xml"}, {"max_rows": 0}, {"names": ["death"]}):
        with pytest.raises(ValueError):
            io.export_tables(tables, dest, **bad)


def test_batches(spark):
    assert [len(b) for b in io.iter_batches(spark.range(5), 2)] == [2, 2, 1]
    for bad in (0, -1, True, "2"):
        with pytest.raises(ValueError):
            io.iter_batches(spark.range(5), bad)


def test_jdbc_arguments(spark):
    with pytest.raises(ValueError, match="Invalid table_name"):
        io.jdbc_table(spark, "jdbc:none", "person; drop")
    with pytest.raises(ValueError, match="bounds"):
        io.jdbc_table(spark, "jdbc:none", "cdm.person", partition_column="person_id")


def test_few_files_are_spread(spark, tmp_path):
    df = spark.range(1000)
    df.coalesce(1).write.parquet(str(tmp_path / "one"))
    df.repartition(12).write.parquet(str(tmp_path / "many"))
    few, many = (spark.read.parquet(str(tmp_path / n)) for n in ("one", "many"))
    assert io.spread_few_files(few).rdd.getNumPartitions() == 8
    assert io.spread_few_files(many) is many


def test_query_with_parameters(spark, people):
    assert tuples(io.run_query(spark, "SELECT id FROM people WHERE secret = :s", {"s": "y"})) == [(2,)]
    assert repeated_keys(people.union(people), ["id"]).count() == 2


def test_sql_transform(spark, people, tmp_path):
    assert sanitize_table_name("My node-1") == "My_node_1"
    out = sql_transform(spark, "SELECT count(*) AS n FROM input_data", {"my people": people})
    assert out.result.first()["n"] == 2
    assert sql_transform(spark, "SELECT * FROM my_people", {"my people": people}).result.count() == 2
    two = {"a": people, "b": people}
    files = [{"path": str(tmp_path / "o.parquet"), "format": "parquet"}, {"path": str(tmp_path / "o.csv"), "format": "csv"}]
    done = sql_transform(spark, "SELECT a.id FROM a JOIN b ON a.id = b.id", two, files, "my step")
    assert done.row_count == 2
    assert io.read_format(spark, files[1]["path"], "csv").count() == 2
    with pytest.raises(Exception, match="input_data"):
        sql_transform(spark, "SELECT * FROM input_data", two).result.count()
    path = str(tmp_path / "in.csv")
    people.write.csv(path, header=True)
    assert sql_transform(spark, "SELECT * FROM input_data", {"x": {"path": path, "format": "csv"}}).result.count() == 2


@pytest.mark.parametrize(
    "change, message",
    [({"name": ""}, "name"), ({"sql": " "}, "sql"), ({"inputs": {}}, "input"), ({"outputs": []}, "output"),
     ({"inputs": {"a b": None, "a_b": None}}, "share the table name")],
)
def test_sql_transform_checks(spark, change, message):
    with pytest.raises(ValueError, match=message):
        sql_transform(**{"spark": spark, "sql": "SELECT 1", "inputs": {"a": None}, **change})


def test_csv_round_trip_of_awkward_texts(spark, tmp_path):
    texts = ['he said "yes, no" twice', "line one\nline two", "a\r\nb", "", None, " padded ", "tab\there", '"', ",", "\\", 'x\\"y']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    files = [{"path": str(tmp_path / f"a.{f}"), "format": f} for f in ("csv", "json", "parquet")]
    io.write_outputs(df, files)
    want = [tuple(r) for r in df.orderBy("id").collect()]
    for f in files:
        back = io.read_format(spark, f["path"], f["format"], "id int, body string")
        assert [tuple(r) for r in back.orderBy("id").collect()] == want, f["format"]
    assert [tuple(r) for r in io.read_table(spark, str(tmp_path / "a.csv")).orderBy("id").collect()] == want


def test_a_shared_folder_must_be_named():
    class Bare:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)

        class sparkContext:  # noqa: N801
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Bare)
