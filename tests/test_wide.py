import datetime as dt

import pytest

from cohortflow.functions.exprs import age_in_years
from cohortflow.operators import wide
from cohortflow.operators.wide import coerce_numeric, concept_map, export_notes, person_base, wide_stacked, wide_tables
from cohortflow.session import stage
from pyspark.sql import functions as F

ORG = "Study House"
D = dt.date


@pytest.fixture(scope="module")
def tables(spark):
    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "person": table(
            [
                (101, 1, "A", 8507, 1950, 6, 15),
                (101, 2, "B", 8532, 1960, None, None),
                (101, 3, "nobody", 8507, 1960, 1, 1),
                (102, 1, "A", 0, 1940, 2, 30),
            ],
            "cohort_id int, person_id long, person_source_value string, gender_concept_id int, year_of_birth int, month_of_birth int, day_of_birth int",
        ),
        "cmp_participants": table(
            [(101, "A", "SA"), (101, "B", "SB"), (102, "A", "TA")], "cohort_id int, barcode string, subject_id string"
        ),
        "visit_occurrence": table(
            [
                (101, 10, 1, "V1", D(2020, 6, 14)),
                (101, 11, 2, "V1", D(2020, 1, 1)),
                (102, 10, 1, "V1", D(2021, 3, 1)),
                (101, 12, 3, "V1", D(2020, 1, 1)),
            ],
            "cohort_id int, visit_occurrence_id long, person_id long, visit_source_value string, visit_start_date date",
        ),
        "measurement": table(
            [
                (101, 1, 10, 500, 1.5),
                (101, 1, 10, 500, 1.5),
                (101, 1, None, 500, 9.0),
                (101, 2, 11, 500, None),
                (102, 1, 10, 500, 7.0),
                (101, 3, 12, 500, 3.0),
                (101, 1, 10, 999, 3.0),
                (101, 1, 10, 502, 4.0),
            ],
            "cohort_id int, person_id long, visit_occurrence_id long, measurement_source_concept_id long, value_as_number double",
        ),
        "observation": table(
            [
                (101, 1, 10, 501, "yes"),
                (101, 2, 11, 501, "3"),
                (102, 1, 10, 501, "3"),
                (101, 2, 11, 503, "n/a"),
                (101, 2, 11, 504, "12"),
            ],
            "cohort_id int, person_id long, visit_occurrence_id long, observation_source_concept_id long, value_as_string string",
        ),
        "local_concept": table(
            [
                (101, 500, "score", "Total score", "Clinical"),
                (102, 500, "", "score", "Clinical"),
                (101, 501, "smoker", "Smokes", "Clinical"),
                (102, 501, "smoker", "Smokes", "Clinical"),
                (101, 502, "level", "Level", ""),
                (101, 503, "level", "Level", "Blood"),
                (101, 504, "score", "Score", "Blood"),
                (101, None, "x", "x", "Blood"),
                (101, 505, None, None, "Blood"),
            ],
            "cohort int, concept_id long, source_field_name string, source_field_description string, dataset string",
        ),
        "cohort_mappings": table(
            [(101, "North", ORG, True), (102, "South", ORG, True), (103, "Old", ORG, False), (104, "Else", "Other", True)],
            "cohort_id int, cohort_name string, org_name string, is_active boolean",
        ),
    }


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_all_cohorts(tables):
    sheets = wide_tables(tables, [101, 102, 103], ORG)
    assert sorted(sheets) == ["Blood", "Clinical", "Unknown"]
    clinical = sheets["Clinical"]
    lead = ["Cohort", "Barcode", "Subject_ID", "Gender", "Age_at_Visit", "Visit", "Assessment_Date"]
    assert clinical.columns == [*lead, "score", "smoker"]
    assert dict(clinical.dtypes)["score"] == "double"
    assert dict(clinical.dtypes)["smoker"] == "string"
    got = {(r["Cohort"], r["Barcode"]): r for r in rows(clinical)}
    assert got.keys() == {("North", "A"), ("North", "B"), ("South", "A")}
    a = got["North", "A"]
    assert (a["Gender"], a["Age_at_Visit"], a["score"], a["smoker"]) == ("Male", 69, 1.5, "yes")
    b = got["North", "B"]
    assert (b["Gender"], b["Age_at_Visit"], b["score"], b["smoker"]) == ("Female", 60, None, "3")
    assert (got["South", "A"]["Gender"], got["South", "A"]["Age_at_Visit"]) == ("Unknown", None)


@pytest.mark.parametrize("cohort", [101, "101", " North "])
def test_one_cohort_has_no_cohort_column(tables, cohort):
    sheets = wide_tables(tables, [101, 102], ORG, cohort=cohort)
    assert "Cohort" not in sheets["Clinical"].columns
    assert sheets["Clinical"].count() == 2


def test_numeric_decision_is_taken_over_all_cohorts(tables):
    south = wide_tables(tables, [102], ORG, cohort="South")["Clinical"]
    assert dict(south.dtypes)["smoker"] == "double"


def test_description_labels(tables):
    sheets = wide_tables(tables, [101], ORG, cohort=101, source_field="source_field_description")
    assert sheets["Clinical"].columns[-2:] == ["Smokes", "Total score"]


def test_stacked(tables):
    out = wide_stacked(tables, [101, 102], ORG)
    assert out.columns[:3] == ["dataset", "Cohort", "Barcode"]
    assert out.columns[-3:] == ["level", "score", "smoker"]
    kinds = dict(out.dtypes)
    assert (kinds["level"], kinds["score"], kinds["smoker"]) == ("string", "double", "string")
    got = [(r["dataset"], r["Cohort"], r["Barcode"], r["level"], r["score"]) for r in rows(out)]
    assert got == [
        ("Blood", "North", "B", "n/a", 12.0),
        ("Clinical", "North", "A", None, 1.5),
        ("Clinical", "North", "B", None, None),
        ("Clinical", "South", "A", None, 7.0),
        ("Unknown", "North", "A", "4.0", None),
    ]


def test_errors(tables):
    with pytest.raises(ValueError, match="source_field"):
        wide_tables(tables, [101], ORG, source_field="other")
    with pytest.raises(ValueError, match="Unknown cohort name"):
        wide_tables(tables, [101], ORG, cohort="Nowhere")
    with pytest.raises(ValueError, match="not active"):
        wide_tables(tables, [101], ORG, cohort=103)
    with pytest.raises(RuntimeError, match="no active cohorts"):
        wide_tables(tables, [103], ORG)
    empty = {**tables, "measurement": tables["measurement"].limit(0), "observation": tables["observation"].limit(0)}
    with pytest.raises(RuntimeError, match="No data"):
        wide_tables(empty, [101], ORG)


def test_concepts_and_persons(tables):
    labels = {(r["cohort_id"], r["concept_id"]): (r["dataset"], r["field_name"]) for r in rows(concept_map(tables["local_concept"]))}
    assert labels[102, 500] == ("Clinical", "score")
    assert labels[101, 502] == ("Unknown", "level")
    assert (101, 505) not in labels and len(labels) == 7
    people = person_base(tables["person"], tables["cmp_participants"])
    assert sorted((r["cohort_id"], r["Barcode"], str(r["_born"])) for r in rows(people)) == [
        (101, "A", "1950-06-15"), (101, "B", "1960-01-01"), (102, "A", "None"),
    ]


def test_coercion(spark):
    df = spark.createDataFrame(
        [("001", "1", "1", "1", None), ("002", "-2.5", "Unknown", "", None), ("003", "1e3", None, None, None), ("004", None, "3", "3", None)],
        "Barcode string, numeric string, mixed string, blank string, empty string",
    )
    out = coerce_numeric(df, ["Barcode"])
    assert [t for _, t in out.dtypes] == ["string", "double", "string", "string", "string"]
    assert [r.numeric for r in out.orderBy("Barcode").collect()] == [1.0, -2.5, 1000.0, None]


@pytest.mark.parametrize(
    "on, born, age",
    [("2001-02-28", "2000-02-29", 0), ("2001-03-01", "2000-02-29", 1), ("2020-06-14", "1950-06-15", 69),
     ("2020-06-15", "1950-06-15", 70), ("2000-01-01", "2000-06-01", 0), ("2000-01-01", "2001-06-01", -1)],
)
def test_age(spark, on, born, age):
    df = spark.createDataFrame([(dt.date.fromisoformat(on), dt.date.fromisoformat(born))], "a date, b date")
    assert df.select(age_in_years(F.col("a"), F.col("b"))).first()[0] == age


def test_one_visit_with_most_rows(spark, tables):
    many = spark.range(5000).selectExpr(
        "101 as cohort_id", "1L as person_id", "10L as visit_occurrence_id", "500L as measurement_source_concept_id", "cast(id % 3 as double) + 1.5 as value_as_number"
    )
    out = wide_tables({**tables, "measurement": tables["measurement"].unionByName(many)}, [101], ORG, cohort=101)
    assert [r["score"] for r in rows(out["Clinical"])] == [1.5, None]


def test_fields_that_differ_in_case_only(spark, tables):
    concepts = tables["local_concept"].unionByName(
        spark.createDataFrame(
            [(101, 600, "gender", "", "Clinical"), (101, 601, "GENDER", "", "Clinical"), (101, 602, "SCORE", "", "Clinical")],
            tables["local_concept"].schema,
        )
    )
    more = spark.createDataFrame(
        [(101, 1, 10, 600, "f"), (101, 1, 10, 601, "F"), (101, 1, 10, 602, "9")], tables["observation"].schema
    )
    given = {**tables, "local_concept": concepts, "observation": tables["observation"].unionByName(more)}
    clinical = wide_tables(given, [101], ORG, cohort=101)["Clinical"]
    assert clinical.columns[-5:] == ["GENDER", "SCORE", "gender", "score", "smoker"]
    row = next(tuple(r)[-5:] for r in clinical.collect() if r["Barcode"] == "A")
    assert row == ("F", 9.0, "f", 1.5, "yes")
    clash = spark.createDataFrame([(101, 500, "Visit", "", "Clinical")], tables["local_concept"].schema)
    with pytest.raises(ValueError, match="Visit"):
        wide_tables({**tables, "local_concept": clash}, [101], ORG, cohort=101)


def test_notes_on_what_is_left_out(spark, tables):
    person = tables["person"]
    odd = person.limit(1).withColumn("month_of_birth", F.lit(2)).withColumn("day_of_birth", F.lit(31))
    rest = person.join(odd.select("cohort_id", "person_id"), ["cohort_id", "person_id"], "left_anti")
    given = {**tables, "person": rest.unionByName(odd.select(*[F.col(f.name).cast(f.dataType) for f in person.schema]))}
    before = export_notes(tables, [101, 102, 103], ORG).first()
    after = export_notes(given, [101, 102, 103], ORG).first()
    assert before["skipped_cohorts"] == [103]
    assert after["impossible_births"] == before["impossible_births"] + 1


def test_values_are_not_shuffled_once_they_are_gathered(spark, tables, monkeypatch):
    """A visit's values travel to the sheets as one row per dataset, and only shared identities are grouped again."""
    plans = {}

    def spy(df, name, *more):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, name, *more)

    monkeypatch.setattr(wide, "stage", spy)
    assert wide_stacked(tables, [101, 102], ORG).count()
    assert plans["visit-rows"].count("collect_list(") and "min(" not in plans["visit-rows"].split("collect_list(")[0]


def test_visits_that_share_an_identity(spark, tables):
    """Two visits of a person on one day with one label are one row; numbers count before texts, then the smallest."""
    visit = tables["visit_occurrence"].where("cohort_id = 101 AND visit_occurrence_id = 10")
    again = visit.withColumn("visit_occurrence_id", F.lit(77).cast(visit.schema["visit_occurrence_id"].dataType))
    extra = spark.range(3).selectExpr(
        "101 as cohort_id", "1L as person_id", "77L as visit_occurrence_id", "500L as measurement_source_concept_id", "cast(id as double) - 5 as value_as_number"
    )
    changed = {**tables, "visit_occurrence": tables["visit_occurrence"].unionByName(again), "measurement": tables["measurement"].unionByName(extra)}
    before = rows(wide_tables(tables, [101], ORG, cohort=101)["Clinical"])
    after = rows(wide_tables(changed, [101], ORG, cohort=101)["Clinical"])
    assert len(after) == len(before)
    assert "-3.0" < "-4.0" < "-5.0" and -3.0 in [r["score"] for r in after]


def test_only_the_sheets_asked_for(tables, monkeypatch):
    """Values of other datasets are dropped with the concepts, so they reach neither shuffle nor staged rows."""
    staged = {}

    def spy(df, name, *more):
        staged[name] = stage(df, name, *more)
        return staged[name]

    monkeypatch.setattr(wide, "stage", spy)
    whole = wide_tables(tables, [101, 102], ORG)
    assert {r["dataset"] for r in staged["visit-rows"].collect()} == {"Blood", "Clinical", "Unknown"}
    for name in ("Clinical", "Unknown"):
        asked = wide_tables(tables, [101, 102], ORG, datasets=[name])
        assert list(asked) == [name] and {r["dataset"] for r in staged["visit-rows"].collect()} == {name}
        assert asked[name].schema == whole[name].schema and asked[name].collect() == whole[name].collect()
    with pytest.raises(RuntimeError, match="No data"):
        wide_tables(tables, [101, 102], ORG, datasets=["Nowhere"])


def test_gathering_sorts_once(tables, monkeypatch):
    """The window that gathers a visit's values has the order the join with the visits needs; no lists are sorted."""
    plans = {}

    def spy(df, name, *more):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, name, *more)

    monkeypatch.setattr(wide, "stage", spy)
    assert wide_stacked(tables, [101, 102], ORG).count()
    plan = plans["visit-rows"]
    assert "Window [" in plan and "ObjectHashAggregate" not in plan and "array_sort" not in plan


def test_concepts_that_share_a_field(spark, tables):
    """Per field the number of the smallest spelling counts, whatever concept holds it; a concept listed twice counts once."""
    concepts = tables["local_concept"].unionByName(
        spark.createDataFrame(
            [(101, 700, "score", "", "Clinical"), (101, 700, "score", "", "Clinical"), (101, 701, "score", "", "Clinical"), (101, 700, "level", "", "Blood")],
            tables["local_concept"].schema,
        )
    )
    numbers = spark.createDataFrame([(101, 1, 10, 700, 1.25), (101, 2, 11, 701, None)], tables["measurement"].schema)
    texts = spark.createDataFrame([(101, 1, 10, 701, "0"), (101, 2, 11, 700, "8")], tables["observation"].schema)
    given = {
        **tables,
        "local_concept": concepts,
        "measurement": tables["measurement"].unionByName(numbers),
        "observation": tables["observation"].unionByName(texts),
    }
    sheets = wide_tables(given, [101], ORG, cohort=101)
    assert [(r["Barcode"], r["score"]) for r in rows(sheets["Clinical"])] == [("A", 1.25), ("B", 8.0)]
    assert [(r["Barcode"], r["level"]) for r in rows(sheets["Blood"])] == [("A", 1.25), ("B", 8.0)]  # "8" < "n/a"
