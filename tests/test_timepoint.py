import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortflow.operators.schedule import build_schedule
from cohortflow.operators.timepoint import assign_timepoints

BASE = {"scheme": "TLSA", "days_per_year": 365, "max_timepoints": 20}


def visits(spark, rows, schema="Barcode string, AppointmentDate string"):
    return spark.createDataFrame(rows, schema)


def run(df, **config):
    return assign_timepoints(df, **{**BASE, **config})


def by_visit(result, *columns, order=("Barcode", "AppointmentDate")):
    return [tuple(r) for r in result.timepoints.orderBy(*order).select(*columns).collect()]


def p1(spark, *dates):
    return visits(spark, [("P1", d) for d in dates])


def test_yearly_visits_get_consecutive_timepoints(spark):
    out = run(p1(spark, "2020-01-01", "2021-01-01", "2022-01-01", "2023-01-01"))
    assert by_visit(out, "timepoint") == [("T1",), ("T2",), ("T3",), ("T4",)]
    assert out.duplicates.count() == 0


@pytest.mark.parametrize("rule, kept", [("latest", 1.16), ("earliest", 0.75), ("closest", 1.16), ("?", 1.16)])
def test_collision_rule(spark, rule, kept):
    out = run(p1(spark, "2020-01-01", "2020-10-01", "2021-03-01"), collision_rule=rule)
    assert by_visit(out, "timepoint", "years_from_baseline") == [("T1", 0.0), ("T2", kept)]
    (row,) = out.duplicates.collect()
    assert row.asDict() == {
        "Barcode": "P1",
        "timepoint": "T2",
        "timepoint_index": 2,
        "n_visits": 2,
        "candidate_years": "0.75, 1.16",
        "candidate_dates": "2020-10-01, 2021-03-01",
        "kept_years": kept,
    }


@pytest.mark.parametrize("rule", ["latest", "earliest", "closest"])
def test_first_window_keeps_the_baseline(spark, rule):
    out = run(p1(spark, "2020-01-01", "2020-04-01"), collision_rule=rule)
    assert by_visit(out, "years_from_baseline") == [(0.0,)]


def test_keep_all_rows_keeps_labels_of_collision_losers(spark):
    df = p1(spark, "2020-01-01", "2020-09-28")
    assert run(df).timepoints.count() == 1
    kept = run(df, drop_unassigned=False)
    assert by_visit(kept, "timepoint", "is_selected_visit") == [("T1", True), ("T1", False)]


def test_promotion(spark):
    on = {"promote_late_baseline": True, "promote_window_fraction": 0.5}
    assert by_visit(run(p1(spark, "2020-01-01"), **on), "timepoint") == [("T1",)]
    two = p1(spark, "2020-01-01", "2020-09-25")
    assert by_visit(run(two, **on), "timepoint", "years_from_baseline") == [("T1", 0.0), ("T2", 0.73)]
    off = run(two)
    assert by_visit(off, "timepoint") == [("T1",)]
    assert off.duplicates.count() == 1


def test_cohort_filter_and_own_baselines(spark):
    """A cohort is compared without the blanks around it; each person counts from the first visit that is left."""
    rows = [
        ("K7", "2011-03-10", "north"),
        ("K7", "2013-03-10", "north  "),
        ("M2", "2017-12-01", "south"),
        ("M2", "2018-09-05", " north"),
        ("R4", "2016-02-02", "south"),
    ]
    df = visits(spark, rows, "Barcode string, AppointmentDate string, Region string")
    north = run(df, cohort_column="Region", cohort_value="north")
    assert by_visit(north, "Barcode", "years_from_baseline") == [("K7", 0.0), ("K7", 2.0), ("M2", 0.0)]
    with pytest.raises(ValueError):
        run(df, cohort_column="Region", cohort_value="west").timepoints.count()


@pytest.mark.parametrize(("divisor", "years"), [(365, 2.0), (365.25, 2.0), (None, 2.0), (146, 5.0)])
def test_year_divisor(spark, divisor, years):
    out = run(p1(spark, "2010-07-15", "2012-07-14"), days_per_year=divisor)
    assert out.timepoints.agg(F.max("years_from_baseline")).first()[0] == years


def test_deviation_and_tolerance(spark):
    out = run(p1(spark, "2020-01-01", "2020-12-13", "2022-03-21"))
    assert by_visit(out, "deviation_years", "within_tolerance") == [(0.0, True), (-0.05, True), (0.22, True)]
    off = p1(spark, "2020-01-01", "2021-07-09")
    assert by_visit(run(off), "timepoint", "deviation_years", "within_tolerance") == [
        ("T1", 0.0, True),
        ("T3", -0.48, False),
    ]
    assert by_visit(run(off, tolerance_years=0.5), "within_tolerance") == [(True,), (True,)]
    assert by_visit(run(off, tolerance_years=0), "within_tolerance") == [(True,), (False,)]


def test_windows_given_in_days(spark):
    start = dt.date(2023, 5, 10)
    days = {"a": [0, 6, 29, 33, 61], "b": [0, 2, 58]}
    rows = [(who, (start + dt.timedelta(days=d)).isoformat(), d) for who, ds in days.items() for d in ds]
    out = assign_timepoints(
        visits(spark, rows, "who string, taken string, day int"),
        participant_column="who",
        date_column="taken",
        scheme="custom",
        custom_windows={"windows": [[0, 1], [5, 9], [25, 35], [55, 65]]},
        days_per_year=1,
        collision_rule="closest",
        tolerance_years=4,
    )
    got = by_visit(out, "who", "timepoint", "day", order=("who", "day"))
    assert got == [("a", "T1", 0), ("a", "T2", 6), ("a", "T3", 29), ("a", "T4", 61), ("b", "T1", 0), ("b", "T4", 58)]


# First and last hundredth of a year that belongs to each window; None: no window in between.
EDGES = {
    "TLSA": [(0, 74), (75, 150), (151, 250), (251, 350), (351, 450), (451, 550)],
    "SANSCOG": [(0, 149), (150, 300), (310, 500), (510, 700), (710, 900), (910, 1100)],
}


@pytest.mark.parametrize("scheme", EDGES)
def test_window_edges(spark, scheme):
    schedule = build_schedule(scheme, None, 6)
    want = {}
    for tp, (first, last) in enumerate(EDGES[scheme], start=1):
        want |= {first: tp, last: tp, (first + last) // 2: tp}
    for (_, last), (first, _) in zip(EDGES[scheme], EDGES[scheme][1:]):
        want |= {h: None for h in range(last + 1, first)}
    want |= {-1: None, EDGES[scheme][-1][1] + 1: None}
    df = spark.createDataFrame([(h, h / 100) for h in want], "h int, y double")
    assert {r.h: r.tp for r in df.withColumn("tp", schedule.match(F.col("y"))).collect()} == want


@pytest.mark.parametrize("cap, p4", [(20, ["T1", "T5", "T6"]), (4, ["T1"])])
def test_study_example(spark, cap, p4):
    start = dt.date(2020, 1, 1)
    plan = {"P1": [0, 1.52, 3.09], "P2": [0, 2.75], "P3": [0, 0.95, 2.22], "P4": [0, 3.72, 4.91]}
    rows = [
        (p, (start + dt.timedelta(days=round(y * 365))).isoformat()) for p, ys in plan.items() for y in ys
    ]
    got = {}
    for p, tp in by_visit(run(visits(spark, rows), max_timepoints=cap), "Barcode", "timepoint"):
        got.setdefault(p, []).append(tp)
    assert got == {"P1": ["T1", "T3", "T4"], "P2": ["T1", "T4"], "P3": ["T1", "T2", "T3"], "P4": p4}


def test_undated_rows_are_dropped_and_counted(spark):
    df = p1(spark, "2020-01-01", None, "not a date")
    out = run(df)
    assert out.timepoints.count() == 1
    assert out.counters.first()["undated"] == 2


def test_elapsed_days_are_whole_durations(spark):
    df = p1(spark, "2020-01-01 12:00:00", "2020-01-02 11:00:00")
    out = run(df, days_per_year=1, drop_unassigned=False)
    assert by_visit(out, "years_from_baseline") == [(0.0,), (0.0,)]


def test_counters(spark):
    df = visits(
        spark,
        [("P1", "2020-01-01"), ("P1", "2020-02-01"), ("P1", "2021-07-09"), ("P2", "2020-01-01"), ("P2", "2024-10-01")],
    )
    got = run(df, scheme="SANSCOG", collision_rule="earliest").counters.first().asDict()
    assert got == {
        "undated": 0,
        "unassigned": 0,
        "superseded": 1,
        "off_schedule": 2,
        "collisions": 1,
        "collision_participants": 1,
    }


@pytest.mark.parametrize(
    "config, message",
    [
        ({"scheme": "weekly"}, "No schedule is called"),
        ({"scheme": "custom"}, "has to be defined"),
        ({"scheme": "custom", "custom_windows": {"windows": []}}, "empty"),
        ({"scheme": "custom", "custom_windows": {"windows": [[1, 2, 3]]}}, "pair of numbers"),
        ({"scheme": "custom", "custom_windows": {"windows": [[3, 1]]}}, "lies above"),
        ({"scheme": "custom", "custom_windows": {"t1_max": 1}}, "lacks"),
        ({"participant_column": "Nobody"}, "not found"),
        ({"date_column": "Never"}, "not found"),
        ({"cohort_column": "Nowhere"}, "not found"),
    ],
)
def test_bad_configuration_is_named(spark, config, message):
    with pytest.raises(ValueError, match=message):
        run(p1(spark, "2020-01-01"), **config)


def test_rows_that_cannot_be_processed_raise(spark):
    with pytest.raises(ValueError, match="missing or unparseable"):
        run(p1(spark, None, "x"))
    with pytest.raises(ValueError, match="No rows are left"):
        run(visits(spark, []))
    with pytest.raises(ValueError, match="no value in 'Barcode'"):
        run(visits(spark, [(None, "2020-01-01")]))


def random_visits(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        p = "hot" if rng.random() < 0.5 else f"P{rng.randrange(12)}"
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(2500))
        rows.append((p, day.isoformat(), rng.randrange(5)))
    rows += [("hot", "2020-03-01", 1)] * 120  # exact copies
    return rows


@pytest.mark.parametrize(
    "config",
    [
        {},
        {"drop_unassigned": False},
        {"collision_rule": "closest", "drop_unassigned": False, "scheme": "SANSCOG"},
        {"promote_late_baseline": True, "promote_window_fraction": 0.01, "drop_unassigned": False},
        {"promote_late_baseline": True, "scheme": "custom", "custom_windows": {"windows": [[0, 0.9], [30, 40]]}},
    ],
)
def test_hot_participants_give_the_same_answer(spark, config):
    df = visits(spark, random_visits(3), "Barcode string, AppointmentDate string, arm int")
    plain = run(df, **config)
    split = run(df.repartition(7), hot_rows=60, **config)
    for name in ("timepoints", "duplicates"):
        a, b = getattr(plain, name), getattr(split, name).select(getattr(plain, name).columns)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name
    assert plain.counters.first() == split.counters.first()


def test_long_duplicate_lists_stay_in_one_row(spark):
    days = [f"2020-01-{d:02d}" for d in range(1, 29)]
    out = run(p1(spark, *days))
    (row,) = out.duplicates.collect()
    assert row.n_visits == 28 and row.candidate_dates == ", ".join(days)
    listed = out.candidates.orderBy("position").collect()
    assert [(r.position, r.candidate_date) for r in listed] == list(enumerate(days, start=1))
