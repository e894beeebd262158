"""Named queries: every operator applied to whole driver tables.

The tables play clinical roles: orders are visits of customers, events are measurements of users,
line items are measurements taken at an order.
"""

from __future__ import annotations

from functools import reduce

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions.exprs import round_even
from cohortflow.operators.carry import asof_join
from cohortflow.operators.cluster import cluster_patients, instrument_scores, patient_features, range_scores
from cohortflow.operators.corr import correlation_report, top_correlations
from cohortflow.operators.locf import LocfResult, locf_fill
from cohortflow.operators.outlier import removal_report, remove_outliers
from cohortflow.operators.prep import encoding_map, label_encode, scale
from cohortflow.operators.relational import (
    one_value_per_key,
    pivot_fields,
    pivot_values,
    repeated_keys,
    union_widen,
)
from cohortflow.operators.timepoint import TimepointResult, assign_timepoints
from cohortflow.operators.wide import coerce_numeric, export_notes, numeric_fields, wide_stacked, wide_tables
from cohortflow.plans import sql_texts
from cohortflow.plans.sql_step import sql_transform
from cohortflow.session import shared_folder, stage
from cohortflow.sources import catalog, io

Query = Callable[[SparkSession, str], DataFrame]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return io.read_table(spark, f"{sf_dir}/{name}.parquet")


# Timepoints: customers are participants, orders are visits.


def _visits(spark: SparkSession, sf_dir: str, **config) -> TimepointResult:
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return assign_timepoints(
        orders,
        participant_column="o_custkey",
        date_column="o_orderdate",
        tiebreak_columns=["o_orderkey"],
        **config,
    )


def timepoint_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _visits(spark, sf_dir).timepoints


def timepoint_biennial_keep_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _visits(
        spark, sf_dir, scheme="SANSCOG", collision_rule="earliest", drop_unassigned=False, tolerance_years=0.5
    ).timepoints


def timepoint_text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as text, some of them no dates, and a cohort written with blanks around it."""
    day = F.when(F.col("o_orderpriority") == "1-URGENT", "not known").otherwise(F.date_format("o_orderdate", "dd.MM.yyyy"))
    orders = load(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderkey",
        day.alias("o_orderdate"),
        "o_totalprice",
        F.concat(F.lit("  "), F.col("o_orderstatus"), F.lit(" ")).alias("project"),
    )
    return assign_timepoints(
        orders,
        participant_column="o_custkey",
        date_column="o_orderdate",
        date_format="dd.MM.yyyy",
        cohort_column="project",
        cohort_value=" O ",
        tiebreak_columns=["o_orderkey"],
    ).timepoints


DAY_WINDOWS = [[0, 30], [60, 200], [201, 400], [500, 900], [901, 2500]]


def timepoint_explicit_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _visits(
        spark,
        sf_dir,
        scheme="custom",
        custom_windows={"windows": DAY_WINDOWS},
        days_per_year=1,
        collision_rule="closest",
        tolerance_years=60,
    ).timepoints


def timepoint_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _visits(
        spark, sf_dir, scheme="SANSCOG", promote_late_baseline=True, promote_window_fraction=0.5
    ).timepoints


def timepoint_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _visits(spark, sf_dir).duplicates


def timepoint_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _visits(spark, sf_dir, scheme="SANSCOG").counters


# Carry-forward: users are participants, their events in id order are the visits.


def _event_fill(spark: SparkSession, sf_dir: str, **config) -> LocfResult:
    events = load(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        F.when(F.col("event_type") != "error", F.col("ts")).alias("attended_at"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase_value"),
        "value",
    )
    return locf_fill(
        events,
        {
            "value": {"ranges": [[1, 40], [60, 300]], "exclude_ranges": [[10, 12]]},
            "purchase_value": [[5, 200]],
        },
        participant_column="user_id",
        order_column="event_id",
        attendance_column="attended_at",
        emit_full_grid=False,
        **config,
    )


def locf_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_fill(spark, sf_dir).filled


def locf_max_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_fill(spark, sf_dir, max_carry=2).filled


def locf_text_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as text with blanks around them, those of clicks no numbers; the settings as JSON text."""
    text = F.when(F.col("event_type") == "click", F.concat(F.lit("~"), F.col("value").cast("string")))
    events = load(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        F.when(F.col("event_type") != "error", F.col("ts")).alias("attended_at"),
        text.otherwise(F.concat(F.lit(" "), F.col("value").cast("string"), F.lit("  "))).alias("value"),
    )
    return locf_fill(
        events,
        '{"value": {"ranges": [[1, 40], [60, 300]], "exclude_ranges": [[10, 12]]}}',
        participant_column="user_id",
        order_column="event_id",
        attendance_column="attended_at",
        emit_full_grid=False,
    ).filled


def locf_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_fill(spark, sf_dir, max_carry=2).fill_report


def locf_full_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timepoints first, then every customer padded to 1..max and filled."""
    visits = _visits(spark, sf_dir).timepoints.select(
        "o_custkey", "timepoint_index", "timepoint", F.col("o_totalprice").alias("price")
    )
    visits = stage(visits, "visits")  # the fill reads its input several times
    return locf_fill(
        visits, {"price": [[1000, 250000]]}, participant_column="o_custkey", tiebreak_columns=["price"]
    ).filled


def asof_last_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each order the customer's latest order of high priority up to that day."""
    orders = load(spark, sf_dir, "orders")
    urgent = (
        orders.filter(F.col("o_orderpriority") == "1-URGENT")
        .groupBy("o_custkey", F.col("o_orderdate").alias("urgent_date"))
        .agg(F.max("o_totalprice").alias("urgent_price"))
    )
    return asof_join(
        orders.select("o_orderkey", "o_custkey", "o_orderdate"),
        urgent,
        ["o_custkey"],
        "o_orderdate",
        "urgent_date",
    )


# Scaling, encoding, outliers, correlation.

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _line_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)


def _scaled(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    scaled = scale(_line_measures(spark, sf_dir), method, MEASURES)
    return scaled.withColumns({c: round_even(F.col(c), 6) for c in MEASURES})


def scale_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, "standard")


def scale_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, "minmax")


def _encodable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rich = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment")
    return load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", rich)


def label_encode_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_encode(_encodable(spark, sf_dir), "segment, c_name, c_nationkey")


def encoding_map_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_map(_encodable(spark, sf_dir), "segment, c_nationkey, c_name")


def label_encode_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of doubles follow their decimal text."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return label_encode(orders, "o_totalprice", keep_original=False)


def outlier_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_outliers(_line_measures(spark, sf_dir), "iqr", MEASURES, 0.4)


def outlier_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_outliers(_line_measures(spark, sf_dir), "zscore", MEASURES, 1.6)


def outlier_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    report = removal_report(events, remove_outliers(events, "iqr", "value"))
    return report.withColumn("percent_removed", round_even(F.col("percent_removed"), 6))


def outlier_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = io.spread_few_files(_line_measures(spark, sf_dir))  # scoring is heavy per row
    return remove_outliers(lines, "isolation_forest", MEASURES)


def outlier_forest_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after, and how many of the rows planted far outside are left."""
    lines = _line_measures(spark, sf_dir)
    far = [F.when(F.col("l_orderkey") % 997 == 0, F.col(c) * 1000 + 1e6).otherwise(F.col(c).cast("double")).alias(c) for c in MEASURES]
    planted = lines.select("l_orderkey", *far)
    kept = remove_outliers(planted, "isolation_forest", MEASURES, 0.1)
    return kept.agg(
        F.count(F.when(F.col("l_orderkey") % 997 == 0, 1)).alias("planted_left"),
        (F.count(F.lit(1)) >= 0.85 * F.lit(planted.count())).alias("most_stay"),
    )


def granted_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a granted table delivers per row limit asked for, and how many of them the table holds."""
    orders = load(spark, sf_dir, "orders")
    orders.createOrReplaceTempView("limited_orders")
    keys = orders.select("o_orderkey", F.lit(1).alias("held"))
    parts = []
    for asked in (None, "", " 50 ", 0, 7):
        got = io.granted_table(spark, "limited_orders", asked).join(keys, "o_orderkey", "left")
        counted = got.agg(F.count(F.lit(1)).alias("rows"), F.sum("held").alias("held"))
        parts.append(counted.withColumn("asked", F.lit(repr(asked))))
    return reduce(DataFrame.unionByName, parts)


def corr_pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlation_report(load(spark, sf_dir, "lineitem"))


def corr_pearson_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve columns, two of them with gaps: 66 pairs."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = load(spark, sf_dir, "lineitem").select(
        "*",
        net.alias("net"),
        (net * (1 + F.col("l_tax"))).alias("charge"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).alias("returned"),
        F.when(F.col("l_linestatus") == "F", net).alias("billed"),
    )
    return correlation_report(lines)


def corr_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_correlations(correlation_report(load(spark, sf_dir, "lineitem")))


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    discounted = F.when(F.col("l_returnflag") != "N", F.col("l_discount")).alias("discount")
    lines = load(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", discounted, "l_linenumber")
    return io.spread_few_files(lines)  # every row becomes one row per column pair


def corr_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlation_report(_gappy(spark, sf_dir), "spearman")


def corr_kendall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlation_report(_gappy(spark, sf_dir).drop("l_extendedprice"), "kendall")


# Clinical export: customer = person, order = visit, line item = measurement, order fields =
# observations, region = cohort.

ORG = "study house"


def clinical_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    nation = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    customer = load(spark, sf_dir, "customer").join(F.broadcast(nation), "c_nationkey")  # 25 nations
    cohort = (F.col("n_regionkey") + 101).cast("int").alias("cohort_id")
    member = customer.select(F.col("c_custkey").alias("o_custkey"), cohort)
    orders = load(spark, sf_dir, "orders").join(member, "o_custkey")
    keyed = orders.select("cohort_id", "o_custkey", F.col("o_orderkey").alias("l_orderkey"))
    lines = load(spark, sf_dir, "lineitem").join(keyed, "l_orderkey")
    concept = F.col("l_linenumber").cast("bigint")
    observed = F.explode(
        F.array(
            F.struct(F.lit(101).cast("bigint").alias("c"), F.col("o_orderpriority").alias("v")),
            F.struct(F.lit(102).cast("bigint").alias("c"), F.substring("o_orderpriority", 1, 1).alias("v")),
            F.struct(F.lit(1).cast("bigint").alias("c"), F.lit("7").alias("v")),
        )
    )
    lines_seen = load(spark, sf_dir, "lineitem").select(concept.alias("n")).distinct()
    regions = load(spark, sf_dir, "region")
    numbered = lines_seen.select(
        F.col("n").alias("concept_id"),
        F.concat(F.lit("item_"), F.col("n").cast("string")).alias("source_field_name"),
        F.concat(F.lit("Line item "), F.col("n").cast("string")).alias("source_field_description"),
        F.when(F.col("n") <= 3, "Items").when(F.col("n") <= 5, "").alias("dataset"),
    )
    named = regions.select(
        F.explode(
            F.array(
                F.struct(F.lit(101).cast("bigint").alias("concept_id"), F.lit("priority").alias("source_field_name")),
                F.struct(F.lit(102).cast("bigint").alias("concept_id"), F.lit("").alias("source_field_name")),
            )
        ).alias("c")
    ).select("c.*", F.lit("item_1").alias("source_field_description"), F.lit("Orders").alias("dataset"))
    concepts = numbered.unionByName(named.distinct())
    cohorts = [F.lit(r[0] + 101).cast("int") for r in regions.select("r_regionkey").collect()]
    return {
        "person": customer.select(
            cohort,
            F.col("c_custkey").alias("person_id"),
            F.col("c_name").alias("person_source_value"),
            F.when(F.col("c_mktsegment") == "BUILDING", 8507)
            .when(F.col("c_mktsegment") == "MACHINERY", 8532)
            .otherwise(0)
            .alias("gender_concept_id"),
            (F.lit(1930) + F.col("c_nationkey")).cast("int").alias("year_of_birth"),
            F.when(F.col("c_acctbal") > 2000, F.least(F.col("c_nationkey") + 1, F.lit(12))).alias("month_of_birth"),
            F.when(F.col("c_acctbal") > 4000, 31).alias("day_of_birth"),
        ),
        "cmp_participants": customer.filter("c_acctbal > 0").select(
            cohort, F.col("c_name").alias("barcode"), F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("subject_id")
        ),
        "visit_occurrence": orders.select(
            "cohort_id",
            F.col("o_orderkey").alias("visit_occurrence_id"),
            F.col("o_custkey").alias("person_id"),
            F.concat(F.lit("V"), F.col("o_orderstatus")).alias("visit_source_value"),
            F.col("o_orderdate").cast("date").alias("visit_start_date"),
        ),
        "measurement": lines.select(
            "cohort_id",
            F.col("o_custkey").alias("person_id"),
            F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("visit_occurrence_id"),
            concept.alias("measurement_source_concept_id"),
            F.when(F.col("l_tax") > 0, F.col("l_quantity")).alias("value_as_number"),
        ),
        "observation": orders.select(
            "cohort_id",
            F.col("o_custkey").alias("person_id"),
            F.col("o_orderkey").alias("visit_occurrence_id"),
            observed.alias("_o"),
        ).select(
            "cohort_id",
            "person_id",
            "visit_occurrence_id",
            F.col("_o.c").alias("observation_source_concept_id"),
            F.col("_o.v").alias("value_as_string"),
        ),
        "local_concept": concepts.select("*", F.explode(F.array(*cohorts)).alias("cohort")),
        "cohort_mappings": regions.select(
            (F.col("r_regionkey") + 101).cast("int").alias("cohort_id"),
            F.col("r_name").alias("cohort_name"),
            F.lit(ORG).alias("org_name"),
            (F.col("r_regionkey") != 4).alias("is_active"),
        ),
    }


def wide_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_tables(clinical_tables(spark, sf_dir), [101, 102, 103, 104, 105], ORG, datasets=["Items"])["Items"]


def wide_one_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_tables(
        clinical_tables(spark, sf_dir),
        [101],
        ORG,
        cohort="102",
        source_field="source_field_description",
        datasets=["Unknown"],
    )["Unknown"]


def wide_all_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_stacked(clinical_tables(spark, sf_dir), [101, 102, 103, 104, 105], ORG)


def _event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        "event_type",
        F.get_json_object("props", "$.k").alias("k"),
        "props",
        F.when(F.col("value") > 5, F.get_json_object("props", "$.k")).otherwise("").alias("blank"),
        F.when(F.col("event_type") == "click", F.col("event_id").cast("string")).alias("click"),
        F.when(F.col("value") < 0, F.col("props")).alias("empty"),
    )


def numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which text field of which event type spells only numbers."""
    fields = ["k", "props", "blank", "click", "empty"]
    long = _event_texts(spark, sf_dir).unpivot("event_type", fields, "field_name", "field_value")
    return numeric_fields(long, ["event_type", "field_name"])


def coerced_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce_numeric(_event_texts(spark, sf_dir), ["event_type"])


# Relational pieces.


def diagonal_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("place"), "c_mktsegment"
    )
    nation = load(spark, sf_dir, "nation")
    suppliers = (
        load(spark, sf_dir, "supplier")
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
        .select(F.col("s_name").alias("name"), F.col("n_name").alias("place"), F.col("s_suppkey").alias("key"))
    )
    parts = load(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_size").alias("key"))
    return union_widen([customers, suppliers, parts])


def first_value_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_linenumber", "l_returnflag", F.when(F.col("l_tax") > 0.02, F.col("l_shipdate")).alias("shipped")
    )
    return one_value_per_key(lines, ["l_suppkey", "l_linenumber"], "shipped", "l_returnflag")


def pivot_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    kinds = pivot_fields(events, "event_type")
    wide = pivot_values(events, ["user_id"], "event_type", "value", kinds, "avg")
    return wide.select("user_id", *[round_even(F.col(k), 6).alias(k) for k in kinds])


def repeated_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_keys(load(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])


# Governed access: each order is an access request, each part is a view document.


def request_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    relation = F.concat(F.lit("req_"), key, F.lit("."))

    def table(name: str) -> Column:
        return F.struct(F.lit(name).alias("name"), F.concat(relation, F.lit(name)).alias("relation"))

    large = F.col("o_totalprice") > 200000
    return load(spark, sf_dir, "orders").select(
        F.concat(F.lit("r-"), key).alias("id"),
        F.concat(F.lit("req_"), key).alias("schema"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("dataset"),
        F.lit(None).cast("string").alias("use_case"),
        F.when(F.col("o_orderstatus") == "F", " Approved ")
        .when(F.col("o_orderstatus") == "O", "approved")
        .otherwise("pending")
        .alias("status"),
        F.when(large, F.array(F.lit(101), F.year("o_orderdate"))).alias("cohorts"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_at"),
        F.when(
            F.col("o_orderstatus") != "P", F.array(table("person"), F.when(large, table("measurement")))
        ).alias("tables"),
        F.array(
            F.when(
                large,
                F.struct(
                    F.col("o_custkey").alias("concept_id"),
                    F.lit(101).alias("cohort"),
                    F.col("o_orderpriority").alias("subgroup"),
                    F.lit(None).cast("string").alias("source_field_name"),
                    F.lit("total").alias("source_field_description"),
                ),
            )
        ).alias("concepts"),
    )


def view_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    def column(name: str, kind: str, readable) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            F.lit(kind).alias("type"),
            F.col("p_name").alias("description"),
            readable.alias("accessible"),
        )

    return load(spark, sf_dir, "part").select(
        F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("name"),
        F.col("p_name").alias("description"),
        F.col("p_type").alias("category"),
        F.array(
            column("size", "integer", F.col("p_size") > 10),
            column("price", "string", F.when(F.col("p_size") > 30, F.lit(True))),
        ).alias("columns"),
    )


def export_left_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Granted cohorts that are not active, as text, and persons whose birth date does not exist."""
    notes = export_notes(clinical_tables(spark, sf_dir), [101, 102, 103, 104, 105], ORG)
    return notes.withColumn("skipped_cohorts", F.concat_ws(",", F.col("skipped_cohorts").cast("array<string>")))


def catalog_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.requests_frame(request_documents(spark, sf_dir))


def catalog_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.requests_summary(catalog.approved(request_documents(spark, sf_dir)))


def catalog_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.concepts_frame(request_documents(spark, sf_dir))


def catalog_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.views_frame(view_documents(spark, sf_dir))


def governed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of each region's cohort, only of nations granted for that cohort."""
    nation = load(spark, sf_dir, "nation")
    customer = load(spark, sf_dir, "customer").join(
        F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")  # 25 nations
    )
    regions = [r[0] for r in load(spark, sf_dir, "region").select("r_regionkey").collect()]
    cohorts = {
        int(k): customer.filter(F.col("n_regionkey") == k).select("c_custkey", "c_name", "c_nationkey") for k in regions
    }
    grants = (
        load(spark, sf_dir, "supplier")
        .filter("s_acctbal > 5000")
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_regionkey").alias("cohort"), F.col("s_nationkey").alias("concept_id"))
    )
    return catalog.governed_relation(cohorts, grants, "c_nationkey")


def granted_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]
    return catalog.row_counts({n: load(spark, sf_dir, n) for n in names})


def granted_view_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    orders.createOrReplaceTempView("visits_granted")
    columns = [(f.name, f.dataType.simpleString(), "", f.name != "o_totalprice") for f in orders.schema.fields]
    views = spark.createDataFrame([("visits_granted", "", "", columns)], catalog.VIEW_SCHEMA)
    return io.granted_view(spark, views, "visits_granted")


def granted_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "supplier").createOrReplaceTempView("suppliers_granted")
    return io.granted_table(spark, "suppliers_granted", row_limit=0)


# Sources and sinks.


def parameter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "orders").createOrReplaceTempView("visits_queried")
    text = """
        SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM visits_queried
        WHERE o_orderstatus = :status AND o_totalprice >= :low GROUP BY o_custkey
    """
    return io.run_query(spark, text, {"status": "O", "low": 50000.0})


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/out-{uuid.uuid4().hex}"


def write_read_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write parts as parquet, csv and json at once, read the json copy back."""
    part, path = load(spark, sf_dir, "part"), _scratch(spark)
    files = [{"path": f"{path}/{fmt}", "format": fmt} for fmt in ("parquet", "csv", "json")]
    io.write_outputs(part, files)
    return io.read_format(spark, f"{path}/json", "json", part.schema).select(*part.columns)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, with quotes, commas and line breaks, written as CSV and read back."""
    docs, path = load(spark, sf_dir, "documents"), _scratch(spark)
    io.write_outputs(docs, [{"path": f"{path}/csv", "format": "csv"}, {"path": f"{path}/json", "format": "json"}])
    return io.read_format(spark, f"{path}/csv", "csv", docs.schema)


def csv_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, path = load(spark, sf_dir, "conversations"), _scratch(spark)
    io.write_output(turns, f"{path}/turns.csv", "csv")
    return io.read_format(spark, f"{path}/turns.csv", "csv", turns.schema)


def export_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export two tables as CSV and read both back."""
    tables = {n: load(spark, sf_dir, n) for n in ("customer", "supplier")}
    written = io.export_tables(tables, _scratch(spark), file_format="csv")
    customer, supplier = (io.read_table(spark, path) for path in written)
    return customer.select("c_name", "c_acctbal").union(supplier.select("s_name", "s_acctbal")).toDF("name", "acctbal")


# Clustering: users are persons, events are their measurements.


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the event types stand for instruments; errors have no reference limits
    names = {"click": "ham_d_sleep", "view": "ham_d_mood", "purchase": "psqi_total", "signup": "psqi_cumulative"}
    name = F.lit("cdr_sum")
    for kind, measure in names.items():
        name = F.when(F.col("event_type") == kind, measure).otherwise(name)
    limited = F.col("event_type") != "error"
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("person_id"),
        F.col("event_id").alias("measurement_id"),
        name.alias("measurement_source_value"),
        F.col("value").alias("value_as_number"),
        F.when(limited, F.when(F.col("event_type") == "view", 0.0).otherwise(4.0)).alias("range_low"),
        F.when(limited, 80.0).alias("range_high"),
    )


def range_deviation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_scores(measurements(spark, sf_dir))


def instrument_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instrument_scores(measurements(spark, sf_dir))


def cluster_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_patients(measurements(spark, sf_dir), 3, "kmeans", "range").patients


def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_patients(measurements(spark, sf_dir), 3, "kmeans", "range").sizes


def cluster_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean-imputed, standardised features of every person, one row per person and measure."""
    features, measures = patient_features(measurements(spark, sf_dir))
    rows = features.select("person_id", F.posexplode("z").alias("i", "z"))
    name = F.element_at(F.array(*[F.lit(m) for m in measures]), F.col("i") + 1)
    return rows.select("person_id", name.alias("measure"), round_even(F.col("z"), 5).alias("z"))


def cluster_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a clustering says of each person beside the cluster itself."""
    patients = cluster_patients(measurements(spark, sf_dir), 3, "kmeans", "instrument").patients
    return patients.select("person_id", "ham_d_total", "psqi_total", "cdr_score", "num_measurements")


def cluster_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_patients(measurements(spark, sf_dir), 4, "kmeans", "instrument").patients


def cluster_ward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_patients(measurements(spark, sf_dir), 3, "agglomerative").patients


def cluster_spectral(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_patients(measurements(spark, sf_dir), 3, "spectral").patients


# SQL over named inputs.


def _sql(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables, text, _ = sql_texts.TEXTS[name]
        return sql_transform(spark, text, {t: load(spark, sf_dir, t) for t in tables}, name=name).result

    return query


def sql_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL step with outputs: run, write, read what was written."""
    tables, text, _ = sql_texts.TEXTS["sql_join_aggregate"]
    path = _scratch(spark)
    done = sql_transform(
        spark,
        text,
        {t: load(spark, sf_dir, t) for t in tables},
        [{"path": f"{path}/a", "format": "parquet"}, {"path": f"{path}/b", "format": "parquet"}],
        "sql written",
    )
    return spark.read.parquet(f"{path}/b").withColumn("row_count", F.lit(done.row_count).cast("bigint"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        timepoint_annual,
        timepoint_biennial_keep_all,
        timepoint_explicit_days,
        timepoint_promotion,
        timepoint_duplicates,
        timepoint_counters,
        locf_filled,
        locf_max_carry,
        locf_text_values,
        timepoint_text_dates,
        granted_limits,
        locf_report,
        locf_full_grid,
        asof_last_order,
        scale_standard,
        scale_minmax,
        label_encode_customers,
        label_encode_prices,
        encoding_map_customers,
        outlier_iqr,
        outlier_zscore,
        outlier_report,
        outlier_isolation_forest,
        outlier_forest_facts,
        corr_pearson,
        corr_pearson_wide,
        corr_top,
        corr_spearman,
        corr_kendall,
        wide_items,
        wide_one_cohort,
        wide_all_stacked,
        export_left_out,
        numeric_coercion,
        coerced_columns,
        diagonal_union,
        first_value_per_key,
        pivot_means,
        repeated_visits,
        catalog_requests,
        catalog_summary,
        catalog_concepts,
        catalog_views,
        governed_customers,
        granted_row_counts,
        granted_view_columns,
        granted_table_rows,
        parameter_query,
        write_read_formats,
        csv_roundtrip,
        csv_conversations,
        export_read,
        range_deviation_scores,
        instrument_totals,
        cluster_kmeans,
        cluster_sizes,
        cluster_features,
        cluster_scores,
        cluster_severity,
        cluster_ward,
        cluster_spectral,
        sql_written,
    )
}
QUERIES |= {name: _sql(name) for name in sql_texts.TEXTS}
