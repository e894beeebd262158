"""The same results as DuckDB SQL over the whole driver tables, for checking."""

from __future__ import annotations

from itertools import combinations

from cohortflow.operators.wide import GENDER_FEMALE, GENDER_MALE
from cohortflow.plans import sql_texts
from cohortflow.plans.queries import DAY_WINDOWS, MEASURES, ORG


def _rounded(expr: str, digits: int) -> str:
    return f"(round_even({expr}, {digits}) + 0.0)"


# Schedules as rows (tp, low, high, centre, ideal).

ANNUAL = """
    SELECT n AS tp, CAST(CASE n WHEN 1 THEN 0 WHEN 2 THEN 0.75 ELSE n - 1 - 0.49 END AS DOUBLE) AS low,
           CAST(CASE n WHEN 1 THEN 0.74 WHEN 2 THEN 1.5 ELSE n - 1 + 0.5 END AS DOUBLE) AS high,
           CAST(CASE n WHEN 2 THEN 1.125 ELSE n - 1 END AS DOUBLE) AS centre, CAST(n - 1 AS DOUBLE) AS ideal
    FROM range(1, 21) AS r(n)"""
BIENNIAL = """
    SELECT n AS tp, CAST(CASE n WHEN 1 THEN 0 WHEN 2 THEN 1.5 ELSE 2 * (n - 1) - 0.9 END AS DOUBLE) AS low,
           CAST(CASE n WHEN 1 THEN 1.49 WHEN 2 THEN 3 ELSE 2 * (n - 1) + 1 END AS DOUBLE) AS high,
           CAST(CASE n WHEN 2 THEN 2.25 ELSE 2 * (n - 1) END AS DOUBLE) AS centre, CAST(2 * (n - 1) AS DOUBLE) AS ideal
    FROM range(1, 21) AS r(n)"""
DAYS = "\n    UNION ALL ".join(
    f"SELECT {i} AS tp, CAST({a} AS DOUBLE) AS low, CAST({b} AS DOUBLE) AS high,"
    f" {(a + b) / 2} :: DOUBLE AS centre, {(a + b) / 2} :: DOUBLE AS ideal"
    for i, (a, b) in enumerate(DAY_WINDOWS, start=1)
)


TEXT_DATED = """(SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o_orderdate, o_totalprice
    FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '1-URGENT')"""


def _visits(
    schedule: str, score: str, per_year: str = "365.25", promote: tuple[float, float] | None = None, table: str = "orders"
) -> str:
    """CTEs sched, matched, ranked and flagged (all visits with won and promoted)."""
    promoted = "false"
    if promote:
        low, high = promote
        promoted = f"""tp = 1 AND NOT won AND years BETWEEN {low} :: DOUBLE AND {high} :: DOUBLE AND NOT has_t2
            AND row_number() OVER (PARTITION BY o_custkey ORDER BY
                coalesce(tp = 1 AND NOT won AND years BETWEEN {low} :: DOUBLE AND {high} :: DOUBLE, false) DESC,
                years DESC, o_orderdate, o_orderkey) = 1"""
    return f"""
    WITH sched AS ({schedule}),
    timed AS (
        SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
               {_rounded(f'''((epoch_us(o_orderdate) - epoch_us(min(o_orderdate) OVER (PARTITION BY o_custkey)))
                // 86400000000) / {per_year} :: DOUBLE''', 2)} AS years
        FROM {table}),
    steps AS (SELECT years, min(tp) AS tp FROM (SELECT DISTINCT years FROM timed) JOIN sched ON years BETWEEN low AND high
              GROUP BY years),
    matched AS (SELECT timed.*, s.tp, sched.centre, sched.ideal FROM timed LEFT JOIN steps s USING (years)
                LEFT JOIN sched ON sched.tp = s.tp),
    ranked AS (SELECT *, tp IS NOT NULL AND row_number() OVER (PARTITION BY o_custkey, tp ORDER BY
                   CASE WHEN tp = 1 THEN years ELSE {score} END, years, o_orderdate, o_orderkey) = 1 AS won FROM matched),
    crowded AS (SELECT *, bool_or(coalesce(tp = 2, false)) OVER (PARTITION BY o_custkey) AS has_t2 FROM ranked),
    flagged AS (SELECT *, coalesce({promoted}, false) AS promoted FROM crowded)"""


def _timepoints(ctes: str, tolerance: float, second_ideal: float = 0.0, only_selected: bool = True) -> str:
    return f"""{ctes},
    final AS (SELECT *, CASE WHEN promoted THEN 2 ELSE tp END AS idx,
                     CASE WHEN promoted THEN {second_ideal} :: DOUBLE ELSE ideal END AS due FROM flagged)
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, years AS years_from_baseline,
           'T' || CAST(idx AS VARCHAR) AS timepoint, won OR promoted AS is_selected_visit,
           CAST(idx AS BIGINT) AS timepoint_index, {_rounded('years - due', 2)} AS deviation_years,
           abs({_rounded('years - due', 2)}) <= {tolerance} AS within_tolerance
    FROM final {'WHERE won OR promoted' if only_selected else ''}"""


LATEST = _visits(ANNUAL, "-years")
LATEST_BIENNIAL = _visits(BIENNIAL, "-years")


def _fill(max_carry: int | None, value: str = "value") -> str:
    """CTE filled over events: per column the value, its valid seed and the fill."""

    def column(name: str) -> str:
        carried = f"last_value({name}_seed IGNORE NULLS) OVER w"
        if max_carry is not None:
            since = f"rn - last_value(CASE WHEN {name}_seed IS NOT NULL THEN rn END IGNORE NULLS) OVER w"
            carried = f"CASE WHEN {since} <= {max_carry} THEN {carried} END"
        return f"CASE WHEN attended THEN {carried} END AS {name}_fill"

    return f"""
    WITH given AS (
        SELECT user_id, event_id, event_type <> 'error' AS attended, {value} AS v,
               CASE WHEN event_type <> 'error' THEN ts END AS attended_at,
               CASE WHEN event_type = 'purchase' THEN value END AS p,
               row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
        FROM events),
    seeded AS (
        SELECT *, CASE WHEN (v BETWEEN 1 AND 40 OR v BETWEEN 60 AND 300) AND NOT v BETWEEN 10 AND 12 THEN v END AS v_seed,
               CASE WHEN p BETWEEN 5 AND 200 THEN p END AS p_seed FROM given),
    filled AS (
        SELECT *, {column('v')}, {column('p')} FROM seeded
        WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _filled(max_carry: int | None) -> str:
    return f"""{_fill(max_carry)}
    SELECT user_id, event_id, attended_at, p_fill AS purchase_value, v_fill AS value, false AS is_placeholder FROM filled"""


def _fill_report() -> str:
    def row(column: str, name: str, ranges: str) -> str:
        return f"""SELECT '{column}' AS "column", '{ranges}' AS valid_ranges,
            count(*) FILTER (WHERE attended AND {name} IS NOT NULL) AS values_present,
            count(*) FILTER (WHERE attended AND {name} IS NOT NULL AND {name}_seed IS NULL) AS out_of_range,
            count(*) FILTER (WHERE attended AND {name}_fill IS NOT NULL AND {name}_seed IS NULL) AS values_imputed,
            count(*) FILTER (WHERE attended AND {name}_fill IS NULL) AS still_missing FROM filled"""

    return f"""{_fill(2)} {row('value', 'v', '[[1.0, 40.0], [60.0, 300.0]]')}
    UNION ALL {row('purchase_value', 'p', '[[5.0, 200.0]]')}"""


FULL_GRID = f"""{LATEST},
    visits AS (SELECT o_custkey, tp AS idx, o_totalprice AS price FROM flagged WHERE won),
    grid AS (SELECT o_custkey, n AS idx FROM (SELECT DISTINCT o_custkey FROM visits),
             (SELECT unnest(range(1, (SELECT max(idx) FROM visits) + 1)) AS n)),
    padded AS (SELECT g.o_custkey, g.idx, v.price, v.idx IS NULL AS blank
               FROM grid g LEFT JOIN visits v ON v.o_custkey = g.o_custkey AND v.idx = g.idx)
    SELECT o_custkey, CAST(idx AS BIGINT) AS timepoint_index, 'T' || CAST(idx AS VARCHAR) AS timepoint,
           CASE WHEN NOT blank THEN last_value(CASE WHEN price BETWEEN 1000 AND 250000 THEN price END IGNORE NULLS)
               OVER (PARTITION BY o_custkey ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS price,
           blank AS is_placeholder
    FROM padded"""


def _scaled(start: str, spread: str) -> str:
    columns = ", ".join(
        f"{_rounded(f'(l.{c} - s.{c}_a) / CASE s.{c}_b WHEN 0 THEN 1 ELSE s.{c}_b END', 6)} AS {c}" for c in MEASURES
    )
    facts = ", ".join(f"{start.format(c)} AS {c}_a, {spread.format(c)} AS {c}_b" for c in MEASURES)
    return f"SELECT l_orderkey, l_linenumber, {columns} FROM lineitem l, (SELECT {facts} FROM lineitem) s"


ENCODABLE = """(SELECT c_custkey, c_name, c_nationkey,
    CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS segment FROM customer)"""


def _codes(column: str) -> str:
    return f"""(SELECT t, row_number() OVER (ORDER BY t) - 1 AS label
        FROM (SELECT DISTINCT coalesce(CAST({column} AS VARCHAR), '__missing__') AS t FROM {ENCODABLE}))"""


def _encoded(*columns: str) -> str:
    labels = ", ".join(f"{c}_d.label AS {c}_encoded" for c in columns)
    joins = " ".join(
        f"JOIN {_codes(c)} {c}_d ON {c}_d.t = coalesce(CAST(e.{c} AS VARCHAR), '__missing__')" for c in columns
    )
    return f"SELECT e.*, {labels} FROM {ENCODABLE} e {joins}"


def _inside(facts: str, test: str, columns=MEASURES) -> str:
    fitted = ", ".join(facts.format(c=c) for c in columns)
    tests = " AND ".join(test.format(c=c) for c in columns)
    kept = ", ".join(f"l.{c}" for c in ("l_orderkey", "l_linenumber", *columns))
    return f"SELECT {kept} FROM lineitem l, (SELECT {fitted} FROM lineitem) s WHERE {tests}"


NUMERIC_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]
WIDE_LINES = """(SELECT *, net * (1 + l_tax) AS charge, CASE WHEN l_linestatus = 'F' THEN net END AS billed
    FROM (SELECT *, l_extendedprice * (1 - l_discount) AS net, CASE WHEN l_returnflag = 'R' THEN l_quantity END AS returned
          FROM lineitem))"""
GAPPY = """(SELECT l_quantity, l_extendedprice, CASE WHEN l_returnflag <> 'N' THEN l_discount END AS discount,
    l_linenumber FROM lineitem)"""


def _report(pairs_sql: str) -> str:
    return f"""SELECT column_a, column_b, correlation,
        CASE WHEN abs(correlation) >= 0.7 THEN 'strong' WHEN abs(correlation) >= 0.4 THEN 'moderate' ELSE 'weak' END AS strength,
        CASE WHEN correlation > 0.05 THEN 'positive' WHEN correlation < -0.05 THEN 'negative' ELSE 'none' END AS direction
    FROM ({pairs_sql})"""


def _pearson(columns: list[str], table: str = "lineitem") -> str:
    return _report(
        " UNION ALL ".join(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, {_rounded(f'corr({a}, {b})', 4)} AS correlation FROM {table}"
            for a, b in combinations(columns, 2)
        )
    )


def _spearman(columns: list[str]) -> str:
    def average_rank(c: str) -> str:
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"

    return _report(
        " UNION ALL ".join(
            f"""SELECT '{a}' AS column_a, '{b}' AS column_b, {_rounded('corr(ra, rb)', 4)} AS correlation
            FROM (SELECT {average_rank(a)} AS ra, {average_rank(b)} AS rb FROM {GAPPY}
                  WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""
            for a, b in combinations(columns, 2)
        )
    )


def _kendall(columns: list[str]) -> str:
    """Concordance over all pairs of cells (few cells: the columns are ordinal)."""
    parts = []
    for a, b in combinations(columns, 2):
        cells = f"""(SELECT {a} AS x, {b} AS y, count(*) :: DOUBLE AS n FROM {GAPPY}
            WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL)"""
        ties = "(SELECT sum(t * (t - 1) / 2) FROM (SELECT sum(n) AS t FROM {c} GROUP BY {k}))"
        parts.append(
            f"""SELECT '{a}' AS column_a, '{b}' AS column_b, {_rounded('s / sqrt((n0 - n1) * (n0 - n2))', 4)} AS correlation
            FROM (SELECT (SELECT sum(p.n * q.n * sign(p.x - q.x) * sign(p.y - q.y)) / 2 FROM {cells} p, {cells} q) AS s,
                (SELECT sum(n) * (sum(n) - 1) / 2 FROM {cells}) AS n0,
                {ties.format(c=cells, k='x')} AS n1, {ties.format(c=cells, k='y')} AS n2)"""
        )
    return _report(" UNION ALL ".join(parts))


# The clinical export.


def _long(cohorts: str, described: bool = False) -> str:
    first, second = ("source_field_description", "source_field_name") if described else ("source_field_name", "source_field_description")
    return f"""
    WITH c AS (SELECT customer.*, CAST(n_regionkey + 101 AS INTEGER) AS cohort_id FROM customer JOIN nation ON n_nationkey = c_nationkey),
    o AS (SELECT orders.*, c.cohort_id FROM orders JOIN c ON c_custkey = o_custkey),
    names AS (
        SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS concept_id, 'item_' || l_linenumber AS source_field_name,
               'Line item ' || l_linenumber AS source_field_description,
               CASE WHEN l_linenumber <= 3 THEN 'Items' WHEN l_linenumber <= 5 THEN '' END AS dataset FROM lineitem
        UNION ALL SELECT 101, 'priority', 'item_1', 'Orders' UNION ALL SELECT 102, '', 'item_1', 'Orders'),
    concepts AS (SELECT concept_id, coalesce(nullif({first}, ''), {second}) AS field_name,
                        coalesce(nullif(dataset, ''), 'Unknown') AS dataset FROM names),
    facts AS (
        SELECT o.cohort_id, o_custkey AS person_id, o_orderkey AS visit, CAST(l_linenumber AS BIGINT) AS concept_id, 0 AS source,
               CAST(CASE WHEN l_tax > 0 THEN l_quantity END AS VARCHAR) AS v
        FROM lineitem JOIN o ON o_orderkey = l_orderkey WHERE l_returnflag <> 'R'
        UNION ALL SELECT cohort_id, o_custkey, o_orderkey, 101, 1, o_orderpriority FROM o
        UNION ALL SELECT cohort_id, o_custkey, o_orderkey, 102, 1, substring(o_orderpriority, 1, 1) FROM o
        UNION ALL SELECT cohort_id, o_custkey, o_orderkey, 1, 1, '7' FROM o),
    people AS (
        SELECT cohort_id, c_custkey AS person_id, c_name AS "Barcode", 'S' || c_custkey AS "Subject_ID",
               CASE c_mktsegment WHEN 'BUILDING' THEN {GENDER_MALE} WHEN 'MACHINERY' THEN {GENDER_FEMALE} ELSE 0 END AS g,
               try_cast((1930 + c_nationkey) || '-' || CASE WHEN c_acctbal > 2000 THEN least(c_nationkey + 1, 12) ELSE 1 END
                   || '-' || CASE WHEN c_acctbal > 4000 THEN 31 ELSE 1 END AS DATE) AS born
        FROM c WHERE c_acctbal > 0),
    long AS (
        SELECT CASE f.cohort_id WHEN 101 THEN 0 WHEN 102 THEN 1 WHEN 103 THEN 2 WHEN 104 THEN 3 END AS region, f.cohort_id,
               "Barcode", "Subject_ID",
               CASE g WHEN {GENDER_MALE} THEN 'Male' WHEN {GENDER_FEMALE} THEN 'Female' ELSE 'Unknown' END AS "Gender",
               CAST(date_part('year', age(CAST(o.o_orderdate AS DATE), born)) AS BIGINT) AS "Age_at_Visit",
               'V' || o.o_orderstatus AS "Visit", CAST(o.o_orderdate AS DATE) AS "Assessment_Date",
               dataset, field_name, source, v
        FROM facts f JOIN concepts USING (concept_id) JOIN o ON o.o_orderkey = f.visit AND o.cohort_id = f.cohort_id
        JOIN people p ON p.person_id = f.person_id AND p.cohort_id = f.cohort_id WHERE f.cohort_id IN ({cohorts})),
    identity AS (SELECT long.*, r_name AS "Cohort" FROM long JOIN region ON r_regionkey = region),
    best AS (SELECT "Cohort", "Barcode", "Subject_ID", "Gender", "Age_at_Visit", "Visit", "Assessment_Date", dataset, field_name,
                    coalesce(min(v) FILTER (WHERE source = 0), min(v) FILTER (WHERE source = 1)) AS v
             FROM identity GROUP BY ALL)"""


IDENTITY = '"Barcode", "Subject_ID", "Gender", "Age_at_Visit", "Visit", "Assessment_Date"'


def _cells(names: list[str], number: set[str]) -> str:
    return ", ".join(
        f"CAST(max(v) FILTER (WHERE field_name = '{n}') AS {'DOUBLE' if n in number else 'VARCHAR'}) AS \"{n}\"" for n in names
    )


ITEMS = ["item_1", "item_2", "item_3"]
ALL_FIELDS = [*(f"item_{i}" for i in range(1, 8)), "priority"]

EVENT_TEXTS = """(SELECT event_type, json_extract_string(props, '$.k') AS k, props,
    CASE WHEN value > 5 THEN json_extract_string(props, '$.k') ELSE '' END AS blank,
    CASE WHEN event_type = 'click' THEN CAST(event_id AS VARCHAR) END AS click,
    CASE WHEN value < 0 THEN props END AS empty FROM events)"""
NUMBER = r"'[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)'"

REQUEST = """(SELECT 'r-' || o_orderkey AS request_id,
    coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END, '') AS dataset, '' AS use_case,
    CASE o_orderstatus WHEN 'F' THEN ' Approved ' WHEN 'O' THEN 'approved' ELSE 'pending' END AS status,
    CASE WHEN o_totalprice > 200000 THEN '101, ' || year(o_orderdate) ELSE '' END AS cohorts,
    o_orderkey, o_orderstatus, o_custkey, o_orderpriority, o_totalprice > 200000 AS large FROM orders)"""

MEASUREMENTS = """(SELECT user_id AS person_id, event_id AS measurement_id, value AS v, event_type,
    CASE event_type WHEN 'click' THEN 'ham_d_sleep' WHEN 'view' THEN 'ham_d_mood' WHEN 'purchase' THEN 'psqi_total'
        WHEN 'signup' THEN 'psqi_cumulative' ELSE 'cdr_sum' END AS name,
    CASE WHEN event_type <> 'error' THEN CASE WHEN event_type = 'view' THEN 0.0 ELSE 4.0 END :: DOUBLE END AS low,
    CASE WHEN event_type <> 'error' THEN 80.0 :: DOUBLE END AS high FROM events)"""

COUNTED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]

JOIN_AGGREGATE = sql_texts.TEXTS["sql_join_aggregate"][1]

ORACLES: dict[str, str] = {
    "timepoint_annual": _timepoints(LATEST, 0.25),
    "timepoint_text_dates": f"SELECT *, '  O ' AS project FROM ({_timepoints(_visits(ANNUAL, '-years', table=TEXT_DATED), 0.25)})",
    "timepoint_biennial_keep_all": _timepoints(_visits(BIENNIAL, "years"), 0.5, only_selected=False),
    "timepoint_explicit_days": _timepoints(_visits(DAYS, "abs(years - centre)", "1"), 60),
    "timepoint_promotion": _timepoints(_visits(BIENNIAL, "-years", promote=(1.49 * 0.5, 1.49)), 0.25, 2.0),
    "timepoint_duplicates": f"""{LATEST}
        SELECT o_custkey, 'T' || CAST(tp AS VARCHAR) AS timepoint, CAST(tp AS BIGINT) AS timepoint_index, count(*) AS n_visits,
               string_agg(printf('%.2f', years), ', ' ORDER BY o_orderdate, o_orderkey) AS candidate_years,
               string_agg(strftime(o_orderdate, '%Y-%m-%d'), ', ' ORDER BY o_orderdate, o_orderkey) AS candidate_dates,
               max(years) FILTER (WHERE won) AS kept_years
        FROM flagged WHERE tp IS NOT NULL GROUP BY o_custkey, tp HAVING count(*) > 1""",
    "timepoint_counters": f"""{LATEST_BIENNIAL},
        groups AS (SELECT o_custkey, tp FROM flagged WHERE tp IS NOT NULL GROUP BY o_custkey, tp HAVING count(*) > 1)
        SELECT CAST(0 AS BIGINT) AS undated, count(*) FILTER (WHERE tp IS NULL) AS unassigned,
               count(*) FILTER (WHERE tp IS NOT NULL AND NOT won) AS superseded,
               count(*) FILTER (WHERE won AND abs({_rounded('years - ideal', 2)}) > 0.25) AS off_schedule,
               (SELECT count(*) FROM groups) AS collisions,
               (SELECT count(DISTINCT o_custkey) FROM groups) AS collision_participants
        FROM flagged""",
    "locf_filled": _filled(None),
    "locf_max_carry": _filled(2),
    "locf_text_values": f"""{_fill(None, "CASE WHEN event_type <> 'click' THEN value END")}
        SELECT user_id, event_id, attended_at, v_fill AS value, false AS is_placeholder FROM filled""",
    "granted_limits": " UNION ALL ".join(
        f"SELECT $${asked!r}$$ AS asked, {rows} AS \"rows\", {rows} AS held FROM orders"
        for asked, rows in ((None, "count(*)"), ("", "count(*)"), (" 50 ", "least(50, count(*))"), (0, "count(*)"), (7, "least(7, count(*))"))
    ),
    "locf_report": _fill_report(),
    "locf_full_grid": FULL_GRID,
    "asof_last_order": """
        SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, u.urgent_date, u.urgent_price
        FROM orders o ASOF LEFT JOIN (SELECT o_custkey, o_orderdate AS urgent_date, max(o_totalprice) AS urgent_price
            FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL) u
        ON o.o_custkey = u.o_custkey AND o.o_orderdate >= u.urgent_date""",
    "scale_standard": _scaled("avg({})", "stddev_pop({0})"),
    "scale_minmax": _scaled("min({})", "max({0}) - min({0})"),
    "label_encode_customers": _encoded("segment", "c_name", "c_nationkey"),
    "encoding_map_customers": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", t AS value, label FROM {_codes(c)}" for c in ("segment", "c_nationkey", "c_name")
    ),
    "outlier_iqr": _inside(
        "quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3",
        "l.{c} BETWEEN {c}_1 - 0.4 * ({c}_3 - {c}_1) AND {c}_3 + 0.4 * ({c}_3 - {c}_1)",
    ),
    "outlier_zscore": _inside(
        "avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s", "abs((l.{c} - {c}_m) / {c}_s) <= 1.6"
    ),
    "outlier_report": f"""
        SELECT n AS rows_before, kept AS rows_after, n - kept AS rows_removed, {_rounded('(n - kept) * 100.0 :: DOUBLE / n', 6)} AS percent_removed
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)) AS kept
              FROM events, (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events))""",
    "corr_pearson": _pearson(NUMERIC_LINE_COLUMNS),
    "corr_pearson_wide": _pearson([*NUMERIC_LINE_COLUMNS, "net", "charge", "returned", "billed"], WIDE_LINES),
    "corr_top": f"""SELECT * FROM ({_pearson(NUMERIC_LINE_COLUMNS)})
        ORDER BY abs(correlation) DESC NULLS LAST, column_a, column_b LIMIT 5""",
    "corr_spearman": _spearman(["l_quantity", "l_extendedprice", "discount", "l_linenumber"]),
    "corr_kendall": _kendall(["l_quantity", "discount", "l_linenumber"]),
    "wide_items": f"""{_long('101, 102, 103, 104')}
        SELECT "Cohort", {IDENTITY}, {_cells(ITEMS, set(ITEMS))} FROM best WHERE dataset = 'Items' GROUP BY "Cohort", {IDENTITY}""",
    "wide_one_cohort": f"""{_long('102', True)}
        SELECT {IDENTITY}, {_cells(names := [f'Line item {i}' for i in range(4, 8)], set(names))}
        FROM best WHERE dataset = 'Unknown' GROUP BY {IDENTITY}""",
    "wide_all_stacked": f"""{_long('101, 102, 103, 104')}
        SELECT dataset, "Cohort", {IDENTITY}, {_cells(ALL_FIELDS, set(ALL_FIELDS) - {'priority'})}
        FROM best GROUP BY dataset, "Cohort", {IDENTITY}""",
    "export_left_out": """
        SELECT '105' AS skipped_cohorts, count(*) FILTER (WHERE c_acctbal > 4000 AND least(c_nationkey + 1, 12) IN (2, 4, 6, 9, 11)) AS impossible_births
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey BETWEEN 0 AND 3""",
    "numeric_coercion": f"""
        SELECT event_type, field_name, count(v) AS present,
               count(v) > 0 AND count(v) = count(*) FILTER (WHERE regexp_full_match(v, {NUMBER})) AS "numeric"
        FROM ({' UNION ALL '.join(f"SELECT event_type, '{c}' AS field_name, {c} AS v FROM {EVENT_TEXTS}" for c in ('k', 'props', 'blank', 'click', 'empty'))})
        GROUP BY event_type, field_name""",
    "coerced_columns": f"""SELECT event_type, CAST(k AS DOUBLE) AS k, props, blank, CAST(click AS DOUBLE) AS click, empty
        FROM {EVENT_TEXTS}""",
    "diagonal_union": """
        SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS place, c_mktsegment, CAST(NULL AS BIGINT) AS "key" FROM customer
        UNION ALL SELECT s_name, n_name, NULL, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
        UNION ALL SELECT p_name, NULL, NULL, p_size FROM part""",
    "first_value_per_key": """
        SELECT l_suppkey, l_linenumber, arg_min(l_shipdate, (l_returnflag, l_shipdate)) FILTER (WHERE l_tax > 0.02) AS shipped
        FROM lineitem GROUP BY l_suppkey, l_linenumber""",
    "pivot_means": "SELECT user_id, "
    + ", ".join(
        f"{_rounded(f'''avg(value) FILTER (WHERE event_type = '{k}')''', 6)} AS {k}"
        for k in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM events GROUP BY user_id",
    "repeated_visits": "SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1",
    "catalog_requests": f"""
        SELECT request_id, dataset, use_case, status, cohorts, t AS "table",
               CASE WHEN t = '' THEN '' ELSE 'req_' || o_orderkey || '.' || t END AS relation
        FROM (SELECT *, unnest(CASE WHEN o_orderstatus = 'P' THEN [''] WHEN large THEN ['person', 'measurement'] ELSE ['person'] END) AS t
              FROM {REQUEST})""",
    "catalog_summary": f"""
        SELECT request_id, dataset, use_case, status, cohorts, CASE WHEN large THEN 2 ELSE 1 END AS tables
        FROM {REQUEST} WHERE o_orderstatus <> 'P'""",
    "catalog_concepts": f"""
        SELECT request_id, o_custkey AS concept_id, 101 AS cohort, o_orderpriority AS subgroup, '' AS source_field_name,
               'total' AS source_field_description FROM {REQUEST} WHERE large""",
    "catalog_views": """
        SELECT 'v' || p_partkey AS "view", p_type AS category, 'size' AS "column", 'integer' AS type, p_name AS description,
               p_size > 10 AS accessible FROM part
        UNION ALL SELECT 'v' || p_partkey, p_type, 'price', 'string', p_name, p_size > 30 FROM part""",
    "governed_customers": """
        SELECT CAST(n_regionkey AS INTEGER) AS cohort_id, c_custkey, c_name, c_nationkey
        FROM customer JOIN nation ON n_nationkey = c_nationkey
        WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""",
    "granted_row_counts": " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS row_count FROM {t}" for t in COUNTED),
    "granted_view_columns": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders",
    "granted_table_rows": "SELECT * FROM supplier",
    "parameter_query": """SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders
        WHERE o_orderstatus = 'O' AND o_totalprice >= 50000 GROUP BY o_custkey""",
    "write_read_formats": "SELECT * FROM part",
    "export_read": "SELECT c_name AS name, c_acctbal AS acctbal FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier",
    "csv_roundtrip": "SELECT * FROM documents",
    "csv_conversations": "SELECT * FROM conversations",
    "label_encode_prices": """
        SELECT o_orderkey, dense_rank() OVER (ORDER BY CAST(o_totalprice AS VARCHAR)) - 1 AS o_totalprice_encoded FROM orders""",
    "outlier_forest_facts": "SELECT 0 AS planted_left, true AS most_stay",
    "cluster_features": f"""
        WITH m AS (SELECT person_id, name, avg(v) AS v FROM {MEASUREMENTS} WHERE v IS NOT NULL GROUP BY ALL),
        p AS (SELECT DISTINCT person_id FROM m), f AS (SELECT name, avg(v) AS a, count(*) AS n, var_pop(v) AS s FROM m GROUP BY name)
        SELECT p.person_id, f.name AS measure,
               {_rounded("coalesce((m.v - a) / coalesce(nullif(sqrt(s * n / (SELECT count(*) FROM p)), 0), 1), 0)", 5)} AS z
        FROM p CROSS JOIN f LEFT JOIN m ON m.person_id = p.person_id AND m.name = f.name""",
    "cluster_scores": f"""
        SELECT person_id, {_rounded("coalesce(sum(v) FILTER (WHERE contains(name, 'ham_d')), 0)", 2)} AS ham_d_total,
               {_rounded("coalesce(sum(v) FILTER (WHERE contains(name, 'psqi') AND NOT contains(name, 'cumulative')), 0)", 2)} AS psqi_total,
               {_rounded("avg(v) FILTER (WHERE contains(name, 'cdr'))", 2)} AS cdr_score, CAST(sum(n) AS BIGINT) AS num_measurements
        FROM (SELECT person_id, name, avg(v) AS v, count(*) AS n FROM {MEASUREMENTS} GROUP BY ALL) GROUP BY person_id""",
    "range_deviation_scores": f"""
        SELECT person_id, {_rounded('sum(above) * 100', 2)} AS abnormality_score, {_rounded('sum(below) * 100', 2)} AS deficiency_score,
               count(*) FILTER (WHERE above > 0 OR below > 0) AS out_of_range_count
        FROM (SELECT person_id, coalesce(greatest((v - high) / nullif(high, 0), 0), 0) AS above,
                     coalesce(greatest((low - v) / nullif(low, 0), 0), 0) AS below FROM {MEASUREMENTS})
        GROUP BY person_id""",
    "instrument_totals": f"""
        SELECT person_id, {_rounded("coalesce(sum(v) FILTER (WHERE contains(name, 'ham_d')), 0)", 2)} AS ham_d_total,
               {_rounded("coalesce(sum(v) FILTER (WHERE contains(name, 'psqi') AND NOT contains(name, 'cumulative')), 0)", 2)} AS psqi_total,
               {_rounded("avg(v) FILTER (WHERE contains(name, 'cdr'))", 2)} AS cdr_score
        FROM (SELECT person_id, name, avg(v) AS v FROM {MEASUREMENTS} GROUP BY ALL) GROUP BY person_id""",
    "sql_written": f"WITH r AS ({JOIN_AGGREGATE}) SELECT r.*, (SELECT count(*) FROM r) AS row_count FROM r",
}
ORACLES |= {name: duck or text for name, (_, text, duck) in sql_texts.TEXTS.items()}
