"""SQL texts that run through the SQL step: input tables, Spark SQL, and the DuckDB spelling where
it differs (None where the same text runs in both)."""

TEXTS: dict[str, tuple[list[str], str, str | None]] = {
    "sql_join_aggregate": (
        ["region", "nation", "customer", "orders"],
        """
        SELECT r_name, o_orderstatus, count(*) AS n_orders, count(DISTINCT c_custkey) AS n_customers,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
        FROM orders
        JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey
        WHERE o_totalprice > 1000
        GROUP BY r_name, o_orderstatus
        """,
        None,
    ),
    "sql_grouping_sets": (
        ["lineitem"],
        """
        SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag) AS BIGINT) AS g, count(*) AS n,
               count(*) FILTER (WHERE l_tax = 0) AS untaxed, max(l_shipdate) AS last_ship
        FROM lineitem
        GROUP BY CUBE (l_returnflag, l_linestatus)
        """,
        None,
    ),
    "sql_windows": (
        ["orders"],
        """
        SELECT o_orderkey,
               CAST(row_number() OVER w AS BIGINT) AS position,
               lag(o_totalprice) OVER w AS previous_price,
               max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                       ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS near_max,
               CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS BIGINT) AS priority_rank,
               CAST(ntile(4) OVER w AS BIGINT) AS quarter
        FROM orders
        WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
        """,
        None,
    ),
    "sql_set_operations": (
        ["orders", "customer"],
        """
        (SELECT o_custkey AS k, 'buyer' AS kind FROM orders WHERE o_orderstatus = 'F'
         EXCEPT ALL SELECT o_custkey, 'buyer' FROM orders WHERE o_orderpriority = '1-URGENT')
        UNION ALL
        (SELECT c_custkey, 'rich' FROM customer WHERE c_acctbal > 0
         INTERSECT SELECT o_custkey, 'rich' FROM orders)
        """,
        None,
    ),
    "sql_semi_anti": (
        ["customer", "orders", "supplier"],
        """
        SELECT c_custkey, c_mktsegment, (SELECT max(s_acctbal) FROM supplier WHERE s_nationkey = c_nationkey) AS best
        FROM customer
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
          AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 490000)
        """,
        None,
    ),
    "sql_outer_join": (
        ["part", "lineitem"],
        """
        SELECT p_partkey, l_suppkey, count(l_orderkey) AS n
        FROM (SELECT * FROM part WHERE p_size < 25) p
        FULL JOIN (SELECT * FROM lineitem WHERE l_quantity > 49) l ON p_partkey = l_partkey
        GROUP BY p_partkey, l_suppkey
        """,
        None,
    ),
    "sql_bands": (
        ["orders"],
        """
        SELECT band, o_orderstatus, count(*) AS n
        FROM orders JOIN (VALUES ('low', 0.0, 99999.99), ('mid', 100000.0, 299999.99), ('high', 300000.0, 1e12))
             AS b(band, low, high) ON o_totalprice BETWEEN low AND high
        GROUP BY band, o_orderstatus
        """,
        None,
    ),
    "sql_pivot": (
        ["orders"],
        """
        SELECT * FROM (SELECT o_orderpriority, o_orderstatus, o_orderkey FROM orders)
        PIVOT (count(o_orderkey) AS n FOR o_orderstatus IN ('F' AS f, 'O' AS o, 'P' AS p))
        """,
        """
        SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS f,
               count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p
        FROM orders GROUP BY o_orderpriority
        """,
    ),
    "sql_unpivot": (
        ["lineitem"],
        """
        SELECT measure, v, count(*) AS n
        FROM (SELECT l_discount, l_tax FROM lineitem) UNPIVOT (v FOR measure IN (l_discount, l_tax))
        GROUP BY measure, v
        """,
        """
        SELECT measure, v, count(*) AS n
        FROM (SELECT 'l_discount' AS measure, l_discount AS v FROM lineitem
              UNION ALL SELECT 'l_tax', l_tax FROM lineitem)
        WHERE v IS NOT NULL GROUP BY measure, v
        """,
    ),
    "sql_months": (
        ["orders"],
        """
        WITH RECURSIVE bounds AS (
            SELECT CAST(date_trunc('MONTH', min(o_orderdate)) AS DATE) AS first_month, max(o_orderdate) AS last_day FROM orders
        ), months(m, last_day) AS (
            SELECT first_month, last_day FROM bounds
            UNION ALL
            SELECT CAST(add_months(m, 1) AS DATE), last_day FROM months WHERE add_months(m, 1) <= last_day
        )
        SELECT m AS month_start, count(o_orderkey) AS n
        FROM months LEFT JOIN orders ON CAST(date_trunc('MONTH', o_orderdate) AS DATE) = m
        GROUP BY m
        """,
        """
        WITH RECURSIVE bounds AS (
            SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS first_month, max(o_orderdate) AS last_day FROM orders
        ), months(m, last_day) AS (
            SELECT first_month, last_day FROM bounds
            UNION ALL
            SELECT CAST(m + INTERVAL 1 MONTH AS DATE), last_day FROM months WHERE m + INTERVAL 1 MONTH <= last_day
        )
        SELECT m AS month_start, count(o_orderkey) AS n
        FROM months LEFT JOIN orders ON CAST(date_trunc('month', o_orderdate) AS DATE) = m
        GROUP BY m
        """,
    ),
    "sql_functions": (
        ["events"],
        """
        SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k, upper(event_type) AS kind,
               substring(event_type, 2, 3) AS part, date_format(ts, 'yyyy-MM-dd HH') AS hour_text,
               hour(ts) AS h, floor(value) AS whole, regexp_replace(props, '[^0-9]', '') AS digits,
               CASE WHEN value > 50 THEN 'high' WHEN value > 5 THEN 'mid' ELSE 'low' END AS level,
               coalesce(nullif(event_type, 'error'), 'none') AS clean, length(props) AS size
        FROM events
        """,
        """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, upper(event_type) AS kind,
               substring(event_type, 2, 3) AS part, strftime(ts, '%Y-%m-%d %H') AS hour_text,
               CAST(hour(ts) AS INTEGER) AS h, CAST(floor(value) AS BIGINT) AS whole,
               regexp_replace(props, '[^0-9]', '', 'g') AS digits,
               CASE WHEN value > 50 THEN 'high' WHEN value > 5 THEN 'mid' ELSE 'low' END AS level,
               coalesce(nullif(event_type, 'error'), 'none') AS clean, CAST(length(props) AS INTEGER) AS size
        FROM events
        """,
    ),
    "sql_top_orders": (
        ["orders"],
        """
        SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25
        """,
        None,
    ),
}
