"""URL filters as a temporal list join.

A list is a table of dated events: from ``listed_on`` on, ``key`` is blocked, allowed or off the list.
The events of a key become validity intervals, and every capture is judged by the entries that were
active when it was fetched: an as-of equi-join on the keys its URL can match. The most specific active
entry decides: longer path first, then more host labels.

A key is ``host`` or ``host/dir/dir``; a capture matches the key of its host, of each parent domain,
and of each leading part of its path below its own host or one of the parents. How many labels and
path parts are tried follows from the list itself, so a URL with ten thousand slashes costs no more
than the deepest entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortflow.llm.common import pick, read
from cohortflow.session import stage

#: Of several events on one day, the strictest counts.
STRICTNESS = ("off", "allow", "block")


def host(url: Column) -> Column:
    """Lower-case host of a URL without credentials, port and final dot; null without one."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*+://(?:[^/?#@]*+@)?([^/?#:]++)", 1)
    return F.nullif(F.regexp_replace(F.lower(found), r"\.$", ""), F.lit(""))


def path_parts(url: Column) -> Column:
    """Non-empty parts of a URL's path, without query and fragment."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*+://[^/?#]*+([^?#]*+)", 1)
    return F.filter(F.split(path, "/"), lambda p: p != "")


def intervals(events: DataFrame) -> DataFrame:
    """``key, action, valid_from, valid_to`` (end exclusive, null: open) from ``key, action, listed_on``.

    Each event ends the one before it. Events without key or date, or with an unknown action, are
    void; of several events of a key on one day the strictest counts, however often it is repeated.
    """
    rank = F.array_position(F.array([F.lit(a) for a in STRICTNESS]), F.col("action"))
    known = pick(events, "key", "action", "listed_on").withColumn("rank", rank)
    known = known.where("key IS NOT NULL AND listed_on IS NOT NULL AND rank > 0")
    days = known.groupBy("key", "listed_on").agg(F.max("rank").alias("rank"))
    ends = F.lead("listed_on").over(W.partitionBy("key").orderBy("listed_on"))
    dated = days.select("key", "rank", F.col("listed_on").alias("valid_from"), ends.alias("valid_to"))
    action = F.element_at(F.array([F.lit(a) for a in STRICTNESS]), F.col("rank").cast("int"))
    return dated.where("rank > 1").select("key", action.alias("action"), "valid_from", "valid_to")


def judge(captures: DataFrame, events: DataFrame) -> DataFrame:
    """``captures`` (``page_id, url, fetched_on``) with ``host, verdict, entry, listed_on``.

    ``verdict`` is ``block``, ``allow`` or ``pass`` (no active entry, or no host, null URL or no
    fetch date). Repeated captures are judged each. Empty tables are fine on either side.
    """
    active = stage(intervals(events), "url-intervals")
    labels = F.size(F.split(F.split_part(F.col("key"), F.lit("/"), F.lit(1)), r"\."))
    depth = F.size(F.split("key", "/")) - 1
    most_labels, most_parts = active.agg(F.max(labels), F.max(depth)).first()
    url = F.col("url")
    rows = pick(captures, "page_id", "url", "fetched_on").withColumns(
        {"row": F.monotonically_increasing_id(), "host": host(url), "parts": F.slice(path_parts(url), 1, (most_parts or 0) + 1)}
    )
    rows = stage(rows, "url-captures")
    named = F.split("host", r"\.")
    count = F.size(named)
    # Own host first, then its parents, none longer than the longest host on the list.
    domains = F.transform(
        F.sequence(F.lit(1), F.least(count, F.lit(most_labels or 1))),
        lambda n: F.array_join(F.slice(named, count - n + 1, n), "."),
    )
    below = F.transform(
        F.sequence(F.lit(0), F.least(F.size("parts"), F.lit(most_parts or 0))),
        lambda n: F.concat_ws("", F.transform(F.slice("parts", 1, n), lambda p: F.concat(F.lit("/"), p))),
    )
    keys = F.flatten(
        F.transform(
            domains,
            lambda d, i: F.transform(
                below, lambda p, j: F.struct(F.concat(d, p).alias("key"), j.alias("parts"), (i + 1).alias("labels"))
            ),
        )
    )
    tried = rows.where("host IS NOT NULL AND fetched_on IS NOT NULL").select(
        "row", "fetched_on", F.explode(keys).alias("k")
    )
    on = (
        (F.col("k.key") == F.col("key"))
        & (F.col("fetched_on") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to")))
    )
    best = F.max(F.struct("k.parts", "k.labels", "key", "action", "valid_from")).alias("best")
    found = tried.join(active, on).groupBy("row").agg(best)
    return rows.join(found, "row", "left").select(
        "page_id",
        "url",
        "fetched_on",
        "host",
        F.coalesce("best.action", F.lit("pass")).alias("verdict"),
        F.col("best.key").alias("entry"),
        F.col("best.valid_from").alias("listed_on"),
    )


def _number(digest: Column, at: int, n: int) -> Column:
    return F.pmod(F.conv(F.substring(digest, at, 6), 16, 10).cast("int"), F.lit(n))


def fetched(pages: DataFrame) -> DataFrame:
    """Captures: the pages carry no date, so each gets a day of 2024 from a digest of its id."""
    day = _number(F.md5(F.col("page_id").cast("string")), 1, 366)
    return pages.withColumn("fetched_on", F.date_add(F.lit("2024-01-01").cast("date"), day))


def listed(pages: DataFrame) -> DataFrame:
    """A dated list derived from the pages: every host, its parent domain and its sections get events.

    A digest of the key decides on which three days of 2024 the key is blocked, allowed or off.
    """
    domain = F.substring_index(host(F.col("url")), ".", -3)
    section = F.concat_ws("/", host(F.col("url")), F.element_at(F.array_append(path_parts(F.col("url")), F.lit("-")), 1))
    keys = pages.select(F.explode(F.array(host(F.col("url")), domain, section)).alias("key"), "url")
    keys = keys.where(host(F.col("url")).isNotNull()).select("key").distinct()
    actions = F.array([F.lit(a) for a in (*STRICTNESS, "block")])
    events = F.array(
        *[
            F.struct(
                F.element_at(actions, _number(F.md5("key"), 1 + 6 * i, 4) + 1).alias("action"),
                _number(F.md5("key"), 14 + 6 * i, 366).alias("day"),
            )
            for i in range(2)
        ]
    )
    dated = keys.select("key", F.explode(events).alias("e"))
    start = F.lit("2024-01-01").cast("date")
    return dated.select("key", F.col("e.action").alias("action"), F.date_add(start, F.col("e.day")).alias("listed_on"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries that were active on the day it was fetched."""
    pages = pick(read(spark, sf_dir, "pages"), "page_id", "url")
    judged = judge(fetched(pages), listed(pages))
    return judged.withColumns({day: F.col(day).cast("string") for day in ("fetched_on", "listed_on")})


OP10_SQL = r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 6))::INT % 366 AS INT) AS fetched_on,
    nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.$', ''), '') AS host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS parts
  FROM pages),
k AS (SELECT DISTINCT unnest([host, array_to_string(string_split(host, '.')[-3:], '.'), host || '/' || coalesce(parts[1], '-')]) AS key
  FROM p WHERE host IS NOT NULL),
e AS (SELECT key, i, ['off', 'allow', 'block', 'block'][1 + ('0x' || substr(md5(key), 1 + 6 * i, 6))::INT % 4] AS action,
    DATE '2024-01-01' + CAST(('0x' || substr(md5(key), 14 + 6 * i, 6))::INT % 366 AS INT) AS listed_on
  FROM k, (SELECT unnest([0, 1]) AS i)),
d AS (SELECT key, listed_on, max(list_position(['off', 'allow', 'block'], action)) AS strict FROM e GROUP BY ALL),
v AS (SELECT *, lead(listed_on) OVER (PARTITION BY key ORDER BY listed_on) AS until FROM d),
t AS (SELECT page_id, fetched_on, n, m,
    array_to_string(string_split(host, '.')[-n:], '.') || CASE WHEN m = 0 THEN '' ELSE '/' || array_to_string(parts[1:m], '/') END AS tried
  FROM p, LATERAL (SELECT unnest(range(1, len(string_split(host, '.')) + 1)) AS n), LATERAL (SELECT unnest(range(0, len(parts) + 1)) AS m)),
b AS (SELECT page_id, arg_max({'key': key, 'listed_on': listed_on, 'strict': strict}, m * 1000 + n) AS best
  FROM t JOIN v ON tried = key AND fetched_on >= listed_on AND (until IS NULL OR fetched_on < until) AND strict > 1
  GROUP BY page_id)
SELECT page_id, url, CAST(fetched_on AS VARCHAR) AS fetched_on, host, coalesce(['off', 'allow', 'block'][best.strict], 'pass') AS verdict,
  best.key AS entry, CAST(best.listed_on AS VARCHAR) AS listed_on
FROM p LEFT JOIN b USING (page_id)
"""
