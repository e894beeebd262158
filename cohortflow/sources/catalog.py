"""Governed access: request and view catalogs as nested documents, cohort registry, granted rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from cohortflow.operators.skew import broadcast_if_small

REQUEST_SCHEMA = (
    "id string, schema string, dataset string, use_case string, status string, cohorts array<int>, "
    "created_at string, tables array<struct<name: string, relation: string>>, "
    "concepts array<struct<concept_id: bigint, cohort: int, subgroup: string, "
    "source_field_name: string, source_field_description: string>>"
)
VIEW_SCHEMA = (
    "name string, description string, category string, "
    "columns array<struct<name: string, type: string, description: string, accessible: boolean>>"
)


class AccessError(ValueError):
    """A request, view or table that is unknown, not approved or not granted."""


def read_requests(spark, path: str) -> DataFrame:
    """Request documents, one JSON object per line."""
    return spark.read.schema(REQUEST_SCHEMA).json(path)


def read_views(spark, path: str) -> DataFrame:
    return spark.read.schema(VIEW_SCHEMA).json(path)


def _text(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def is_approved() -> Column:
    return F.lower(F.trim(_text("status"))) == "approved"


def _items(name: str) -> Column:
    """The documents' list without null entries (an empty list where absent)."""
    return F.coalesce(F.filter(F.col(name), lambda item: item.isNotNull()), F.array())


def _request_lead() -> list[Column]:
    cohorts = F.coalesce(F.col("cohorts"), F.array().cast("array<int>"))
    return [
        _text("id").alias("request_id"),
        _text("dataset").alias("dataset"),
        _text("use_case").alias("use_case"),
        _text("status").alias("status"),
        F.array_join(cohorts.cast("array<string>"), ", ").alias("cohorts"),
    ]


def requests_frame(requests: DataFrame) -> DataFrame:
    """One row per request and table; a request without tables has one row with empty names."""
    return requests.select(*_request_lead(), F.explode_outer(_items("tables")).alias("_t")).select(
        "request_id", "dataset", "use_case", "status", "cohorts",
        _text("_t.name").alias("table"), _text("_t.relation").alias("relation"),
    )


def requests_summary(requests: DataFrame) -> DataFrame:
    """One row per request with its number of tables."""
    return requests.select(*_request_lead(), F.size(_items("tables")).alias("tables"))


def concepts_frame(requests: DataFrame) -> DataFrame:
    """One row per concept grant of each request."""
    return requests.select(_text("id").alias("request_id"), F.explode(_items("concepts")).alias("_c")).select(
        "request_id",
        F.coalesce("_c.concept_id", F.lit(0)).cast("bigint").alias("concept_id"),
        F.coalesce("_c.cohort", F.lit(0)).cast("int").alias("cohort"),
        _text("_c.subgroup").alias("subgroup"),
        _text("_c.source_field_name").alias("source_field_name"),
        _text("_c.source_field_description").alias("source_field_description"),
    )


def views_frame(views: DataFrame) -> DataFrame:
    """One row per view and column."""
    return views.select(
        _text("name").alias("view"), _text("category").alias("category"), F.explode(_items("columns")).alias("_c")
    ).select(
        "view", "category", _text("_c.name").alias("column"), _text("_c.type").alias("type"),
        _text("_c.description").alias("description"),
        F.coalesce("_c.accessible", F.lit(False)).alias("accessible"),
    )


def view_columns(views: DataFrame, view: str) -> list[str]:
    """The accessible columns of one view; an unknown view raises."""
    found = views.filter(F.col("name") == view).head(1)
    if not found:
        raise AccessError(f"Unknown view: {view!r}")
    return [c["name"] or "" for c in found[0]["columns"] or [] if c is not None and c["accessible"]]


def approved(requests: DataFrame) -> DataFrame:
    return requests.filter(is_approved())


def resolve_request(requests: DataFrame, request_id: str | None = None) -> Row:
    """The request with this id or schema alias, else the only approved one."""
    if request_id is not None:
        match = (F.col("id") == request_id) | (F.col("schema") == request_id)
        found = requests.filter(match).head(1)
        if not found:
            raise AccessError(f"Unknown access request: {request_id!r}")
        if (found[0]["status"] or "").strip().lower() != "approved":
            raise AccessError(
                f"Access request {found[0]['id']} is not approved (status: {found[0]['status']!r})"
            )
        return found[0]
    ids = [r["id"] for r in approved(requests).select("id").collect()]
    if not ids:
        raise AccessError("There are no approved access requests")
    if len(ids) > 1:
        raise AccessError(f"There are {len(ids)} approved access requests, choose one of: {', '.join(ids)}")
    return approved(requests).head(1)[0]


def select_tables(request: Row, names: Iterable[str] | None = None) -> list[str]:
    """Granted table names, all in catalog order or the asked ones in the asked order."""
    granted = [t["name"] or "" for t in request["tables"] or [] if t is not None]
    if names is None:
        return granted
    names = list(names)
    for name in names:
        if name not in granted:
            raise AccessError(f"Table {name!r} is not granted by request {request['id']}")
    return names


def row_counts(tables: Mapping[str, DataFrame], names: Iterable[str] | None = None) -> DataFrame:
    """table, row_count for each table; one job counts them all."""
    names = list(tables) if names is None else list(names)
    for name in names:
        if name not in tables:
            raise AccessError(f"Table {name!r} is not granted")
    parts = [
        tables[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table"), "row_count")
        for name in names
    ]
    if not parts:
        raise AccessError("No tables to count")
    return reduce(DataFrame.unionByName, parts)


def governed_relation(
    cohort_tables: Mapping[int, DataFrame], grants: DataFrame, concept_column: str | None = None
) -> DataFrame:
    """All granted cohorts of one table with ``cohort_id`` in front.

    With ``concept_column`` only rows of concepts granted for that very cohort remain; ``grants`` has
    the columns cohort and concept_id.
    """
    if not cohort_tables:
        raise AccessError("The request grants no cohorts")
    parts = [
        df.select(F.lit(cohort).cast("int").alias("cohort_id"), *[c for c in df.columns if c != "cohort_id"])
        for cohort, df in sorted(cohort_tables.items())
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if concept_column is None:
        return rows
    allowed = grants.select(
        F.col("cohort").cast("int").alias("cohort_id"), F.col("concept_id").alias(concept_column)
    ).distinct()
    return rows.join(broadcast_if_small(allowed), ["cohort_id", concept_column], "left_semi")


def cohort_join(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Ids repeat across cohorts: join on the key and the cohort."""
    return left.join(right, ["cohort_id", *keys], how)


def active_cohorts(mappings: DataFrame, org_name: str) -> dict[int, str]:
    """id to name of the organisation's active cohorts."""
    rows = (
        mappings.filter(F.col("is_active") & (F.col("org_name") == org_name))
        .select("cohort_id", "cohort_name")
        .dropna()
        .distinct()
        .collect()
    )
    return {int(r["cohort_id"]): str(r["cohort_name"]) for r in sorted(rows)}


@dataclass(frozen=True)
class CohortChoice:
    ids: list[int]
    single: bool
    skipped: list[int]


def resolve_cohorts(
    registry: Mapping[int, str], granted: Iterable[int], cohort: int | str | None = None
) -> CohortChoice:
    """One cohort by id, digit text or exact name; None, blank or ``__all__`` means all granted."""
    if isinstance(cohort, str):
        cohort = cohort.strip()
    if cohort is None or cohort in ("", "__all__"):
        granted = list(dict.fromkeys(granted))
        return CohortChoice(
            [c for c in granted if c in registry], False, sorted(c for c in granted if c not in registry)
        )
    if isinstance(cohort, str) and not cohort.isdigit():
        by_name = {name: i for i, name in registry.items()}
        if cohort not in by_name:
            raise ValueError(f"Unknown cohort name {cohort!r}; active cohorts: {sorted(by_name)}")
        return CohortChoice([by_name[cohort]], True, [])
    if int(cohort) not in registry:
        raise ValueError(f"Cohort {int(cohort)} is not active; active cohorts: {sorted(registry)}")
    return CohortChoice([int(cohort)], True, [])
