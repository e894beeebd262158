"""Clinical long-to-wide export: one row per subject visit and dataset, one column per field.

Tables: person, visit_occurrence, measurement and observation in the OMOP CDM v5.4 layout, and the
warehouse's own cmp_participants, local_concept and cohort_mappings. All cohorts go through one plan; ``cohort_id`` stays in every key.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.functions.exprs import age_in_years, numeric_text, quoted
from cohortflow.operators.relational import one_value_per_key, repeated_keys
from cohortflow.operators.skew import broadcast_if_small
from cohortflow.session import stage
from cohortflow.sources.catalog import active_cohorts, cohort_join, resolve_cohorts

# OMOP gender concepts and the identity columns of the export.
GENDER_MALE = 8507
GENDER_FEMALE = 8532
IDENTITY = ["Barcode", "Subject_ID", "Gender", "Age_at_Visit", "Visit", "Assessment_Date"]
SOURCE_FIELDS = ("source_field_name", "source_field_description")
UNKNOWN_DATASET = "Unknown"


@dataclass(frozen=True)
class _Field:
    dataset: str
    name: str
    numeric: bool


def concept_map(local_concept: DataFrame, source_field: str = "source_field_name") -> DataFrame:
    """cohort_id, concept_id, dataset, field_name; an empty label falls back to the other field."""
    if source_field not in SOURCE_FIELDS:
        raise ValueError(f"source_field must be one of: {', '.join(map(repr, SOURCE_FIELDS))}")
    other = next(f for f in SOURCE_FIELDS if f != source_field)
    label = F.coalesce(F.nullif(F.col(source_field), F.lit("")), F.col(other))
    return local_concept.select(
        F.col("cohort").alias("cohort_id"),
        "concept_id",
        F.coalesce(F.nullif(F.col("dataset"), F.lit("")), F.lit(UNKNOWN_DATASET)).alias("dataset"),
        label.alias("field_name"),
    ).filter(F.col("concept_id").isNotNull() & F.col("field_name").isNotNull())


def person_base(
    person: DataFrame,
    participants: DataFrame,
    male: int = GENDER_MALE,
    female: int = GENDER_FEMALE,
    keep_year: bool = False,
) -> DataFrame:
    """Identity of each person who is a participant; an impossible birth date becomes NULL."""
    born = F.concat_ws(
        "-",
        F.col("year_of_birth").cast("string"),
        F.coalesce(F.col("month_of_birth"), F.lit(1)).cast("string"),
        F.coalesce(F.col("day_of_birth"), F.lit(1)).cast("string"),
    )
    gender = F.col("gender_concept_id")
    people = person.select(
        "cohort_id",
        "person_id",
        F.col("person_source_value").alias("Barcode"),
        F.when(gender == male, "Male").when(gender == female, "Female").otherwise("Unknown").alias("Gender"),
        F.when(F.col("year_of_birth").isNotNull(), F.try_to_date(born, "y-M-d")).alias("_born"),
        *([F.col("year_of_birth").alias("_year")] if keep_year else []),
    )
    listed = participants.select("cohort_id", F.col("barcode").alias("Barcode"), F.col("subject_id").alias("Subject_ID"))
    return cohort_join(people, listed, "Barcode")


def visit_rows(
    tables: Mapping[str, DataFrame],
    cohort_ids: list[int],
    source_field: str = "source_field_name",
    gender_male: int = GENDER_MALE,
    gender_female: int = GENDER_FEMALE,
    datasets: Collection[str] | None = None,
) -> DataFrame:
    """cohort_id, identity, dataset, per field the value that counts (map ``_held``) and, in the order of
    its entries, their sources (``_from``): one row per visit, person and dataset.

    Values are deduplicated per person, visit and field before any large join, on partial aggregation,
    so a visit with very many rows reaches the joins with one row per field. They are gathered where
    the visits are joined, so no shuffle of single values follows, in the one sort that join needs.
    """

    def of_cohorts(name: str) -> DataFrame:
        return tables[name].filter(F.col("cohort_id").isin(cohort_ids))

    listed = tables["local_concept"].filter(F.col("cohort").isin(cohort_ids))
    mapped = concept_map(listed, source_field).distinct()
    if datasets is not None:
        mapped = mapped.filter(F.col("dataset").isin(list(datasets)))
    mapped = stage(mapped, "concepts")
    label = ["dataset", "field_name"]
    numbered = mapped.select(*label).distinct().withColumn("_field", F.monotonically_increasing_id())
    fields = broadcast_if_small(stage(numbered, "fields"))  # counted, as are the concepts; staged, so a number stays
    concepts = broadcast_if_small(mapped.join(fields, label).select("cohort_id", "concept_id", "_field"))

    def granted(name: str, concept: str, value: Column, source: int) -> DataFrame:
        rows = of_cohorts(name).filter(F.col("visit_occurrence_id").isNotNull())
        return rows.select(
            "cohort_id",
            "person_id",
            "visit_occurrence_id",
            F.col(concept).alias("concept_id"),
            value.alias("field_value"),
            F.lit(source).alias("_source"),
        ).join(concepts, ["cohort_id", "concept_id"])

    rows = granted(
        "measurement", "measurement_source_concept_id", F.col("value_as_number").cast("string"), 0
    ).unionByName(
        granted("observation", "observation_source_concept_id", F.col("value_as_string"), 1)
    )
    ranked = F.struct("_source", "field_value")
    # the key with most values first, here and in the joins: sorting compares its prefix
    slim = rows.groupBy("visit_occurrence_id", "_field", "person_id", "cohort_id").agg(  # concepts may share a field
        F.min(F.when(F.col("field_value").isNotNull(), ranked)).alias("_best")
    )
    # a window sorts once, in the order the join with the visits asks for; a grouping sorts its lists twice more
    keys = ["visit_occurrence_id", "cohort_id", "person_id", "dataset"]
    ordered = Window.partitionBy(*keys).orderBy("field_name")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cell = F.struct("field_name", "_best._source", "_best.field_value")
    gathered = (
        slim.join(fields, "_field")
        .repartition("visit_occurrence_id", "cohort_id")  # as the visits are joined
        .select(*keys, F.collect_list(cell).over(whole).alias("_cells"), F.row_number().over(ordered).alias("_nth"))
        .filter(F.col("_nth") == 1)
        .select(
            *keys,
            F.map_from_arrays("_cells.field_name", "_cells.field_value").alias("_held"),
            F.col("_cells._source").alias("_from"),
        )
    )
    visits = of_cohorts("visit_occurrence").select(
        "cohort_id",
        "visit_occurrence_id",
        F.col("visit_source_value").alias("Visit"),
        F.col("visit_start_date").cast("date").alias("Assessment_Date"),
    )
    people = person_base(
        of_cohorts("person"), of_cohorts("cmp_participants"), gender_male, gender_female
    )
    return (
        gathered.join(visits, ["visit_occurrence_id", "cohort_id"])
        .join(people, ["person_id", "cohort_id"])
        .select(
            "cohort_id",
            "Barcode",
            "Subject_ID",
            "Gender",
            age_in_years(F.col("Assessment_Date"), F.col("_born")).cast("bigint").alias("Age_at_Visit"),
            "Visit",
            "Assessment_Date",
            "dataset",
            "_held",
            "_from",
        )
    )


def _one_per_identity(rows: DataFrame, index: list[str]) -> DataFrame:
    """Rows that agree in dataset and ``index`` become one; per field the smallest source and value count.

    Few visits share an identity. Its hash finds them, and all other rows stay as they are.
    """
    rows = stage(rows.withColumn("_place", F.xxhash64("dataset", *index)), "visit-rows")
    shared = stage(repeated_keys(rows, ["_place"]).select("_place"), "shared-places")
    few = broadcast_if_small(shared)  # counted
    if shared.isEmpty():
        return rows.select("dataset", *index, "_held")
    single = rows.join(few, "_place", "left_anti").select("dataset", *index, "_held")
    long = rows.join(few, "_place", "left_semi").select(
        "_place", "dataset", *index, "_from", F.posexplode("_held").alias("_at", "field_name", "field_value")
    ).withColumn("_source", F.get("_from", F.col("_at")))
    # one shuffle for both groupings; a hot identity comes down to its fields before they are gathered
    keys = ["_place", "dataset", *index]
    one = one_value_per_key(long.repartition("_place"), [*keys, "field_name"], "field_value", "_source")
    held = F.map_from_entries(F.collect_list(F.struct("field_name", "field_value"))).alias("_held")
    return single.unionByName(stage(one.groupBy(*keys).agg(held).drop("_place"), "shared-rows"))


def wide_tables(tables: Mapping[str, DataFrame], granted: list[int], org_name: str, **options) -> dict[str, DataFrame]:
    """One wide frame per dataset, sorted by Barcode and Visit.

    ``cohort`` (id or name) exports that cohort without a Cohort column; otherwise every granted and
    active cohort is exported under its registry name. ``datasets`` names the sheets wanted: values of
    others are left out where concepts are looked up (None: all sheets). Options: ``cohort``,
    ``source_field``, ``gender_male``, ``gender_female``, ``datasets``.
    """
    rows, fields, index = _sheet_rows(tables, granted, org_name, **options)
    sheets = {}
    for dataset in sorted({f.dataset for f in fields}):
        own = {f.name: f.numeric for f in fields if f.dataset == dataset}
        sheet, cells = rows.filter(F.col("dataset") == dataset), _cells(index, sorted(own))
        typed = [cells[name].cast("double") if own[name] else cells[name] for name in sorted(own)]
        sheets[dataset] = _named(sheet, index, typed, sorted(own), ["Barcode", "Visit"])
    return sheets


def _cells(index: list[str], names: list[str]) -> dict[str, Column]:
    """The cell of each field in a row's map ``_held``.

    Field names are map keys, so names that differ in case only, or from an identity column in case
    only, stay apart.
    """
    if clash := sorted(set(names) & set(index)):
        raise ValueError(f"Fields are named like identity columns: {', '.join(clash)}")
    return {name: F.try_element_at("_held", F.lit(name)) for name in names}


def _named(sheet: DataFrame, index: list[str], cells: list[Column], names: list[str], order: list[str]) -> DataFrame:
    """Index and cells, sorted; the columns get their names by position at the very end."""
    plain = sheet.select(*[quoted(c) for c in index], *[c.alias(f"_f{i}") for i, c in enumerate(cells)])
    return plain.orderBy(*order).toDF(*index, *names)


def wide_stacked(tables: Mapping[str, DataFrame], granted: list[int], org_name: str, **options) -> DataFrame:
    """All datasets in one sheet: dataset, identity, then the union of all fields by name.

    One grouping covers all datasets. A field that is numeric in some datasets and text in others is
    text here, its numbers spelled as doubles.
    """
    sheet, fields, index = _sheet_rows(tables, granted, org_name, **options)
    kinds: dict[str, set[bool]] = {}
    for f in fields:
        kinds.setdefault(f.name, set()).add(f.numeric)
    names = sorted(kinds)
    cells = _cells(["dataset", *index], names)
    typed = []
    for name in names:
        cell, numeric = cells[name], kinds[name]
        if numeric == {True}:
            cell = cell.cast("double")
        elif True in numeric:
            spelled = [f.dataset for f in fields if f.name == name and f.numeric]
            cell = F.when(F.col("dataset").isin(spelled), cell.try_cast("double").cast("string")).otherwise(cell)
        typed.append(cell)
    order = ["dataset", *[c for c in ("Cohort", "Barcode", "Visit") if c in index]]
    return _named(sheet, ["dataset", *index], typed, names, order)


def export_notes(tables: Mapping[str, DataFrame], granted: list[int], org_name: str, cohort: int | str | None = None) -> DataFrame:
    """One row on what an export leaves out: ``skipped_cohorts`` (granted, but not active) and
    ``impossible_births``, the persons of its cohorts whose birth date does not exist (no age)."""
    chosen = resolve_cohorts(active_cohorts(tables["cohort_mappings"], org_name), granted, cohort)
    people = tables["person"].filter(F.col("cohort_id").isin(list(chosen.ids)))
    based = person_base(people, tables["cmp_participants"].filter(F.col("cohort_id").isin(list(chosen.ids))), keep_year=True)
    impossible = F.count(F.when(F.col("_year").isNotNull() & F.col("_born").isNull(), 1))
    skipped = F.array(*[F.lit(int(c)) for c in sorted(chosen.skipped)]).cast("array<int>")
    return based.agg(skipped.alias("skipped_cohorts"), impossible.alias("impossible_births"))


def numeric_fields(long: DataFrame, keys: list[str], value: str = "field_value") -> DataFrame:
    """Per key: present (non-null values) and numeric (all of them, at least one, spell a number)."""
    return long.groupBy(*keys).agg(
        F.count(value).alias("present"),
        (
            (F.count(value) > 0)
            & (F.count(value) == F.count(numeric_text(F.col(value))))
        ).alias("numeric"),
    )


def coerce_numeric(wide: DataFrame, identity: list[str]) -> DataFrame:
    """Text columns whose values all spell a number become double; identity columns never change."""
    texts = [f.name for f in wide.schema.fields if f.dataType.simpleString() == "string" and f.name not in identity]
    if not texts:
        return wide
    facts = []
    for i, c in enumerate(texts):
        col = F.col(quoted(c))
        facts += [F.count(col).alias(f"p{i}"), F.count(numeric_text(col)).alias(f"n{i}")]
    row = wide.agg(*facts).first()
    typed = {
        c: numeric_text(F.col(quoted(c)))
        for i, c in enumerate(texts)
        if row[f"p{i}"] and row[f"p{i}"] == row[f"n{i}"]
    }
    return wide.withColumns(typed) if typed else wide


def _sheet_rows(
    tables: Mapping[str, DataFrame],
    granted: list[int],
    org_name: str,
    cohort: int | str | None = None,
    source_field: str = "source_field_name",
    gender_male: int = GENDER_MALE,
    gender_female: int = GENDER_FEMALE,
    datasets: Collection[str] | None = None,
) -> tuple[DataFrame, list[_Field], list[str]]:
    """The sheets' rows (from written tables, several passes read them), their fields, the index.

    A row is a dataset and an identity with its fields in the map ``_held``: work and memory follow the
    values that are there, not rows times fields.
    """
    if source_field not in SOURCE_FIELDS:
        raise ValueError(f"source_field must be one of: {', '.join(map(repr, SOURCE_FIELDS))}")
    registry = active_cohorts(tables["cohort_mappings"], org_name)
    chosen = resolve_cohorts(registry, granted, cohort)
    if not chosen.ids:
        raise RuntimeError("The access request grants no active cohorts")
    rows = visit_rows(tables, chosen.ids, source_field, gender_male, gender_female, datasets)
    index = list(IDENTITY)
    if not chosen.single:
        index = ["Cohort", *IDENTITY]
        name = F.col("cohort_id").cast("string")
        for cohort_id in chosen.ids:
            name = F.when(F.col("cohort_id") == cohort_id, F.lit(registry[cohort_id])).otherwise(name)
        rows = rows.withColumn("Cohort", name)
    rows = _one_per_identity(rows.drop("cohort_id"), index)
    cells = rows.select("dataset", F.explode("_held").alias("field_name", "field_value"))
    found = numeric_fields(cells, ["dataset", "field_name"]).collect()
    if not found:
        raise RuntimeError("No data returned for the granted cohort(s)")
    fields = sorted(
        (_Field(r["dataset"], r["field_name"], r["numeric"]) for r in found),
        key=lambda f: (f.dataset, f.name),
    )
    return rows, fields, index
