"""Visit-to-timepoint assignment.

Ordinary participants take one shuffle: every step is a window over the participant. Participants
whose rows are too many for one task take a second plan in which nothing is grouped row by row: the
baseline and the winning visit of each window are aggregates (a few rows per participant), broadcast
back to rows that never move.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.exprs import quoted, round_even, trimmed_equals, whole_days
from cohortflow.operators.relational import require_columns
from cohortflow.operators.schedule import Schedule, build_schedule
from cohortflow.operators.skew import HOT_ROWS, ordered_pieces, profile_keys, split_hot, with_row_ids


@dataclass(frozen=True)
class TimepointResult:
    """``timepoints``: the visits; ``duplicates``: one row per participant and contested window;
    ``candidates``: the visits of those windows, one row each, which suits lists too long for one text;
    ``counters``: a one-row frame with the run's numbers. The reports are planned on first use."""

    timepoints: DataFrame
    _contested: Callable[[], DataFrame]
    _plan: _Plan
    _counters: Callable[[], DataFrame]

    @cached_property
    def duplicates(self) -> DataFrame:
        return _duplicates(self._contested(), self._plan)

    @cached_property
    def candidates(self) -> DataFrame:
        return _candidates(self._contested(), self._plan)

    @cached_property
    def counters(self) -> DataFrame:
        return self._counters()


@dataclass(frozen=True)
class _Plan:
    participant: str
    date: str
    schedule: Schedule
    rule: str
    days_per_year: float
    promote_from: float | None
    tiebreak: tuple[str, ...]

    @property
    def p(self) -> Column:
        return F.col(quoted(self.participant))

    @property
    def d(self) -> Column:
        return F.col(quoted(self.date))

    @property
    def visit_order(self) -> list[Column]:
        return [self.d.asc()] + [F.col(quoted(c)).asc_nulls_last() for c in self.tiebreak]

    @property
    def preference(self) -> list[Column]:
        """Order in which the visits of one window are preferred; T1 always keeps its first visit."""
        years = F.col("_years")
        if self.rule == "earliest":
            score = years
        elif self.rule == "closest":
            score = F.when(F.col("_tp") == 1, years).otherwise(
                F.abs(years - self.schedule.centre(F.col("_tp")))
            )
        else:
            score = F.when(F.col("_tp") == 1, years).otherwise(-years)
        return [score.asc(), years.asc(), *self.visit_order]


def assign_timepoints(
    df: DataFrame,
    *,
    participant_column: str = "Barcode",
    date_column: str = "AppointmentDate",
    scheme: str = "TLSA",
    custom_windows=None,
    collision_rule: str = "latest",
    days_per_year: float | None = None,
    max_timepoints: int | None = None,
    cohort_column: str = "",
    cohort_value: str = "",
    promote_late_baseline: bool = False,
    promote_window_fraction: float | None = None,
    drop_unassigned: bool = True,
    tolerance_years: float | None = None,
    date_format: str | None = None,
    tiebreak_columns: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> TimepointResult:
    """Map each dated visit to a study timepoint by its time since the participant's first visit.

    Collision rules: ``latest`` (also any unknown word), ``earliest``, ``closest``. Equal dates are
    ordered by ``tiebreak_columns`` (default: all other columns), so results are repeatable. The
    duplicate report has one row per collision; ``candidates`` lists the same visits one per row.
    """
    require_columns(df, [participant_column, date_column])
    schedule = build_schedule(scheme.strip(), custom_windows, int(max_timepoints or 20))
    if promote_late_baseline and schedule.repeat is None and len(schedule.windows) < 2:
        raise ValueError("promote_late_baseline needs a schedule with at least two windows")
    tolerance = 0.25 if tolerance_years is None else float(tolerance_years)
    cohort_column, cohort_value = cohort_column.strip(), cohort_value.strip()
    if cohort_column:
        if cohort_column not in df.columns:
            raise ValueError(f"Cohort column {cohort_column!r} not found in input")
        if cohort_value:
            df = df.filter(trimmed_equals(F.col(quoted(cohort_column)), cohort_value))

    if tiebreak_columns is not None:
        require_columns(df, tiebreak_columns)
    else:
        tiebreak_columns = [
            f.name
            for f in df.schema.fields
            if f.name not in (participant_column, date_column) and _orderable(f.dataType)
        ]
    fraction = float(promote_window_fraction or 0.95)
    plan = _Plan(
        participant_column,
        date_column,
        schedule,
        collision_rule.strip(),
        float(days_per_year or 365.25),
        schedule.windows[0].high * fraction if promote_late_baseline else None,
        tuple(tiebreak_columns),
    )

    parsed = df.withColumn(date_column, _parsed_date(df, date_column, date_format))
    dated = parsed.filter(plan.d.isNotNull())
    total = df.count()
    if total == 0:
        raise ValueError("No rows are left to assign")
    profile = profile_keys(dated, [participant_column], hot_rows)
    if profile.rows == 0:
        raise ValueError(f"Every row had a missing or unparseable {date_column}")
    if profile.missing:
        raise ValueError(f"{profile.missing} dated row(s) have no value in {participant_column!r}")

    if profile.hot is None:
        cold_flagged, hot_flagged = _by_windows(dated, plan), None
        flagged = cold_flagged
    else:
        hot, cold = split_hot(dated, [participant_column], profile.hot)
        cold_flagged, hot_flagged = _by_windows(cold, plan), _by_broadcast(with_row_ids(hot), plan)
        flagged = cold_flagged.unionByName(hot_flagged.drop("_row"))

    def contested() -> DataFrame:
        shown = [plan.p, plan.d, *[F.col(c) for c in ("_tp", "_n", "_kept", "_pos", "_years")]]
        found = _positions(cold_flagged, plan).select(*shown)
        if hot_flagged is None:
            return found
        return found.unionByName(_hot_positions(hot_flagged, profile.pieces, plan).select(*shown))

    output = _output(flagged, dated.columns, plan, tolerance)
    return TimepointResult(
        output.filter("is_selected_visit") if drop_unassigned else output,
        contested,
        plan,
        lambda: _counters(output, flagged, plan, drop_unassigned, total - profile.rows),
    )


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _parsed_date(df: DataFrame, name: str, date_format: str | None) -> Column:
    """Dates and timestamps as they are; text is parsed, unparseable text becomes NULL."""
    col = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col
    text = col.cast("string")
    if date_format:
        return F.try_to_timestamp(text, F.lit(date_format)).cast("timestamp_ntz")
    return text.try_cast("timestamp_ntz")


def _with_window_match(df: DataFrame, baseline: Column, plan: _Plan) -> DataFrame:
    """Adds _years, _tp and _in (has a timepoint).

    Filter on _in above a window, never on _tp: a filter on a partition key moves below the window,
    where the whole window match would be spelled out inside the filter condition.
    """
    days = whole_days(plan.d, baseline).cast("double")
    return (
        df.withColumn("_years", round_even(days / F.lit(plan.days_per_year), 2))
        .withColumn("_tp", plan.schedule.match(F.col("_years")))
        .withColumn("_in", F.col("_tp").isNotNull())
    )


def _promotable(plan: _Plan) -> Column:
    top = plan.schedule.windows[0].high
    inside = F.col("_years").between(F.lit(plan.promote_from), F.lit(top))
    return F.coalesce((F.col("_tp") == 1) & inside & ~F.col("_won"), F.lit(False))


def _by_windows(df: DataFrame, plan: _Plan) -> DataFrame:
    """Adds _won (wins its window) and _promoted; one shuffle on the participant."""
    whole = W.partitionBy(plan.p)
    contest = W.partitionBy(plan.p, F.col("_tp")).orderBy(*plan.preference)
    out = _with_window_match(df, F.min(plan.d).over(whole), plan)
    out = out.withColumn("_won", F.col("_in") & (F.row_number().over(contest) == 1))
    if plan.promote_from is None:
        return out.withColumn("_promoted", F.lit(False))
    latest_first = whole.orderBy(
        F.col("_candidate").desc(), F.col("_years").desc(), *plan.visit_order
    )
    return (
        out.withColumn("_candidate", _promotable(plan))
        .withColumn("_has_t2", F.max(F.coalesce(F.col("_tp") == 2, F.lit(False))).over(whole))
        .withColumn(
            "_promoted",
            F.col("_candidate") & ~F.col("_has_t2") & (F.row_number().over(latest_first) == 1),
        )
        .drop("_candidate", "_has_t2")
    )


def _by_broadcast(df: DataFrame, plan: _Plan) -> DataFrame:
    """The same columns for hot participants; ``df`` carries a materialised row id.

    Every side that is broadcast has at most one row per hot participant and timepoint. Windows see
    hot groups only under a top-1 filter, which keeps one row per group and task before the shuffle.
    """
    base = df.groupBy(plan.p).agg(F.min(plan.d).alias("_base"))
    out = _with_window_match(
        df.join(F.broadcast(base), plan.participant, "left"), F.col("_base"), plan
    ).drop("_base")
    contest = W.partitionBy(plan.p, F.col("_tp")).orderBy(*plan.preference, F.col("_row"))
    winners = (
        out.withColumn("_rank", F.row_number().over(contest))
        .filter((F.col("_rank") == 1) & F.col("_in"))
        .select(plan.p, "_tp", F.col("_row").alias("_winner"))
    )
    out = (
        out.join(F.broadcast(winners), [plan.participant, "_tp"], "left")
        .withColumn("_won", F.coalesce(F.col("_row") == F.col("_winner"), F.lit(False)))
        .drop("_winner")
    )
    if plan.promote_from is None:
        return out.withColumn("_promoted", F.lit(False))
    latest_first = W.partitionBy(plan.p).orderBy(
        F.col("_candidate").desc(), F.col("_years").desc(), *plan.visit_order, F.col("_row")
    )
    promoted = (
        out.withColumn("_candidate", _promotable(plan))
        .withColumn("_rank", F.row_number().over(latest_first))
        .filter((F.col("_rank") == 1) & F.col("_candidate"))
        .join(F.broadcast(winners.filter("_tp = 2")), plan.participant, "left_anti")
        .select(F.col("_row"), F.lit(True).alias("_promoted"))
    )
    return out.join(F.broadcast(promoted), "_row", "left").withColumn(
        "_promoted", F.coalesce("_promoted", F.lit(False))
    )


def _output(flagged: DataFrame, columns: list[str], plan: _Plan, tolerance: float) -> DataFrame:
    tp = F.when(F.col("_promoted"), F.lit(2)).otherwise(F.col("_tp"))
    deviation = round_even(F.col("_years") - plan.schedule.ideal(F.col("timepoint_index")), 2)
    return (
        flagged.withColumn("timepoint_index", tp.cast("bigint"))
        .withColumn("deviation_years", deviation)
        .select(
            *[quoted(c) for c in columns],
            F.col("_years").alias("years_from_baseline"),
            F.concat(F.lit("T"), F.col("timepoint_index").cast("string")).alias("timepoint"),
            (F.col("_won") | F.col("_promoted")).alias("is_selected_visit"),
            "timepoint_index",
            "deviation_years",
            (F.abs("deviation_years") <= F.lit(tolerance)).alias("within_tolerance"),
        )
    )


def _positions(flagged: DataFrame, plan: _Plan) -> DataFrame:
    """Contested visits with their position in the window's visit order."""
    group = W.partitionBy(plan.p, F.col("_tp"))
    return (
        flagged.withColumn("_n", F.count(F.lit(1)).over(group))
        .withColumn("_kept", F.max(F.when(F.col("_won"), F.col("_years"))).over(group))
        .withColumn("_pos", F.row_number().over(group.orderBy(*plan.visit_order)))
        .filter((F.col("_n") > 1) & F.col("_in"))
    )


def _hot_positions(flagged: DataFrame, pieces: int, plan: _Plan) -> DataFrame:
    """The same for hot participants: position inside a contiguous piece plus the rows before it."""
    group = [plan.p, F.col("_tp")]
    names = [plan.participant, "_tp"]
    facts = (
        flagged.groupBy(*group)
        .agg(
            F.count(F.when(F.col("_in"), 1)).alias("_n"),
            F.max(F.when(F.col("_won"), F.col("_years"))).alias("_kept"),
        )
        .filter("_n > 1")
    )
    cut = ordered_pieces(flagged, [*group, *plan.visit_order], pieces)
    # pieces are contiguous: at most (pieces + hot participants x timepoints) rows to broadcast
    before = W.partitionBy(*group).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*group, "_piece")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_done", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    inside = W.partitionBy("_piece", *group).orderBy(*plan.visit_order, F.col("_row"))
    return (
        cut.join(F.broadcast(facts), names)
        .join(F.broadcast(offsets), [*names, "_piece"])
        .withColumn("_pos", F.col("_done") + F.row_number().over(inside))
    )


def _candidates(contested: DataFrame, plan: _Plan) -> DataFrame:
    return contested.select(
        plan.p,
        F.concat(F.lit("T"), F.col("_tp").cast("string")).alias("timepoint"),
        F.col("_tp").cast("bigint").alias("timepoint_index"),
        F.col("_n").cast("bigint").alias("n_visits"),
        F.col("_pos").cast("bigint").alias("position"),
        F.format_string("%.2f", F.col("_years")).alias("candidate_years"),
        F.date_format(plan.d, "yyyy-MM-dd").alias("candidate_date"),
        F.col("_kept").alias("kept_years"),
    )


def _duplicates(contested: DataFrame, plan: _Plan) -> DataFrame:
    listing = "listagg({}, ', ') WITHIN GROUP (ORDER BY position)"
    lists = [listing.format("candidate_years"), listing.format("candidate_date")]
    grouped = _candidates(contested, plan).groupBy(plan.p, "timepoint", "timepoint_index", "n_visits", "kept_years")
    return grouped.agg(F.expr(lists[0]).alias("candidate_years"), F.expr(lists[1]).alias("candidate_dates")).select(
        plan.p, "timepoint", "timepoint_index", "n_visits", "candidate_years", "candidate_dates", "kept_years"
    )


def _counters(
    output: DataFrame, flagged: DataFrame, plan: _Plan, drop_unassigned: bool, undated: int
) -> DataFrame:
    def total(test: Column) -> Column:
        return F.coalesce(F.sum(test.cast("bigint")), F.lit(0).cast("bigint"))

    assigned, selected = F.col("timepoint").isNotNull(), F.col("is_selected_visit")
    emitted = selected if drop_unassigned else F.lit(True)
    crowds = (
        flagged.groupBy(plan.p, "_tp")
        .agg(F.count(F.when(F.col("_in"), 1)).alias("_n"))
        .filter("_n > 1")
        .groupBy(plan.p)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.struct(total(F.col("_n")).alias("all"), F.count(F.lit(1)).alias("people")))
        .scalar()
    )
    return output.agg(
        F.lit(undated).cast("bigint").alias("undated"),
        total(~assigned).alias("unassigned"),
        total(assigned & ~selected).alias("superseded"),
        total(emitted & (F.col("within_tolerance") == F.lit(False))).alias("off_schedule"),
    ).select("*", crowds["all"].alias("collisions"), crowds["people"].alias("collision_participants"))
