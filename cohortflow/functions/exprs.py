"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the spellings of a number that text columns may hold.
NUMBER_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))$"


def round_even(x: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: the rounding NumPy applies to doubles.

    Adding 0.0 turns a negative zero into a plain one.
    """
    scale = float(10**digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def numeric_text(x: Column) -> Column:
    """Text as double where it spells a number exactly, else NULL (NaN spellings stay NaN)."""
    return F.when(x.rlike(NUMBER_PATTERN), x.try_cast("double"))


def as_number(df: DataFrame, name: str) -> Column:
    """A column of any type as double; what is not a number (NaN included) becomes NULL."""
    dtype = df.schema[name].dataType
    col = F.col(quoted(name))
    if isinstance(dtype, T.StringType):
        return nan_to_null(numeric_text(F.trim(col)))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return nan_to_null(col.cast("double"))
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    return F.lit(None).cast("double")


def clean_double(df: DataFrame, name: str) -> Column:
    """A numeric column as double with NaN read as missing."""
    col = F.col(quoted(name)).cast("double")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return nan_to_null(col)
    return col


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def in_ranges(x: Column, ranges) -> Column:
    """Inside any of the inclusive ranges; NULL counts as outside."""
    hit = F.lit(False)
    for low, high in ranges:
        hit = hit | x.between(F.lit(float(low)), F.lit(float(high)))
    return F.coalesce(hit, F.lit(False))


def trimmed_equals(x: Column, value: str) -> Column:
    return F.coalesce(F.trim(x.cast("string")) == F.lit(value), F.lit(False))


def whole_days(later: Column, earlier: Column) -> Column:
    """Complete 24-hour days of a duration, which is not the calendar ``datediff``."""
    return F.extract(F.lit("DAY"), later - earlier)


def age_in_years(on: Column, born: Column) -> Column:
    """Completed years between two dates, counted on (month, day); symmetric for a swapped pair."""

    def completed(late: Column, early: Column) -> Column:
        before_birthday = F.struct(F.month(late), F.dayofmonth(late)) < F.struct(
            F.month(early), F.dayofmonth(early)
        )
        return F.year(late) - F.year(early) - before_birthday.cast("int")

    return F.when(on >= born, completed(on, born)).when(on < born, -completed(born, on))
