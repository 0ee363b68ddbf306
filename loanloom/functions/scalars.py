"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday numbers, Monday first.
WEEKDAY_NUMBERS = {
    "MONDAY": 0,
    "TUESDAY": 1,
    "WEDNESDAY": 2,
    "THURSDAY": 3,
    "FRIDAY": 4,
    "SATURDAY": 5,
    "SUNDAY": 6,
}


def as_double(column: Column) -> Column:
    return column.cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; a zero denominator gives NULL instead of an error."""
    return F.try_divide(as_double(numerator), as_double(denominator))


def zero_if_undefined(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def years_from_days(days: Column, days_per_year: float = 365.0) -> Column:
    return F.abs(days) / F.lit(days_per_year)


def weekday_number(name: Column) -> Column:
    """0 for Monday to 6 for Sunday; unknown or missing names give NULL."""
    pairs = [F.lit(x) for item in WEEKDAY_NUMBERS.items() for x in item]
    return F.element_at(F.create_map(*pairs), F.upper(name))


def cycle_angle(position: Column, period: int) -> Column:
    return F.lit(2.0) * F.pi() * as_double(position) / F.lit(float(period))


def row_mean(columns: list[Column]) -> Column:
    """Mean across columns of one row, missing values skipped."""
    return ratio(_row_sum(columns), _row_count(columns))


def row_std(columns: list[Column]) -> Column:
    """Sample deviation across columns of one row; NULL below two values."""
    mean = row_mean(columns)
    squares = [F.pow(as_double(c) - mean, F.lit(2.0)) for c in columns]
    count = _row_count(columns)
    return F.sqrt(F.when(count > 1, _row_sum(squares) / (count - 1)))


def row_null_count(columns: list[Column]) -> Column:
    return sum((c.isNull().cast("int") for c in columns), F.lit(0))


def _row_sum(columns: list[Column]) -> Column:
    return sum((F.coalesce(as_double(c), F.lit(0.0)) for c in columns), F.lit(0.0))


def _row_count(columns: list[Column]) -> Column:
    return sum((c.isNotNull().cast("int") for c in columns), F.lit(0))


def clip(column: Column, low, high) -> Column:
    """Limit to [low, high]; a missing value stays missing."""
    return F.when(
        column.isNotNull(), F.least(F.greatest(column, F.lit(low)), F.lit(high))
    )


def at_least(score: Column, threshold) -> Column:
    return (score >= threshold).cast("int")


def hash_order(identifier: Column, seed: int) -> Column:
    """A repeatable random-looking sort key for a row id."""
    return F.md5(F.concat_ws("-", identifier.cast("string"), F.lit(str(seed))))
