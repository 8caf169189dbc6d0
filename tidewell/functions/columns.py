"""Column expressions shared by the plans. All are built-in and codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division that yields NULL on a zero or NULL divisor, also under ANSI."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent(part: Column | str, whole: Column | str) -> Column:
    return F.try_divide(F.lit(100.0) * _col(part).cast("double"), _col(whole).cast("double"))


def mean(value: Column | str) -> Column:
    """AVG as an exact sum over a count: no decimal scale loss, no order dependence for decimals."""
    return ratio(F.sum(_col(value)), F.count(_col(value)))


def rounded(value: Column | str, digits: int = 2) -> Column:
    """Half-up rounding of a double as a person would do it.

    Doubles such as 1.005 sit just below the half, so they pass through six
    decimals first; values too large for that are rounded as they are.
    """
    value = _col(value)
    exact = F.round(value.try_cast("decimal(38,6)"), digits).cast("double")
    return F.coalesce(exact, F.round(value.cast("double"), digits))


def month_start(day: Column | str) -> Column:
    return F.trunc(_col(day), "month")


def month_gap(earlier: Column | str, later: Column | str) -> Column:
    """Calendar months between two month starts."""
    earlier, later = _col(earlier), _col(later)
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def weekday_number(day: Column | str) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(_col(day)) - 1


def ascending(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def descending(*names: str) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in names]


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows; the order must end in a unique key to be repeatable."""
    return df.orderBy(*order).limit(n)
