"""Column functions: week calendar, guarded ratios, roundings. All are built-in expressions; no UDFs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BILLING_SHIFT_MONTHS, WEEKS_PER_MONTH, WEEKS_PER_YEAR


def week_part(week: Column | str, index: int) -> Column:
    """Year (0) or week number (1) of a ``YYYY-WW`` string; null where it isn't one (never an error)."""
    part = F.get(F.split(week, "-"), F.lit(index))
    return F.when(part.rlike("^[0-9]+$"), part).try_cast("int")


def add_time_columns(df: DataFrame, week: str = "semaine") -> DataFrame:
    """Adds ``annee``, ``num_sem`` and the sortable ``week_id`` = 100 annee + num_sem."""
    year, number = week_part(week, 0), week_part(week, 1)
    return df.withColumns({"annee": year, "num_sem": number, "week_id": year * 100 + number})


def week_string(year: Column, number: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(number.cast("string"), 2, "0"))


def week_minus_years(week: Column | str, years: int) -> Column:
    """The same week number, ``years`` earlier; the number is carried over as written."""
    return F.concat((week_part(week, 0) - years).cast("string"), F.lit("-"), F.get(F.split(week, "-"), F.lit(1)))


def week_plus_years(year: Column, number: Column, years: int = 1) -> Column:
    return week_string(year + years, number)


def month_of_week(number: Column) -> Column:
    """Calendar month that a week number falls in, 1 to 12; a null week counts as month 1."""
    return F.least(F.lit(12), F.greatest(F.lit(1), F.ceil(number / WEEKS_PER_MONTH))).cast("int")


def shifted_month(year: Column, month: Column, by: int = BILLING_SHIFT_MONTHS) -> tuple[Column, Column]:
    """(year, month) ``by`` months later."""
    months = month - 1 + by
    return (year + F.floor(months / 12)).cast("int"), (F.pmod(months, F.lit(12)) + 1).cast("int")


def cyclic(number: Column) -> tuple[Column, Column]:
    angle = 2 * math.pi * number / WEEKS_PER_YEAR  # fixed: a year of 52 weeks
    return F.sin(angle), F.cos(angle)


def flag(condition: Column) -> Column:
    return condition.cast("tinyint")


def is_summer(number: Column) -> Column:
    return flag(number.between(30, 35))


def is_christmas(number: Column) -> Column:
    return flag((number >= 50) | (number == 1))


def guarded_ratio(a: Column, b: Column, offset: float = 0.0) -> Column:
    """a / (b + offset); null where b is null or 0."""
    return F.when(b != 0, a / (b + F.lit(offset)))


def clamped_trend(recent: Column, before: Column, limit: float = 5.0, offset: float = 1.0) -> Column:
    """(recent - before) / (before + offset) within +-limit; null without ``before``, -limit if only ``recent`` is missing.

    ``before`` = -offset would divide by zero; the change then counts as missing.
    """
    change = F.try_divide(recent - before, before + offset)
    return F.when(before.isNotNull(), F.least(F.greatest(change, F.lit(-limit)), F.lit(limit)))


def zero_indicator(y: Column) -> Column:
    """1.0 where y is 0, else 0.0; unknown counts as not zero."""
    return F.coalesce((y == 0).cast("double"), F.lit(0.0))


def nonneg_round(x: Column) -> Column:
    """Half-up rounding, at least 0, as long; null gives 0."""
    return F.greatest(F.round(x), F.lit(0.0)).cast("long")


def nonneg_round_even(x: Column) -> Column:
    """Half-even rounding, at least 0, as long."""
    return F.greatest(F.bround(x, 0), F.lit(0.0)).cast("long")


def first_column(df: DataFrame, *names: str, default=None) -> Column:
    """The first of ``names`` that ``df`` has, else a constant."""
    return next((F.col(n) for n in names if n in df.columns), F.lit(default))


def typed_nulls(kinds: dict[str, str]) -> dict[str, Column]:
    return {name: F.lit(None).cast(kind) for name, kind in kinds.items()}


def with_missing(df: DataFrame, names: list[str], kind: str = "double") -> DataFrame:
    """Columns of ``names`` that ``df`` lacks, as nulls."""
    lacking = {n: kind for n in names if n not in df.columns}
    return df.withColumns(typed_nulls(lacking)) if lacking else df


def drop_columns_if_exist(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)
