"""Calendar flags and the seasonal demand factors of the sales model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnLike, col

# Fixed values of the demand model.
YEAR_END_FACTOR = 1.3
SUMMER_FACTOR = 1.1
WEEKEND_FACTOR = 1.35
FESTIVAL_FACTOR = 1.2
FESTIVAL_FIRST_DAY = 20


def day_of_week(day: ColumnLike) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(col(day))


def is_weekend(day: ColumnLike) -> Column:
    return (F.weekday(col(day)) >= 5).cast("int")


def festival(day: ColumnLike, months: tuple[int, ...] = (10, 12)) -> Column:
    """1 from the 20th on in the festival months."""
    d = col(day)
    return (F.month(d).isin(*months) & (F.dayofmonth(d) >= FESTIVAL_FIRST_DAY)).cast("int")


def month_factor(day: ColumnLike) -> Column:
    m = F.month(col(day))
    return (
        F.when(m.isin(11, 12), F.lit(YEAR_END_FACTOR))
        .when(m.isin(6, 7, 8), F.lit(SUMMER_FACTOR))
        .otherwise(F.lit(1.0))
    )


def weekend_factor(day: ColumnLike) -> Column:
    return F.when(F.weekday(col(day)) >= 5, F.lit(WEEKEND_FACTOR)).otherwise(F.lit(1.0))


def festival_factor(day: ColumnLike, months: tuple[int, ...] = (10, 12)) -> Column:
    return F.when(festival(day, months) == 1, F.lit(FESTIVAL_FACTOR)).otherwise(F.lit(1.0))


def season_factor(day: ColumnLike, festival_months: tuple[int, ...] = (10, 12)) -> Column:
    """Month, weekend and festival effects multiplied."""
    return month_factor(day) * weekend_factor(day) * festival_factor(day, festival_months)
