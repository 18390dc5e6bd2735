"""Calendar expressions for the time dimension and for date filters.

Everything is a built-in Spark expression (codegen, no Python in the hot path).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's calendar rules:
#   season by month: 12, 1, 2 -> Winter; 3, 4, 5 -> Spring; 6, 7, 8 -> Summer; otherwise Fall
#   quarter = (month - 1) // 3 + 1
#   day_of_week: 0 = Monday ... 6 = Sunday; weekend when day_of_week >= 5
WINTER_MONTHS = (12, 1, 2)
SPRING_MONTHS = (3, 4, 5)
SUMMER_MONTHS = (6, 7, 8)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def season(date: str | Column) -> Column:
    m = F.month(_c(date))
    return (F.when(m.isin(*WINTER_MONTHS), F.lit("Winter"))
            .when(m.isin(*SPRING_MONTHS), F.lit("Spring"))
            .when(m.isin(*SUMMER_MONTHS), F.lit("Summer"))
            .otherwise(F.lit("Fall")))


def day_of_week(date: str | Column) -> Column:
    """0 = Monday ... 6 = Sunday (``weekday``, not ``dayofweek``)."""
    return F.weekday(_c(date))


def is_weekend(date: str | Column) -> Column:
    return F.when(F.weekday(_c(date)) >= 5, F.lit(1)).otherwise(F.lit(0))


def day_type(date: str | Column) -> Column:
    return F.when(F.weekday(_c(date)) >= 5, F.lit("Weekend")).otherwise(F.lit("Weekday"))


def date_sk(date: str | Column) -> Column:
    """Smart date key yyyymmdd: stable across batches, needs no numbering pass."""
    d = _c(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_attributes(date: str | Column, holidays: Column | None = None) -> dict[str, Column]:
    """Time-dimension attributes of a date column, by DIM_TIME column name."""
    d = _c(date)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
        "day": F.dayofmonth(d),
        "day_of_week": day_of_week(d),
        "day_name": F.date_format(d, "EEEE"),
        "week_of_year": F.weekofyear(d),
        "season": season(d),
        "is_weekend": is_weekend(d),
        "is_holiday": (holidays if holidays is not None else F.lit(0)).cast("int"),
    }


def calendar_columns(date: str | Column, holidays: Column | None = None) -> list[Column]:
    """All DIM_TIME columns of a date column: date_sk, transaction_date and attributes."""
    d = _c(date)
    attrs = calendar_attributes(d, holidays)
    return [date_sk(d).alias("date_sk"), d.alias("transaction_date")] + [
        c.alias(n) for n, c in attrs.items()]


def parse_date(text: str | Column) -> Column:
    """``%Y-%m-%d`` with unpadded month/day accepted; bad text gives NULL (ANSI-safe)."""
    return F.try_to_date(F.trim(_c(text)), "yyyy-M-d")


def as_date(value: str | _dt.date | None) -> _dt.date:
    if value is None:
        return _dt.date.today()
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


def year_range(year: int) -> tuple[_dt.date, _dt.date]:
    """[Jan 1, next Jan 1): a range predicate pushes to Parquet where ``year(d) = y`` does not."""
    return _dt.date(year, 1, 1), _dt.date(year + 1, 1, 1)


def months_back_start(as_of: _dt.date, months: int) -> _dt.date:
    """First day of the month ``months`` boundaries before ``as_of``'s month.

    ``DATEDIFF(MONTH, d, as_of) <= months`` counts month boundaries, i.e.
    ``(y(as_of)*12 + m(as_of)) - (y(d)*12 + m(d)) <= months``, which is exactly
    ``d >= months_back_start(as_of, months)`` (future dates also pass).
    """
    idx = as_of.year * 12 + (as_of.month - 1) - months
    return _dt.date(idx // 12, idx % 12 + 1, 1)


def month_boundaries_between(start: str | Column, end: str | Column) -> Column:
    """Number of month boundaries crossed from ``start`` to ``end`` (T-SQL DATEDIFF(MONTH))."""
    s, e = _c(start), _c(end)
    return (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))
