"""Money and ratio expressions with engine-independent exact semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed types of the star schema (DDL): price DECIMAL(10,2), amount DECIMAL(12,2).
PRICE_TYPE = "decimal(10,2)"
AMOUNT_TYPE = "decimal(12,2)"
# Aggregated money: Spark's own result type of SUM(decimal(12,2)).
SUM_TYPE = "decimal(22,2)"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price(c: str | Column) -> Column:
    """DECIMAL(10,2); a value that doesn't fit is NULL, never an error."""
    return _c(c).try_cast(PRICE_TYPE)


def line_total(quantity: str | Column, unit_price: str | Column) -> Column:
    """TotalAmount = quantity x price, kept at DECIMAL(12,2); NULL if it doesn't fit."""
    return (_c(quantity) * _c(unit_price)).try_cast(AMOUNT_TYPE)


def money_sum(c: str | Column) -> Column:
    return F.sum(_c(c)).cast(SUM_TYPE)


def exact_avg(total: str | Column, count: str | Column) -> Column:
    """Average as ``double(sum) / count`` - identical in every engine."""
    return _c(total).cast("double") / _c(count)


def pct_change(cur: str | Column, prev: str | Column) -> Column:
    """First period (no previous) -> 0.0; previous 0 -> NULL; else round((cur-prev)/prev*100, 2)."""
    c, p = _c(cur).cast("double"), _c(prev).cast("double")
    return F.when(_c(prev).isNull(), F.lit(0.0)).otherwise(
        F.round(F.try_divide(c - p, p) * 100.0, 2) + F.lit(0.0))


def pct_of(value: str | Column, base: str | Column) -> Column:
    return F.round(F.try_divide(_c(value).cast("double"), _c(base).cast("double")) * 100.0, 2) \
        + F.lit(0.0)
