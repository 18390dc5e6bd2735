"""Generic OLAP operators used by the reports.

Each takes DataFrames and column names, returns a DataFrame, and stays in built-in
Spark expressions. Scale notes are on each operator.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def standard_measures(amount: str = "total_amount", quantity: str = "quantity", *,
                      total: str | None = None, qty: str | None = None,
                      count: str | None = None, avg: str | None = None,
                      distinct: tuple[str, str] | None = None) -> list[Column]:
    """The measure set of the reports: money sum (DECIMAL(22,2)), quantity sum (BIGINT),
    COUNT(*), exact average and an exact COUNT(DISTINCT)."""
    out: list[Column] = []
    if total:
        out.append(money.money_sum(amount).alias(total))
    if qty:
        out.append(F.sum(quantity).cast("long").alias(qty))
    if count:
        out.append(F.count(F.lit(1)).alias(count))
    if avg:
        out.append(money.exact_avg(F.sum(amount), F.count(F.lit(1))).alias(avg))
    if distinct:
        col, name = distinct
        out.append(F.countDistinct(col).alias(name))
    return out


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """Global top-k with a full tie-breaker list. ``orderBy().limit()`` plans as
    ``TakeOrderedAndProject``: each task keeps k rows, no global sort of the input."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], k: int,
                    order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """Per-group top-k: ``row_number() over (partition by group order by ...) <= k``.
    Spark plans this as a WindowGroupLimit below the shuffle, so each task forwards
    at most k rows per group."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def period_growth(df: DataFrame, partition: Sequence[str], order: Sequence[str],
                  value: str, prev_name: str, growth_name: str) -> DataFrame:
    """Previous *existing* period within ``partition`` (gaps skipped) and the growth
    percentage: first period 0, previous 0 -> NULL, else round((cur-prev)/prev*100, 2).

    ``df`` is already aggregated to one row per period, so the window's partitions hold
    one row per period (bounded by the calendar), never raw fact rows.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    out = df.withColumn(prev_name, F.lag(value).over(w))
    return out.withColumn(growth_name, money.pct_change(value, prev_name))


def revenue_spikes(daily: DataFrame, key: str, value: str, factor: int = 2,
                   avg_name: str = "avg_daily_sales") -> DataFrame:
    """Rows whose ``value`` exceeds ``factor`` x the mean of ``value`` over ``key``.

    The threshold is evaluated exactly: ``value * n > factor * total`` on decimals
    (mean = total / n), so rows at exactly ``factor`` x the mean never flip with the
    summation order. ``daily`` has one row per (key, day): the window's group size is
    bounded by the number of days, not by fact rows.
    """
    w = Window.partitionBy(key)
    with_stats = (daily
                  .withColumn("_total", F.sum(value).over(w))
                  .withColumn("_n", F.count(value).over(w)))  # AVG skips NULLs
    spikes = with_stats.filter(F.col(value) * F.col("_n") > F.lit(factor) * F.col("_total"))
    return (spikes
            .withColumn(avg_name, money.exact_avg("_total", "_n"))
            .drop("_total", "_n"))


def basket_pairs(lines: DataFrame, basket: Sequence[str], item: str, amount: str,
                 first: str = "item1", second: str = "item2",
                 freq: str = "frequency", revenue: str = "combined_revenue") -> DataFrame:
    """Co-purchase pairs: for every basket and every two lines with ``item`` a < b,
    COUNT(*) and SUM(amount_a + amount_b), grouped by (a, b).

    Lines are first collapsed to one row per (basket, item) carrying the line count
    and amount sum, so a basket that repeats an item contributes ``n_a * n_b`` pairs
    without materialising them:
        frequency        = sum(n_a * n_b)
        combined_revenue = sum(s_a * n_b + s_b * n_a)
    The pair step is an equi-join on the basket key with a residual ``a < b``
    (no cross join); AQE's skew-join split spreads an oversized basket over tasks.
    """
    per_item = (lines.groupBy(*basket, item)
                .agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_s")))
    a = per_item.select(*[F.col(b).alias(f"_a_{b}") for b in basket],
                        F.col(item).alias(first), F.col("_n").alias("_na"),
                        F.col("_s").alias("_sa"))
    b = per_item.select(*[F.col(b).alias(f"_b_{b}") for b in basket],
                        F.col(item).alias(second), F.col("_n").alias("_nb"),
                        F.col("_s").alias("_sb"))
    cond = [F.col(f"_a_{k}") == F.col(f"_b_{k}") for k in basket]
    cond.append(F.col(first) < F.col(second))
    pairs = a.join(b, cond)
    return pairs.groupBy(first, second).agg(
        F.sum(F.col("_na") * F.col("_nb")).alias(freq),
        F.sum(F.col("_sa") * F.col("_nb") + F.col("_sb") * F.col("_na"))
        .cast(money.SUM_TYPE).alias(revenue))


def rollup_report(df: DataFrame, levels: Sequence[str], aggs: dict[str, tuple[str, str]],
                  grouping_name: str = "grouping_id") -> DataFrame:
    """ROLLUP(levels) with additive measures.

    Aggregated once at the finest grain (partial + final, one shuffle); each coarser level is
    then added up from the level below it, so no row is expanded into all levels and the
    finest grain's exchange is shared. ``grouping_id`` (0, 1, 3, 7, ...) separates
    subtotal NULLs from data NULLs. ``aggs`` maps output name -> (input column, kind)
    where kind is ``sum_money``, ``sum`` or ``count``.
    """
    fine_aggs = []
    for name, (col, kind) in aggs.items():
        if kind == "count":
            fine_aggs.append(F.count(F.lit(1)).alias(name))
        elif kind == "sum_money":
            fine_aggs.append(money.money_sum(col).alias(name))
        else:
            fine_aggs.append(F.sum(col).alias(name))
    level = df.groupBy(*levels).agg(*fine_aggs)
    names = list(levels)
    parts = [level.withColumn(grouping_name, F.lit(0))]
    for depth in range(1, len(names) + 1):
        # a level is added up from the one below, whose rows are far fewer than the finest
        up = [(F.sum(name).cast(money.SUM_TYPE) if kind == "sum_money" else F.sum(name).cast("long")).alias(name)
              for name, (_, kind) in aggs.items()]
        level = level.groupBy(*names[:len(names) - depth]).agg(*up)
        parts.append(level.select("*", *[F.lit(None).cast(df.schema[n].dataType).alias(n) for n in names[len(names) - depth:]],
                                  F.lit((1 << depth) - 1).alias(grouping_name)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*names, grouping_name, *[
        F.col(name).cast(money.SUM_TYPE if kind == "sum_money" else "long").alias(name) for name, (_, kind) in aggs.items()])


def half_year_pivot(df: DataFrame, keys: Sequence[str], month: str, amount: str,
                    quantity: str) -> DataFrame:
    """H1 (months 1-6) / H2 (7-12) revenue and volume plus the yearly totals, one pass
    (conditional sums; no pivot shuffle)."""
    h1 = F.col(month) <= 6
    zero_amt = F.lit(0).cast(money.AMOUNT_TYPE)
    return df.groupBy(*keys).agg(
        money.money_sum(F.when(h1, F.col(amount)).otherwise(zero_amt)).alias("h1_revenue"),
        F.sum(F.when(h1, F.col(quantity)).otherwise(F.lit(0))).cast("long").alias("h1_quantity"),
        money.money_sum(F.when(~h1, F.col(amount)).otherwise(zero_amt)).alias("h2_revenue"),
        F.sum(F.when(~h1, F.col(quantity)).otherwise(F.lit(0))).cast("long").alias("h2_quantity"),
        money.money_sum(amount).alias("yearly_revenue"),
        F.sum(quantity).cast("long").alias("yearly_quantity"),
    )


def slice_dice(df: DataFrame, filters: dict[str, object], keys: Sequence[str],
               amount: str = "total_amount") -> DataFrame:
    """Filter any attributes to given values (a value or a list), group by any others."""
    for col, val in filters.items():
        if isinstance(val, (list, tuple, set)):
            df = df.filter(F.col(col).isin(*list(val)))
        else:
            df = df.filter(F.col(col) == F.lit(val))
    return df.groupBy(*keys).agg(
        money.money_sum(amount).alias("total_revenue"),
        F.count(F.lit(1)).alias("transaction_count"))
