"""The analytical reports Q1-Q20 and the two validation queries, over any ``Star``.

Conventions shared with the SQL oracle:
* money sums are DECIMAL(22,2), quantity sums BIGINT, averages ``double(sum)/count``;
* growth / percent columns are doubles rounded to 2 places;
* ``GETDATE()`` is replaced by an explicit ``as_of`` date; "current year" becomes a
  [Jan 1, next Jan 1) range on the transaction date so that it reaches the scan;
* TOP-k orders carry a full tie-breaker (measure desc, second measure desc, keys asc).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import money
from ..operators import olap
from ..streaming import distincts
from .star import Star

DEFAULT_K = 5


def _day_type() -> F.Column:
    return F.when(F.col("is_weekend") == 1, F.lit("Weekend")).otherwise(F.lit("Weekday"))


def _current_year(as_of) -> tuple[_dt.date, _dt.date]:
    return cal.year_range(cal.as_date(as_of).year)


def _per_customer(star: Star, other_dims: tuple[str, ...], other_keys: list[str],
                  cust_attrs: list[str], period=None) -> DataFrame:
    """Eager aggregation before the customer join: additive partials per
    (customer_sk, other_keys), then the customer attributes. The join shuffles the
    pre-aggregated rows instead of fact rows, and because every customer has one set of
    attributes, COUNT(DISTINCT customer_sk) over the result is an exact COUNT(*)."""
    s = star.joined(*other_dims, period=period)
    if "day_type" in other_keys:
        s = s.withColumn("day_type", _day_type())
    per = s.groupBy("customer_sk", *other_keys).agg(
        F.sum("total_amount").alias("_s"), F.sum("quantity").alias("_q"),
        F.count(F.lit(1)).alias("_n"))
    cust = star.dim("customer").select("customer_sk", *cust_attrs)
    return per.join(cust, "customer_sk")


def _per_product(star: Star, keys: list[str], attrs: list[str], period=None) -> DataFrame:
    """Eager aggregation before the product join: additive partials per (product_sk,
    keys), then the product attributes, so only partials meet the product table."""
    s = star.joined("time", period=period)
    if "day_type" in keys:
        s = s.withColumn("day_type", _day_type())
    per = s.groupBy("product_sk", *keys).agg(
        F.sum("total_amount").alias("_s"), F.sum("quantity").alias("_q"),
        F.count(F.lit(1)).alias("_n"))
    return per.join(star.dim("product").select("product_sk", *attrs), "product_sk")


#: Rows that a task is to sum at once, about, where sums are nearly as many as rows.
TASK_ROWS = 1_000_000


def _dealt(star: Star, df: DataFrame, *by: str) -> DataFrame:
    """``df`` dealt to tasks by its group keys, more of them the more sales there are, where the
    session's shuffle partitions would get over ``TASK_ROWS`` each: behind it a task's sums are
    bounded, and the task before it, which may sort for a join, holds none."""
    tasks = _tasks(star)
    return df.repartition(tasks, *by) if tasks else df


def _ordered(star: Star, df: DataFrame, *by: F.Column) -> DataFrame:
    """``df`` in a total order, by more tasks where ``_dealt`` takes more."""
    tasks = _tasks(star)
    return df.repartitionByRange(tasks, *by).sortWithinPartitions(*by) if tasks else df.orderBy(*by)


def _tasks(star: Star) -> int:
    tasks = -(-star.sales() // TASK_ROWS)
    return tasks if tasks > int(star.spark.conf.get("spark.sql.shuffle.partitions")) else 0


def _per_keys(star: Star, keys: list[str]) -> DataFrame:
    """The fact summed to its surrogate keys (and the sale year if asked for), before any
    dimension joins it."""
    fact = star.fact()
    if "year" in keys:
        fact = fact.withColumn("year", F.year("transaction_date"))
    return _dealt(star, fact, *keys).groupBy(*keys).agg(
        F.sum("total_amount").alias("_s"), F.sum("quantity").alias("_q"),
        F.count(F.lit(1)).alias("_n"))


def _merge(df: DataFrame, keys: list[str], *, total: str | None = None,
           qty: str | None = None, count: str | None = None, avg: str | None = None,
           customers: str | None = None) -> DataFrame:
    """Final aggregate over ``_per_customer`` partials (same measures as
    ``olap.standard_measures``; ``customers`` = exact distinct customer count)."""
    aggs = []
    if total:
        aggs.append(F.sum("_s").cast(money.SUM_TYPE).alias(total))
    if qty:
        aggs.append(F.sum("_q").cast("long").alias(qty))
    if count:
        aggs.append(F.sum("_n").cast("long").alias(count))
    if avg:
        aggs.append(money.exact_avg(F.sum("_s"), F.sum("_n")).alias(avg))
    if customers:
        aggs.append(F.count(F.lit(1)).alias(customers))
    return df.groupBy(*keys).agg(*aggs)


def _by_customers(star: Star, cube: str) -> DataFrame:
    """One row per cell of a cube with ``_s``, ``_q``, ``_n`` and the exact number of customers:
    from the bitmaps that the loads keep where the star has them, else from the fact,
    reduced to one row per customer (and category and season) before the customer join, so
    that COUNT(DISTINCT customer) is a COUNT(*)."""
    kept = star.customer_cube(cube)
    if kept is not None:
        return kept
    keys = distincts.CUBES[cube]
    of_sale = [k for k in keys if k in distincts.OF_SALE]
    dims = tuple({"product_category": "product", "season": "time"}[k] for k in of_sale)
    per = _per_customer(star, dims, of_sale, [k for k in keys if k not in of_sale])
    return per.groupBy(*keys).agg(F.sum("_s").alias("_s"), F.sum("_q").alias("_q"), F.sum("_n").alias("_n"),
                                  F.count(F.lit(1)).alias("customers"))


# ---------------------------------------------------------------- Q1
def q01_top_products_daytype(star: Star, k: int = DEFAULT_K) -> DataFrame:
    attrs = ["product_category", "product_id", "price"]
    keys = ["day_type", "year", "month"]
    # one row per product and period already: a product_sk has one product_id
    g = _per_product(star, keys, attrs).select(
        *attrs, *keys, F.col("_s").cast(money.SUM_TYPE).alias("total_revenue"),
        F.col("_n").alias("transaction_count"))
    return olap.top_k(g, k, [F.col("total_revenue").desc(), F.col("transaction_count").desc(),
                             "product_category", "product_id", "price", "day_type", "year",
                             "month"])


def q01_top_per_daytype(star: Star, k: int = DEFAULT_K) -> DataFrame:
    """Title intent of Q1/Q11: top-k products within each day type and month."""
    keys = ["day_type", "year", "month"]
    g = _per_product(star, keys, ["product_id", "product_category"]).select(
        *keys, "product_id", "product_category",
        F.col("_s").cast(money.SUM_TYPE).alias("total_revenue"),
        F.col("_n").alias("transaction_count"))
    return olap.top_k_per_group(
        g, keys, k, [F.col("total_revenue").desc(), F.col("transaction_count").desc(),
                     "product_id"])


# ---------------------------------------------------------------- Q2
def q02_customer_demographics(star: Star) -> DataFrame:
    """The fact is reduced to one row per customer before the customer join, so the join (and
    its shuffle) is customer-sized, not fact-sized; or nothing but bitmaps is read."""
    out = _by_customers(star, "demographics").select(
        "gender", "age_group", "city_category", F.col("customers").alias("customer_count"),
        F.col("_s").cast(money.SUM_TYPE).alias("total_purchase_amount"),
        money.exact_avg("_s", "_n").alias("avg_purchase_amount"), F.col("_n").alias("transaction_count"))
    return out.orderBy(F.col("total_purchase_amount").desc(), "gender", "age_group",
                       "city_category")


# ---------------------------------------------------------------- Q3
def q03_category_by_occupation(star: Star) -> DataFrame:
    out = _by_customers(star, "occupation").select(
        "occupation", "product_category", F.col("_q").cast("long").alias("total_quantity"),
        F.col("_s").cast(money.SUM_TYPE).alias("total_sales"),
        money.exact_avg("_s", "_n").alias("avg_sale_value"), F.col("customers").alias("customer_count"))
    return out.orderBy(F.col("total_sales").desc(), "occupation", "product_category")


# ---------------------------------------------------------------- Q4
def q04_gender_age_quarterly(star: Star, as_of=None) -> DataFrame:
    j = _per_customer(star, ("time",), ["year", "quarter"], ["gender", "age_group"],
                      period=_current_year(as_of))
    out = _merge(j, ["gender", "age_group", "year", "quarter"], qty="total_quantity",
                 total="total_purchase_amount", avg="avg_purchase_amount",
                 count="transaction_count")
    return out.orderBy("year", "quarter", "gender", "age_group")


# ---------------------------------------------------------------- Q5
def q05_top_occupations(star: Star, k: int = DEFAULT_K) -> DataFrame:
    j = _per_customer(star, ("product",), ["product_category"], ["occupation"])
    g = _merge(j, ["occupation", "product_category"], total="total_sales",
               count="transaction_count", avg="avg_sale_value")
    return olap.top_k(g, k, [F.col("total_sales").desc(), F.col("transaction_count").desc(),
                             "occupation", "product_category"])


# ---------------------------------------------------------------- Q6
def q06_city_marital_monthly(star: Star, as_of=None, months: int = 6) -> DataFrame:
    """``DATEDIFF(MONTH, d, as_of) <= months`` == ``d >= first day of (as_of month - months)``;
    later dates pass too, as in the original predicate."""
    start = cal.months_back_start(cal.as_date(as_of), months)
    j = _per_customer(star, ("time",), ["year", "month"], ["city_category", "marital_status"],
                      period=(start, _dt.date(9999, 12, 31)))
    out = _merge(j, ["city_category", "marital_status", "year", "month"],
                 total="total_purchase_amount", count="transaction_count",
                 avg="avg_purchase_amount")
    return out.orderBy(F.col("year").desc(), F.col("month").desc(),
                       F.col("total_purchase_amount").desc(), "city_category", "marital_status")


# ---------------------------------------------------------------- Q7
def q07_stay_duration_gender(star: Star) -> DataFrame:
    """Customer-only attributes, as in Q2."""
    out = _by_customers(star, "stay").select(
        F.col("stay_in_current_city_years").alias("stay_duration_years"), "gender",
        F.col("customers").alias("customer_count"), money.exact_avg("_s", "_n").alias("avg_purchase_amount"),
        F.col("_s").cast(money.SUM_TYPE).alias("total_amount"), F.col("_n").alias("transaction_count"))
    return out.orderBy("stay_duration_years", "gender")


# ---------------------------------------------------------------- Q8
def q08_top_cities_category(star: Star, k: int = DEFAULT_K) -> DataFrame:
    g = _by_customers(star, "city").select(
        "city_category", "product_category", F.col("_s").cast(money.SUM_TYPE).alias("total_revenue"),
        F.col("_q").cast("long").alias("total_quantity"), F.col("customers").alias("unique_customers"),
        money.exact_avg("_s", "_n").alias("avg_sale_value"))
    return olap.top_k(g, k, [F.col("total_revenue").desc(), F.col("total_quantity").desc(),
                             "city_category", "product_category"])


# ---------------------------------------------------------------- Q9
def q09_monthly_growth(star: Star, as_of=None) -> DataFrame:
    j = _per_product(star, ["year", "month"], ["product_category"], _current_year(as_of))
    monthly = _merge(j, ["product_category", "year", "month"], total="monthly_sales")
    out = olap.period_growth(monthly, ["product_category"], ["year", "month"], "monthly_sales",
                             "previous_monthly_sales", "growth_percentage")
    return out.orderBy("year", "month", "product_category")


# ---------------------------------------------------------------- Q10
def q10_weekend_weekday_age(star: Star, as_of=None) -> DataFrame:
    j = _per_customer(star, ("time",), ["day_type"], ["age_group"],
                      period=_current_year(as_of))
    out = _merge(j, ["age_group", "day_type"], total="total_sales", count="transaction_count",
                 avg="avg_sale_value", qty="total_quantity")
    return out.orderBy("age_group", "day_type")


# ---------------------------------------------------------------- Q11
def q11_top_products_year(star: Star, year: int = 2017, k: int = DEFAULT_K) -> DataFrame:
    keys = ["day_type", "year", "month"]
    g = _per_product(star, keys, ["product_id", "product_category"], cal.year_range(year)).select(
        "product_id", "product_category", *keys,
        F.col("_s").cast(money.SUM_TYPE).alias("total_revenue"),
        F.col("_q").cast("long").alias("total_quantity"), F.col("_n").alias("transaction_count"))
    return olap.top_k(g, k, [F.col("total_revenue").desc(), F.col("total_quantity").desc(),
                             "product_id", "product_category", "day_type", "year", "month"])


# ---------------------------------------------------------------- Q12
def q12_store_quarter_growth(star: Star, year: int = 2017) -> DataFrame:
    s = star.joined("store", "time", period=cal.year_range(year))
    q = s.groupBy("store_id", "store_name", "quarter").agg(
        money.money_sum("total_amount").alias("quarterly_revenue"))
    out = olap.period_growth(q, ["store_id"], ["quarter"], "quarterly_revenue",
                             "previous_quarter_revenue", "growth_rate")
    return out.orderBy("store_id", "quarter")


# ---------------------------------------------------------------- Q13
def q13_supplier_contribution(star: Star) -> DataFrame:
    """Summed by surrogate keys first; names are not unique, so the partials are summed
    again after the joins."""
    per = _per_keys(star, ["store_sk", "supplier_sk", "product_sk"])
    j = (per.join(star.dim("product").select("product_sk", "product_id", "product_category"),
                  "product_sk")
         .join(star.dim("supplier").select("supplier_sk", "supplier_name"), "supplier_sk")
         .join(star.dim("store").select("store_sk", "store_name"), "store_sk"))
    names = ["store_name", "supplier_name", "product_id", "product_category"]
    out = _merge(_dealt(star, j, *names), names,
                 qty="total_quantity", total="total_sales", avg="avg_sale_value",
                 count="transaction_count")
    return _ordered(star, out, *[F.col(n) for n in names])


# ---------------------------------------------------------------- Q14
def q14_seasonal_category(star: Star) -> DataFrame:
    """The customer join (inner, as in the original) meets per-customer partials of each
    (category, season), not fact lines."""
    out = _by_customers(star, "season").select(
        "product_category", "season", F.col("_q").cast("long").alias("total_quantity"),
        F.col("_s").cast(money.SUM_TYPE).alias("total_sales"), money.exact_avg("_s", "_n").alias("avg_sale_value"),
        F.col("customers").alias("unique_customers"), F.col("_n").alias("transaction_count"))
    return out.orderBy("product_category", "season")


# ---------------------------------------------------------------- Q15
def q15_store_supplier_volatility(star: Star) -> DataFrame:
    """Eager aggregation before the supplier join: monthly sums per (store, supplier_sk)
    first, then supplier ids/names for those rows only (supplier_sk -> id, name is 1:1),
    so the supplier dimension meets monthly rows, not fact lines."""
    s = star.joined("store", "time")
    monthly = s.groupBy("store_id", "store_name", "supplier_sk", "year", "month").agg(
        money.money_sum("total_amount").alias("monthly_revenue"))
    sup = star.dim("supplier").select("supplier_sk", "supplier_id", "supplier_name")
    m = monthly.join(sup, "supplier_sk").drop("supplier_sk")
    out = olap.period_growth(m, ["store_id", "supplier_id"], ["year", "month"],
                             "monthly_revenue", "previous_month_revenue",
                             "volatility_percentage")
    return out.orderBy("store_id", "supplier_id", "year", "month")


# ---------------------------------------------------------------- Q16
def q16_product_affinity(star: Star, k: int = DEFAULT_K) -> DataFrame:
    """Pairs of products bought in one order by one customer. Product attributes are
    looked up only for the k winning pairs (product_id -> category is functional). Lines
    without an order id (a file without that column) are no basket: all history of a
    customer would be one."""
    lines = star.joined().where(F.col("order_id") != "") \
        .select("order_id", "customer_sk", "product_sk", "total_amount")
    pairs = olap.basket_pairs(lines, ["order_id", "customer_sk"], "product_sk", "total_amount",
                              first="p1_sk", second="p2_sk",
                              freq="frequency_purchased_together", revenue="combined_revenue")
    top = olap.top_k(pairs, k, [F.col("frequency_purchased_together").desc(),
                                F.col("combined_revenue").desc(), "p1_sk", "p2_sk"])
    prod = star.dim("product").select("product_sk", "product_id", "product_category")
    p1 = prod.select(F.col("product_sk").alias("p1_sk"), F.col("product_id").alias("product1"),
                     F.col("product_category").alias("category1"))
    p2 = prod.select(F.col("product_sk").alias("p2_sk"), F.col("product_id").alias("product2"),
                     F.col("product_category").alias("category2"))
    # a limit tells the planner the size of the k winning pairs, so it broadcasts them and
    # only scans the product table unless k itself is large
    out = p2.join(p1.join(top, "p1_sk"), "p2_sk")
    return out.select("product1", "category1", "product2", "category2",
                      "frequency_purchased_together", "combined_revenue").orderBy(
        F.col("frequency_purchased_together").desc(), F.col("combined_revenue").desc(),
        "product1", "product2")


# ---------------------------------------------------------------- Q17
def q17_revenue_rollup(star: Star) -> DataFrame:
    """The category is looked up first (a sale has its own product nearly always, so sums by
    product would hardly shrink the fact), then one sum by (store, supplier, category, year);
    names are joined to those sums, and each level of the rollup comes from the one below. Joins
    and sums are dealt to more tasks as sales grow: no task sorts and sums more than a share."""
    fact = star.fact(tasks=_tasks(star)).select("store_sk", "supplier_sk", "product_sk",
                                                F.year("transaction_date").alias("year"), "total_amount")
    keys = ["store_sk", "supplier_sk", "product_category", "year"]
    sales = _dealt(star, fact, "product_sk").join(
        _dealt(star, star.dim("product").select("product_sk", "product_category"), "product_sk"), "product_sk")
    fine = _dealt(star, sales, *keys).groupBy(*keys).agg(F.sum("total_amount").alias("_s"), F.count(F.lit(1)).alias("_n"))
    named = (fine.join(star.dim("supplier").select("supplier_sk", "supplier_name"), "supplier_sk")
             .join(star.dim("store").select("store_sk", "store_name"), "store_sk"))
    names = ["store_name", "supplier_name", "product_category", "year"]
    out = olap.rollup_report(_dealt(star, named, *names), names,
                             {"total_revenue": ("_s", "sum_money"),
                              "transaction_count": ("_n", "sum")})
    return _ordered(star, out, *[F.col(n).asc_nulls_first() for n in names])


# ---------------------------------------------------------------- Q18
def q18_half_year_sales(star: Star, as_of=None) -> DataFrame:
    s = star.joined("time", period=_current_year(as_of))
    per = olap.half_year_pivot(s, ["product_sk"], "month", "total_amount", "quantity")
    prod = star.dim("product").select("product_sk", "product_id", "product_category", "price")
    out = prod.join(per, "product_sk").drop("product_sk")
    return out.orderBy(F.col("yearly_revenue").desc(), "product_id")


# ---------------------------------------------------------------- Q19
def q19_revenue_spikes(star: Star, factor: int = 2) -> DataFrame:
    daily = (star.joined().groupBy("product_sk", "transaction_date")
             .agg(money.money_sum("total_amount").alias("daily_sales")))
    spikes = olap.revenue_spikes(daily, "product_sk", "daily_sales", factor)
    prod = star.dim("product").select("product_sk", "product_id", "product_category")
    out = spikes.join(prod, "product_sk").select(
        "product_id", "product_category", F.col("transaction_date").alias("sale_date"),
        "daily_sales", "avg_daily_sales",
        F.lit("SPIKE").alias("sale_status"),
        money.pct_of("daily_sales", "avg_daily_sales").alias("percent_of_average"))
    return out.orderBy(F.col("daily_sales").desc(), "product_id", "sale_date")


# ---------------------------------------------------------------- Q20
def store_quarterly_sales(star: Star) -> DataFrame:
    """VIEW-1 body (store x year x quarter) with the average."""
    s = star.joined("store", "time")
    return s.groupBy("store_sk", "store_name", "year", "quarter").agg(
        *olap.standard_measures(total="total_sales", qty="total_quantity",
                                count="transaction_count", avg="avg_sale_value"))


def q20_store_quarterly_view(star: Star, view_name: str = "store_quarterly_sales") -> DataFrame:
    """The view, served from the maintained pre-aggregate when the star keeps one (a few
    rows per store and quarter, whatever the fact size), else aggregated from the fact."""
    view = star.store_quarterly()
    (view if view is not None else store_quarterly_sales(star)).createOrReplaceTempView(
        view_name)
    return star.spark.table(view_name).select(
        "store_name", "year", "quarter", "total_sales", "total_quantity", "transaction_count"
    ).orderBy("store_name", "year", "quarter")


# ---------------------------------------------------------------- utilities
def util_table_counts(star: Star) -> DataFrame:
    return star.table_counts()


def util_revenue_summary(star: Star) -> DataFrame:
    f = star.joined()
    return f.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        money.money_sum("total_amount").alias("total_revenue"),
        money.exact_avg(F.sum("total_amount"), F.count(F.lit(1))).alias("avg_transaction_amount"),
        F.min("total_amount").alias("min_amount"),
        F.max("total_amount").alias("max_amount"),
        F.sum("quantity").cast("long").alias("total_quantity"))


def slice_dice(star: Star, filters: dict, keys: list[str], dims: tuple[str, ...]) -> DataFrame:
    """Filters on a dimension reach its scan (equality predicates are pushed through the
    inner joins), so the fact meets only the members that pass; filters on business keys
    also reach the fact's scan, as surrogate keys."""
    s = star.of_members(filters).joined(*dims)
    return olap.slice_dice(s, filters, keys).orderBy(*keys)
