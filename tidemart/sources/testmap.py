"""The driver's TPC-H-like test tables seen as the retail star (FIXTURES.md section 2).

Fact grain = ``lineitem JOIN orders``; product = part; supplier = the line's supplier;
store = the region of the customer's nation; customer demographics are deterministic
stand-ins computed from customer columns. Everything here is lazy DataFrame code: a
report that does not ask for a dimension never joins it.

Surrogate keys in this view are the integer business keys (a bijection with the dense
keys of the loader); reports never output surrogate keys, and ``product_sk`` keeps the
ascending order of ``product_id`` that the basket report's ``<`` relies on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import money
from ..plans.star import FACT_COLS, Period, Star, time_attributes

# Fixed values of the test mapping (FIXTURES.md section 2): age bands by account balance
# (upper bound exclusive, last band open), the married market segments, city letters.
AGE_BANDS = [(0.0, "0-17"), (1500.0, "18-25"), (3000.0, "26-35"), (4500.0, "36-45"),
             (6000.0, "46-50"), (8000.0, "51-55")]
AGE_BAND_OPEN = "55+"
MARRIED_SEGMENTS = ("AUTOMOBILE", "MACHINERY")
CITY_LETTERS = ("A", "B", "C")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def age_group(balance: Column) -> Column:
    expr = None
    for bound, label in AGE_BANDS:
        expr = (F.when(balance < bound, F.lit(label)) if expr is None
                else expr.when(balance < bound, F.lit(label)))
    return expr.otherwise(F.lit(AGE_BAND_OPEN))


def age_numeric(group: Column) -> Column:
    """Lower bound of the age band (``26-35`` -> 26, ``55+`` -> 55)."""
    return F.regexp_extract(group, r"^(\d+)", 1).cast("int")


def customer_attributes(c: DataFrame) -> DataFrame:
    """Customer master stand-ins from ``customer`` (one row per c_custkey)."""
    ag = age_group(F.col("c_acctbal"))
    city = (F.when(F.col("c_nationkey") % 3 == 0, F.lit(CITY_LETTERS[0]))
            .when(F.col("c_nationkey") % 3 == 1, F.lit(CITY_LETTERS[1]))
            .otherwise(F.lit(CITY_LETTERS[2])))
    return c.select(
        F.col("c_custkey").alias("customer_sk"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        ag.alias("age_group"),
        age_numeric(ag).alias("age_numeric"),
        F.col("c_nationkey").alias("occupation"),
        city.alias("city_category"),
        (F.col("c_custkey") % 5).cast("int").alias("stay_in_current_city_years"),
        F.when(F.col("c_mktsegment").isin(*MARRIED_SEGMENTS), F.lit(1)).otherwise(F.lit(0))
        .alias("marital_status"),
        F.col("c_nationkey"),
    )


class TestTableStar(Star):
    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def t(self, name: str) -> DataFrame:
        # DataFrames are immutable plans: one file listing / footer read per table
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    # -- dimensions ---------------------------------------------------------------
    def _store_by_nation(self) -> DataFrame:
        """nation -> (store_sk, store_id, store_name)."""
        n = self.t("nation").select("n_nationkey", "n_regionkey")
        r = self.t("region").select("r_regionkey", "r_name")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey"),
            F.col("r_regionkey").cast("long").alias("store_sk"),
            F.col("r_regionkey").alias("store_id"),
            F.col("r_name").alias("store_name"))

    def dim(self, name: str) -> DataFrame:
        if name == "customer":
            return customer_attributes(self.t("customer")).drop("c_nationkey")
        if name == "product":
            return self.t("part").select(
                F.col("p_partkey").alias("product_sk"),
                F.col("p_partkey").alias("product_id"),
                F.col("p_type").alias("product_category"),
                money.price("p_retailprice").alias("price"))
        if name == "store":
            return self.t("region").select(
                F.col("r_regionkey").cast("long").alias("store_sk"),
                F.col("r_regionkey").alias("store_id"),
                F.col("r_name").alias("store_name"))
        if name == "supplier":
            return self.t("supplier").select(
                F.col("s_suppkey").alias("supplier_sk"),
                F.col("s_suppkey").alias("supplier_id"),
                F.col("s_name").alias("supplier_name"))
        if name == "time":
            d = self.t("orders").select(F.to_date("o_orderdate").alias("d")).distinct()
            return d.select(*cal.calendar_columns("d"))
        raise ValueError(name)

    # -- fact ---------------------------------------------------------------------
    def _orders(self, period: Period | None, customer: str | None, store: bool) -> DataFrame:
        """Orders of the period with what is asked of their customers (``attrs``: the
        customer dimension) and stores: both meet orders, not their lines."""
        o = self.t("orders").select("o_orderkey", F.col("o_custkey").alias("customer_sk"),
                                    "o_orderdate")
        if period is not None:
            start, end = period
            # compared on the raw column so the range reaches the Parquet scan
            o = o.filter((F.col("o_orderdate") >= F.lit(start)) & (F.col("o_orderdate") < F.lit(end)))
        if customer is None and not store:
            return o
        c = self.t("customer")
        cust = (customer_attributes(c) if customer == "attrs"
                else c.select(F.col("c_custkey").alias("customer_sk"), "c_nationkey"))
        if store:
            s = self._store_by_nation()
            cust = cust.join(s, cust.c_nationkey == s.n_nationkey).drop("n_nationkey")
        return o.join(cust.drop("c_nationkey"), "customer_sk")

    def _lines(self, orders: DataFrame, with_category: bool, tasks: int = 0) -> DataFrame:
        li = self.t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
        if tasks:
            li, orders = li.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
        p_cols = ["p_partkey", "p_retailprice"] + (["p_type"] if with_category else [])
        p = self.t("part").select(*p_cols)
        j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
             .join(p, li.l_partkey == p.p_partkey))
        qty = F.col("l_quantity").cast("int")
        unit = money.price("p_retailprice")
        cols = [
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("l_partkey").alias("product_sk"),
            F.col("l_suppkey").alias("supplier_sk"),
            F.to_date("o_orderdate").alias("transaction_date"),
            qty.alias("quantity"),
            unit.alias("unit_price"),
            money.line_total(qty, unit).alias("total_amount"),
            *[c for c in orders.columns if c not in ("o_orderkey", "o_orderdate")],
        ]
        if with_category:
            cols += [F.col("l_partkey").alias("product_id"),
                     F.col("p_type").alias("product_category"),
                     unit.alias("price")]
        return j.select(*cols)

    def fact(self, period: Period | None = None, tasks: int = 0) -> DataFrame:
        df = self._lines(self._orders(period, None, store=True), with_category=False, tasks=tasks)
        return df.withColumn("date_sk", cal.date_sk("transaction_date")).select(*FACT_COLS)

    def sales(self) -> int:
        return self.t("lineitem").count()

    def joined(self, *dims: str, period: Period | None = None) -> DataFrame:
        want = set(dims)
        unknown = want - {"customer", "product", "store", "supplier", "time"}
        if unknown:
            raise ValueError(f"unknown dimensions {sorted(unknown)}")
        orders = self._orders(period, "attrs" if "customer" in want else None, "store" in want)
        df = self._lines(orders, with_category="product" in want)
        if "supplier" in want:
            s = self.t("supplier").select(F.col("s_suppkey").alias("supplier_sk"),
                                          F.col("s_suppkey").alias("supplier_id"),
                                          F.col("s_name").alias("supplier_name"))
            df = df.join(s, "supplier_sk")
        if "time" in want:
            df = time_attributes(df)
        return df


def raw_transactions(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Sales transactions as the source system would send them: text keys, one row per
    line (order_id, customer_id, product_id, supplier_id, quantity, date). ``tasks``: lines are
    dealt to that many tasks by their order, in the exchange of the join with the orders (which
    has the session's shuffle partitions at least, so several of them may be one task's)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
                                                   "l_linenumber", "l_quantity")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if tasks:
        li, o = li.repartition(tasks, "l_orderkey"), o.repartition(tasks, "o_orderkey")
    lines = li.join(o, li.l_orderkey == o.o_orderkey)
    if tasks:
        lines = lines.coalesce(tasks)
    return lines.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("supplier_id"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd").alias("date"),
    )


def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer master records (CSV layout of the source system, typed), with the
    store of the customer's region (test-data mapping: store per customer)."""
    c = customer_attributes(read_table(spark, sf_dir, "customer"))
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("customer_id", "gender", "age_group", "occupation", "city_category",
                    "stay_in_current_city_years", "marital_status",
                    F.col("r_regionkey").alias("store_id"), F.col("r_name").alias("store_name")))


def product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product master records: id, category, price (DOUBLE as in the CSV)."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("product_category"),
        F.col("p_retailprice").alias("price"))


def supplier_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"))
