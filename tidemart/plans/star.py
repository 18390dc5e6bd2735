"""The star schema as a set of DataFrames.

A ``Star`` hands reports the fact rows joined with exactly the dimensions a report
asks for (Spark does not drop unused inner joins by itself). Two implementations:

* ``WarehouseStar`` - Parquet tables written by the loader (fact partitioned by
  ``sale_year``); joins go on surrogate keys.
* ``sources.testmap.TestTableStar`` - the same star derived on the fly from the
  TPC-H-like test tables (FIXTURES.md section 2).

Canonical columns
-----------------
fact:          order_id, customer_sk, product_sk, store_sk, supplier_sk, date_sk,
               transaction_date, quantity, unit_price, total_amount
customer:      customer_id, gender, age_group, age_numeric, occupation, city_category,
               stay_in_current_city_years, marital_status
product:       product_id, product_category, price
store:         store_id, store_name
supplier:      supplier_id, supplier_name
time:          year, month, month_name, quarter, day, day_of_week, day_name,
               week_of_year, season, is_weekend, is_holiday
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import scd2
from . import commits

DIMENSIONS = ("customer", "product", "store", "supplier", "time")

CUSTOMER_ATTRS = ["customer_id", "gender", "age_group", "age_numeric", "occupation",
                  "city_category", "stay_in_current_city_years", "marital_status"]
PRODUCT_ATTRS = ["product_id", "product_category", "price"]
STORE_ATTRS = ["store_id", "store_name"]
SUPPLIER_ATTRS = ["supplier_id", "supplier_name"]
TIME_ATTRS = ["year", "month", "month_name", "quarter", "day", "day_of_week", "day_name",
              "week_of_year", "season", "is_weekend", "is_holiday"]
FACT_COLS = ["order_id", "customer_sk", "product_sk", "store_sk", "supplier_sk", "date_sk",
             "transaction_date", "quantity", "unit_price", "total_amount"]

Period = tuple[_dt.date, _dt.date]

#: Members of one dimension that a point slice looks up, at most.
MAX_POINTS = 1000


def time_attributes(df: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """Calendar attributes are pure functions of the date: computing them inline
    replaces the fact-to-DIM_TIME join by a projection inside the same codegen stage."""
    attrs = cal.calendar_attributes(date_col)
    return df.select("*", *[attrs[n].alias(n) for n in TIME_ATTRS])


class Star:
    spark: SparkSession

    def fact(self, period: Period | None = None, tasks: int = 0) -> DataFrame:
        """All facts. ``tasks``: where they come from a join, it deals them to that many tasks."""
        raise NotImplementedError

    def dim(self, name: str) -> DataFrame:
        raise NotImplementedError

    def joined(self, *dims: str, period: Period | None = None) -> DataFrame:
        """Fact rows with the attributes of ``dims``; ``period`` = [start, end) on the
        transaction date, applied so that it reaches the Parquet scan."""
        raise NotImplementedError

    def sales(self) -> int:
        """Sales of the fact, about, without a join: it sizes exchanges."""
        return self.fact().count()

    def of_members(self, filters: dict[str, object]) -> "Star":
        """This star, its fact reduced to the members that filters on business keys name, where
        that spares reading; other filters are ignored, so they must still be applied."""
        return self

    def store_quarterly(self) -> DataFrame | None:
        """The maintained STORE_QUARTERLY_SALES pre-aggregate, when the star has one."""
        return None

    def customer_cube(self, cube: str) -> DataFrame | None:
        """Sums and distinct customers of a cube's cells (``streaming.distincts``), when the star
        keeps them for all of its facts."""
        return None

    def table_counts(self) -> DataFrame:
        """(table_name, record_count) of the fact and the five dimensions."""
        parts = [self.joined().select(F.lit("SALES_FACT").alias("table_name"))]
        for name, label in (("customer", "DIM_CUSTOMER"), ("product", "DIM_PRODUCT"),
                            ("store", "DIM_STORE"), ("supplier", "DIM_SUPPLIER"),
                            ("time", "DIM_TIME")):
            parts.append(self.dim(name).select(F.lit(label).alias("table_name")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.groupBy("table_name").agg(F.count(F.lit(1)).alias("record_count"))


class WarehouseStar(Star):
    """Star read from Parquet tables written by ``plans.load``.

    Layout: ``{root}/sales_fact`` (partitioned by sale_year), ``{root}/dim_customer``,
    ``dim_product``, ``dim_store``, ``dim_supplier``, ``dim_time``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._snapshot: commits.Snapshot | None = None
        self._members: dict[str, list[int]] = {}
        self._kept: tuple[commits.Snapshot, bool] | None = None

    def snapshot(self, refresh: bool = False) -> commits.Snapshot:
        """The published batches, resolved on first use: all tables of all reports of this
        star show the same state until ``refresh``."""
        if self._snapshot is None or refresh:
            self._snapshot = commits.snapshot(self.spark, self.root)
        return self._snapshot

    def _read(self, name: str) -> DataFrame:
        return self.snapshot().rows(name)

    def fact(self, period: Period | None = None, tasks: int = 0) -> DataFrame:
        f = self._read("sales_fact")
        if period is not None:
            start, end = period
            # sale_year prunes whole directories; the date range prunes row groups.
            f = f.filter((F.col("sale_year") >= start.year) & (F.col("sale_year") <= end.year)
                         & (F.col("transaction_date") >= F.lit(start))
                         & (F.col("transaction_date") < F.lit(end)))
        for key, wanted in self._members.items():
            f = f.filter(F.col(key).isin(wanted) if wanted else F.lit(False))
        return f.select(*FACT_COLS)

    def of_members(self, filters: dict[str, object]) -> "WarehouseStar":
        """Business keys become surrogate keys by a look at the dimension, and those are literals
        in the fact's scan: row groups without them are skipped by their statistics,
        dictionaries and Bloom filters (``load_batch(point_keys=...)``). A member has one row,
        so no more keys reach the driver than the caller names; lists of over ``MAX_POINTS``
        would be no point slice and are left to the join."""
        out = WarehouseStar(self.spark, self.root)
        out._snapshot, out._members = self.snapshot(), dict(self._members)
        for name in ("customer", "product", "store", "supplier"):
            if f"{name}_id" not in filters:
                continue
            value = filters[f"{name}_id"]
            wanted = list(value) if isinstance(value, (list, tuple, set)) else [value]
            if len(wanted) > MAX_POINTS:
                continue
            found = self.dim(name).filter(F.col(f"{name}_id").isin(wanted)).select(f"{name}_sk")
            keys = {r[0] for r in found.collect()}
            held = out._members.get(f"{name}_sk")
            out._members[f"{name}_sk"] = sorted(keys if held is None else keys & set(held))
        return out

    def dim(self, name: str) -> DataFrame:
        return self._read(f"dim_{name}")

    def store_quarterly(self) -> DataFrame | None:
        """Merged partial sums kept by the loader (one row per store, year, quarter)."""
        from ..session import path_exists
        from ..streaming import preagg
        path = f"{self.root}/store_quarterly_sales"
        if not path_exists(self.spark, path):
            return None
        return preagg.read(self.spark, path, self.snapshot().live("store_quarterly_sales"))

    def customer_cube(self, cube: str) -> DataFrame | None:
        """Taken from the loads' bitmaps only if they hold as many sales as the log says are
        published, so a batch that was loaded without them is never left out."""
        from ..streaming import distincts
        snap = self.snapshot()
        if self._members:
            return None
        rows = distincts.read(self.spark, self.root, snap.live(distincts.TABLE))
        if self._kept is None or self._kept[0] != snap:
            held = distincts.covered(rows)
            self._kept = (snap, bool(held) and held == commits.published_facts(snap))
        return distincts.cells(rows, cube) if self._kept[1] else None

    def joined_as_of(self, name: str, attrs: list[str], period: Period | None = None) -> DataFrame:
        """Fact rows with ``attrs`` of the customer's or product's version that was valid on
        the day of the sale (loads with ``scd2`` keep the versions)."""
        key = f"{name}_id"
        fact = self.fact(period).join(self.dim(name).select(f"{name}_sk", key), f"{name}_sk")
        history = self._read(f"dim_{name}_history").select(key, *attrs, "valid_from", *scd2.RUN)
        return scd2.as_of(fact, history, key, "transaction_date")

    def joined(self, *dims: str, period: Period | None = None) -> DataFrame:
        df = self.fact(period)
        for d in dims:
            if d == "time":
                df = time_attributes(df)
            elif d == "customer":
                df = df.join(self.dim("customer").select("customer_sk", *CUSTOMER_ATTRS),
                             "customer_sk")
            elif d == "product":
                df = df.join(self.dim("product").select("product_sk", *PRODUCT_ATTRS),
                             "product_sk")
            elif d == "store":
                # no hint: the planner broadcasts the store table only under its size
                # threshold (a store count is small in practice, but not bounded)
                df = df.join(self.dim("store").select("store_sk", *STORE_ATTRS), "store_sk")
            elif d == "supplier":
                df = df.join(self.dim("supplier").select("supplier_sk", *SUPPLIER_ATTRS),
                             "supplier_sk")
            else:
                raise ValueError(f"unknown dimension {d!r}")
        return df
