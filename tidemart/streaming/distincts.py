"""Distinct customers of report cells as bitmaps that loads maintain.

COUNT(DISTINCT) isn't additive, so a pre-aggregate can't keep the number itself. Surrogate keys
are dense, so a cell keeps the set: a bitmap for each bucket of 32,768 keys. Bitmaps of batches
are merged with OR, their bits counted on read; sums and counts are added up beside them. A
cell is one combination of the attributes of a *cube* (``CUBES``); members never change, so
the cell of a sale never does either.

Plan of ``partials``: the fact is summed per customer, category and season first; these sums are
exchanged by bucket, become a row for each cube behind that exchange, and the bitmaps are built
there, too. A task holds 32,768 customers a bucket however many sales they have, and neither the
rows of five cubes nor a bitmap of a few bits is shuffled. A read merges one bitmap a batch, cell and bucket; compaction merges them for good.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import calendar as cal
from ..functions import money
from ..session import read_or_empty

TABLE = "customer_bitmaps"
#: Attributes by which the reports that count customers group.
CUBES = {
    "demographics": ("gender", "age_group", "city_category"),
    "occupation": ("occupation", "product_category"),
    "stay": ("stay_in_current_city_years", "gender"),
    "city": ("city_category", "product_category"),
    "season": ("product_category", "season"),
}
#: Those that a sale has; the others are the customer's.
OF_SALE = ("product_category", "season")
ATTRS = [f.name for f in schema.CUSTOMER_BITMAPS.fields[1:-5]]


def partials(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Bitmaps and sums of all cubes for fact rows (``customer_sk``, ``product_sk``,
    ``transaction_date`` and measures) and their members."""
    of_customer = [a for a in ATTRS if a not in OF_SALE]
    # one exchange by customer serves the sums and the join behind them
    per = (fact.join(products.select("product_sk", "product_category"), "product_sk")
           .select("customer_sk", "product_category", cal.season("transaction_date").alias("season"),
                   "total_amount", "quantity")
           .repartition("customer_sk").groupBy("customer_sk", "product_category", "season")
           .agg(F.sum("total_amount").alias("_s"), F.sum("quantity").alias("_q"), F.count(F.lit(1)).alias("_n"))
           .join(customers.select("customer_sk", *of_customer), "customer_sk"))
    types = {f.name: f.dataType for f in schema.CUSTOMER_BITMAPS.fields}
    cells = [F.struct(F.lit(cube).alias("cube"), *[
        (F.col(a) if a in keys else F.lit(None)).cast(types[a]).alias(a) for a in ATTRS])
        for cube, keys in CUBES.items()]
    keys = ["cube", *ATTRS, "bucket"]
    dealt = per.withColumn("bucket", F.bitmap_bucket_number("customer_sk")).repartition("bucket")
    return (dealt.withColumn("_cell", F.explode(F.array(*cells)))
            .select("_cell.*", "bucket", F.bitmap_bit_position("customer_sk").alias("_bit"), "_s", "_q", "_n")
            .groupBy(*keys)
            .agg(F.bitmap_construct_agg("_bit").alias("bits"), *_sums("_s", "_q", "_n")))


def _sums(total: str, quantity: str, count: str) -> list[Column]:
    return [F.sum(total).cast(money.SUM_TYPE).alias("total_sales"),
            F.sum(quantity).cast("long").alias("total_quantity"),
            F.sum(count).cast("long").alias("transaction_count")]


def merged(rows: DataFrame) -> DataFrame:
    """One row per cube, cell and bucket."""
    return rows.groupBy("cube", *ATTRS, "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), *_sums("total_sales", "total_quantity", "transaction_count"))


def read(spark: SparkSession, root: str, live: Column) -> DataFrame:
    return read_or_empty(spark, f"{root}/{TABLE}", schema.full(TABLE)).where(live)


def covered(rows: DataFrame) -> int:
    """Sales that the partials hold. Each batch writes all cubes at once, so one tells."""
    one = rows.where(F.col("cube") == next(iter(CUBES)))
    return int(one.agg(F.coalesce(F.sum("transaction_count"), F.lit(0))).first()[0])


def cells(rows: DataFrame, cube: str) -> DataFrame:
    """The attributes of a cube with ``_s``, ``_q``, ``_n`` and the exact number of customers."""
    keys = CUBES[cube]
    per = rows.where(F.col("cube") == cube).groupBy(*keys, "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.sum("total_sales").alias("_s"),
        F.sum("total_quantity").alias("_q"), F.sum("transaction_count").alias("_n"))
    return per.groupBy(*keys).agg(F.sum("_s").alias("_s"), F.sum("_q").alias("_q"), F.sum("_n").alias("_n"),
                                  F.sum(F.bitmap_count("bits")).alias("customers"))
