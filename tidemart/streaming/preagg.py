"""STORE_QUARTERLY_SALES as an incrementally maintained table.

Each attempt of a batch writes its partial sums (store, year, quarter) to a folder of its own;
a read merges the partials of the published ones, and compaction adds them up for good.
SUM, SUM and COUNT are additive, the average is derived from the merged sum and count -
never averaged averages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import money
from ..session import read_or_empty

KEYS = ["store_sk", "store_id", "store_name", "year", "quarter"]


def partials(sales: DataFrame) -> DataFrame:
    """Partial aggregate of fact rows carrying store attributes and transaction_date."""
    return (sales.withColumn("year", F.year("transaction_date"))
            .withColumn("quarter", F.quarter("transaction_date"))
            .groupBy(*KEYS)
            .agg(money.money_sum("total_amount").alias("total_sales"),
                 F.sum("quantity").cast("long").alias("total_quantity"),
                 F.count(F.lit(1)).alias("transaction_count")))


def apply_batch(sales: DataFrame, path: str, batch_id: int, attempt: int = 0) -> None:
    """Replace the partials of one attempt of a batch, as a whole folder."""
    (partials(sales).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .parquet(f"{path}/batch_id={batch_id}/attempt={attempt}"))


def merged(rows: DataFrame) -> DataFrame:
    """Partial sums added up: one row per store, year and quarter."""
    return rows.groupBy(*KEYS).agg(
        F.sum("total_sales").cast(money.SUM_TYPE).alias("total_sales"),
        F.sum("total_quantity").cast("long").alias("total_quantity"),
        F.sum("transaction_count").cast("long").alias("transaction_count"))


def read(spark: SparkSession, path: str, live: Column | None = None) -> DataFrame:
    """The pre-aggregate at ``path``: the partials of all folders, or of the ``live`` ones."""
    p = read_or_empty(spark, path, schema.full("store_quarterly_sales"))
    return merged(p if live is None else p.where(live)).withColumn("avg_sale_value",
                             money.exact_avg("total_sales", "transaction_count"))
