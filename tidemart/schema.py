"""Table schemas of the star (DDL of the warehouse) and catalog helpers.

Spark enforces neither primary, foreign nor unique keys; those constraints are checked by
``operators.quality`` instead. Tables are Parquet; the fact is partitioned by
load batch and year. Every writer casts to these schemas and every reader asks for them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .session import path_exists

_L, _I, _S, _D = T.LongType(), T.IntegerType(), T.StringType(), T.DateType()
_PRICE, _AMOUNT = T.DecimalType(10, 2), T.DecimalType(12, 2)
_NOW = T.TimestampType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


_AUDIT = [_f("created_date", _NOW), _f("updated_date", _NOW)]


DIM_CUSTOMER = T.StructType([
    _f("customer_id", _S, False), _f("customer_sk", _L, False), _f("gender", _S),
    _f("age_group", _S), _f("age_numeric", _I), _f("occupation", _I), _f("city_category", _S),
    _f("stay_in_current_city_years", _I), _f("marital_status", _I), *_AUDIT])

DIM_PRODUCT = T.StructType([
    _f("product_id", _S, False), _f("product_sk", _L, False), _f("product_category", _S),
    _f("price", _PRICE), *_AUDIT])

DIM_STORE = T.StructType([
    _f("store_id", _I, False), _f("store_sk", _L, False), _f("store_name", _S), *_AUDIT])

DIM_SUPPLIER = T.StructType([
    _f("supplier_id", _I, False), _f("supplier_sk", _L, False), _f("supplier_name", _S), *_AUDIT])

DIM_TIME = T.StructType([
    _f("date_sk", _I, False), _f("transaction_date", _D, False), _f("year", _I), _f("month", _I),
    _f("month_name", _S), _f("quarter", _I), _f("day", _I), _f("day_of_week", _I),
    _f("day_name", _S), _f("week_of_year", _I), _f("season", _S), _f("is_weekend", _I),
    _f("is_holiday", _I)])

SALES_FACT = T.StructType([
    _f("sales_sk", _L, False), _f("order_id", _S, False), _f("customer_sk", _L, False), _f("product_sk", _L, False),
    _f("store_sk", _L, False), _f("supplier_sk", _L, False), _f("date_sk", _I, False),
    _f("transaction_date", _D, False), _f("quantity", _I), _f("unit_price", _PRICE),
    _f("total_amount", _AMOUNT), _f("created_date", _NOW)])

QUARANTINE = T.StructType([_f(c, _S) for c in (
    "order_id", "customer_id", "product_id", "quantity", "date", "line_number", "supplier_id",
    "reject_reason")])

STORE_QUARTERLY_SALES = T.StructType([
    _f("store_sk", _L, False), _f("store_id", _I), _f("store_name", _S), _f("year", _I),
    _f("quarter", _I), _f("total_sales", T.DecimalType(22, 2)), _f("total_quantity", _L),
    _f("transaction_count", _L)])

# files that a batch has loaded, so that no later one loads them again
FILE_LEDGER = T.StructType([_f("path", _S), _f("size", _L), _f("modified", _NOW), _f("rows", _L)])

# cells of the cubes of ``streaming.distincts``: attributes that aren't the cube's are null
CUSTOMER_BITMAPS = T.StructType([
    _f("cube", _S, False), _f("gender", _S), _f("age_group", _S), _f("city_category", _S), _f("occupation", _I),
    _f("stay_in_current_city_years", _I), _f("product_category", _S), _f("season", _S), _f("bucket", _L),
    _f("bits", T.BinaryType()), _f("total_sales", T.DecimalType(22, 2)), _f("total_quantity", _L),
    _f("transaction_count", _L)])

# every attempt of a batch has a folder of its own in each table (``plans.commits``)
_RUN = ("batch_id", "attempt")
TABLES = {
    "dim_customer": (DIM_CUSTOMER, _RUN),
    "dim_product": (DIM_PRODUCT, _RUN),
    "dim_store": (DIM_STORE, _RUN),
    "dim_supplier": (DIM_SUPPLIER, _RUN),
    "dim_time": (DIM_TIME, _RUN),
    "sales_fact": (SALES_FACT, (*_RUN, "sale_year")),
    "quarantine": (QUARANTINE, _RUN),
    "store_quarterly_sales": (STORE_QUARTERLY_SALES, _RUN),
}

def _history(dim: T.StructType, sk: str) -> T.StructType:
    attrs = [f for f in dim.fields if f.name not in (sk, "created_date", "updated_date")]
    return T.StructType([*attrs, _f("valid_from", _D, False)])


# versions of members (``operators.scd2``), one row for each that a load has opened
HISTORIES = {
    "dim_customer_history": (_history(DIM_CUSTOMER, "customer_sk"), _RUN),
    "dim_product_history": (_history(DIM_PRODUCT, "product_sk"), _RUN),
}
# tables that aren't registered in a catalog
INTERNAL = {"file_ledger": (FILE_LEDGER, _RUN), "customer_bitmaps": (CUSTOMER_BITMAPS, _RUN), **HISTORIES}


# Fixed VARCHAR(n) and CHAR(1) lengths of the text columns.
VARCHAR = {
    "dim_customer": {"customer_id": 20, "gender": 1, "age_group": 10, "city_category": 1},
    "dim_product": {"product_id": 20, "product_category": 50},
    "dim_store": {"store_name": 100},
    "dim_supplier": {"supplier_name": 100},
    "dim_time": {"month_name": 20, "day_name": 20, "season": 10},
    "sales_fact": {"order_id": 20},
}


def full(name: str) -> T.StructType:
    """Schema of a table with its partition columns, as its folders are read."""
    fields, parts = (TABLES | INTERNAL)[name]
    return T.StructType(fields.fields + [_f(p, _I if p == "sale_year" else _L) for p in parts])


def ddl(name: str, location: str, database: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet PARTITIONED BY ... LOCATION ...``."""
    schema, parts = TABLES[name]
    cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    cols += [f"`{p}` {'int' if p == 'sale_year' else 'bigint'}" for p in parts]
    qual = f"{database}.{name}" if database else name
    return (f"CREATE TABLE IF NOT EXISTS {qual} ({', '.join(cols)}) USING parquet "
            f"PARTITIONED BY ({', '.join(parts)}) LOCATION '{location.rstrip('/')}/{name}'")


def create_tables(spark: SparkSession, root: str, database: str | None = None) -> list[str]:
    """Register every star table over the loader's layout under ``root``. The catalog's
    partitions are those of the published batches; call it again after a load."""
    from .plans import commits
    snap = commits.snapshot(spark, root)
    made = []
    for name in TABLES:
        spark.sql(ddl(name, root, database))
        qual = f"{database}.{name}" if database else name
        if path_exists(spark, f"{root.rstrip('/')}/{name}"):
            spark.sql(f"MSCK REPAIR TABLE {qual} SYNC PARTITIONS")
            listed = spark.sql(f"SHOW PARTITIONS {qual}")
            run = listed.select("partition", *[F.regexp_extract("partition", f"{c}=(\\d+)", 1).cast("long").alias(c)
                                               for c in _RUN])
            # unpublished attempts only: few
            for row in run.where(~snap.live(name)).collect():
                spec = ", ".join("{}={}".format(*part.split("=")) for part in row["partition"].split("/"))
                spark.sql(f"ALTER TABLE {qual} DROP PARTITION ({spec})")
        made.append(qual)
    return made


def drop_tables(spark: SparkSession, database: str | None = None) -> None:
    """Drop in foreign-key order (fact and aggregate first, then dimensions)."""
    order = ["store_quarterly_sales", "quarantine", "sales_fact", "dim_time", "dim_supplier", "dim_store",
             "dim_product", "dim_customer"]
    for name in order:
        qual = f"{database}.{name}" if database else name
        spark.sql(f"DROP TABLE IF EXISTS {qual}")
