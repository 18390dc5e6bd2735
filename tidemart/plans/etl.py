"""ETL query plans over the test tables: sources, enrichment, quarantine, dimension
maintenance, fact load, SCD2 and data quality. Each function takes (spark, sf_dir) and
returns a DataFrame; fixtures that must exist as files (CSV masters, transaction files,
warehouse tables) are written below the shared checkpoint folder first.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import cleanse, keys, quality, scd2
from ..session import TASK_ROWS, scratch_path
from ..sources import masters
from ..sources import testmap as tm
from ..streaming import distincts, loader, preagg
from . import commits, load, reports
from .star import WarehouseStar

ENRICHED_COLS = ["order_id", "customer_id", "product_id", "gender", "product_category",
                 "quantity", "unit_price", "total_amount"]

# Defect injection for the quarantine and data-quality fixtures (fixed test values):
# order keys divisible by these get a bad quantity / bad date / unknown customer /
# unknown product. Every row is kept; the moduli only decide which rows are dirty.
DIRT_QUANTITY, DIRT_DATE, DIRT_CUSTOMER, DIRT_PRODUCT = 97, 89, 83, 79
UNKNOWN_KEY = "UNKNOWN"


# ------------------------------------------------------------------ sources
def product_master_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product master in the source layout: each part with a store (region
    ``p_partkey % 5``) and a supplier (``p_partkey % supplier count``)."""
    part = tm.read_table(spark, sf_dir, "part")
    region = tm.read_table(spark, sf_dir, "region")
    supplier = tm.read_table(spark, sf_dir, "supplier")
    n_regions = region.count()
    n_suppliers = supplier.count()
    p = part.select("p_partkey", "p_type", "p_retailprice",
                    (F.col("p_partkey") % n_regions).alias("_r"),
                    (F.col("p_partkey") % n_suppliers).alias("_s"))
    return (p.join(region, p._r == region.r_regionkey)
            .join(supplier, p._s == supplier.s_suppkey)
            .select(F.col("p_partkey").cast("string").alias("product_id"),
                    F.col("p_type").alias("product_category"),
                    F.col("p_retailprice").alias("price"),
                    F.col("r_regionkey").alias("store_id"), F.col("r_name").alias("store_name"),
                    F.col("s_suppkey").cast("int").alias("supplier_id"),
                    F.col("s_name").alias("supplier_name")))


def src_customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customer-master-csv")
    masters.write_customer_master_csv(tm.customer_master(spark, sf_dir), path)
    return masters.read_customer_master(spark, path)


def src_product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "product-master-csv")
    masters.write_product_master_csv(product_master_records(spark, sf_dir), path)
    return masters.read_product_master(spark, path)


# ------------------------------------------------------------------ enrichment
def _masters(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return tm.customer_master(spark, sf_dir), tm.product_master(spark, sf_dir)


def enrich_sales_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, products = _masters(spark, sf_dir)
    raw = tm.raw_transactions(spark, sf_dir)
    return cleanse.enrich(raw, customers, products).select(*ENRICHED_COLS)


def unmatched_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions whose customer has no master record; the master here lacks every
    customer whose key ends in 0 (fixture), all transactions are checked."""
    customers, _ = _masters(spark, sf_dir)
    partial = customers.where(~F.col("customer_id").endswith("0"))
    raw = tm.raw_transactions(spark, sf_dir)
    return cleanse.unmatched(raw, partial, "customer_id").select(
        "order_id", "line_number", "customer_id", "product_id")


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tm.raw_transactions(spark, sf_dir)
    k = F.col("order_id").cast("long")
    return raw.select(
        "order_id", "line_number",
        F.when(k % DIRT_CUSTOMER == 0, F.lit(UNKNOWN_KEY)).otherwise(F.col("customer_id"))
        .alias("customer_id"),
        F.when(k % DIRT_PRODUCT == 0, F.lit(UNKNOWN_KEY)).otherwise(F.col("product_id"))
        .alias("product_id"),
        "supplier_id",
        F.when(k % DIRT_QUANTITY == 0, F.lit("x")).otherwise(F.col("quantity")).alias("quantity"),
        F.when(k % DIRT_DATE == 0, F.lit("bad")).otherwise(F.col("date")).alias("date"))


def quarantine_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, products = _masters(spark, sf_dir)
    classified = cleanse.classify(dirty_transactions(spark, sf_dir), customers, products)
    return classified.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("row_count"))


# ------------------------------------------------------------------ keys and dimensions
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = tm.read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"))
    return keys.dense_keys(ids, "customer_id", "customer_sk")


def _members(spark: SparkSession, sf_dir: str, master: DataFrame, arrivals: DataFrame,
             key: str, sk: str, attrs: list[str]) -> DataFrame:
    """Existing dimension = master members with an even numeric key (numbered first);
    arrivals = members referenced by the sales. Output: the dimension after the batch."""
    even = master.where(F.col(key).cast("long") % 2 == 0)
    existing = keys.dense_keys(even, key, sk).join(even, key).select(key, sk, *attrs)
    dim = keys.upsert_dimension(arrivals, existing, key, sk, attrs)
    return dim.select(key, sk, "is_new")


def dim_customer_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, _ = _masters(spark, sf_dir)
    attrs = ["gender", "age_group"]
    arrivals = tm.raw_transactions(spark, sf_dir).select("customer_id") \
        .join(customers.select("customer_id", *attrs), "customer_id")
    return _members(spark, sf_dir, customers.select("customer_id", *attrs), arrivals,
                    "customer_id", "customer_sk", attrs)


def dim_product_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, products = _masters(spark, sf_dir)
    attrs = ["product_category"]
    arrivals = tm.raw_transactions(spark, sf_dir).select("product_id") \
        .join(products.select("product_id", *attrs), "product_id")
    return _members(spark, sf_dir, products.select("product_id", *attrs), arrivals,
                    "product_id", "product_sk", attrs)


def dim_store_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, _ = _masters(spark, sf_dir)
    stores = tm.read_table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("store_id"), F.col("r_name").alias("store_name"))
    arrivals = tm.raw_transactions(spark, sf_dir).select("customer_id") \
        .join(customers.select("customer_id", "store_id", "store_name"), "customer_id")
    return _members(spark, sf_dir, stores, arrivals, "store_id", "store_sk", ["store_name"])


def dim_supplier_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = tm.supplier_master(spark, sf_dir)
    arrivals = tm.raw_transactions(spark, sf_dir).select(
        F.col("supplier_id").cast("long").alias("supplier_id")).join(sup, "supplier_id")
    return _members(spark, sf_dir, sup, arrivals, "supplier_id", "supplier_sk",
                    ["supplier_name"])


def dim_time_from_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = tm.raw_transactions(spark, sf_dir).select(
        cal.parse_date("date").alias("d")).distinct()
    return dates.select(*cal.calendar_columns("d"))


def dim_time_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from Jan 1 of the first sales year to Dec 31 of the last one. The day
    list is generated from a one-row range (its size is bounded by the calendar)."""
    o = tm.read_table(spark, sf_dir, "orders")
    bounds = o.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    days = bounds.select(F.explode(F.sequence(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)),
        F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*cal.calendar_columns("d"))


# ------------------------------------------------------------------ fact load
def load_test_warehouse(spark: SparkSession, sf_dir: str, root: str | None = None,
                        raw: DataFrame | None = None, point_keys: tuple[str, ...] = ()) -> str:
    root = root or scratch_path(spark, "warehouse")
    customers, products = _masters(spark, sf_dir)
    raw = raw if raw is not None else tm.raw_transactions(spark, sf_dir)
    load.load_batch(spark, raw, customers, products, root, 0,
                    suppliers=tm.supplier_master(spark, sf_dir).withColumn(
                        "supplier_id", F.col("supplier_id").cast("int")), point_keys=point_keys)
    return root


def slice_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slice and dice of one customer, the one of the smallest id, over a warehouse laid out for
    such slices."""
    root = load_test_warehouse(spark, sf_dir, point_keys=("customer_sk", "product_sk"))
    star = WarehouseStar(spark, root)
    first = star.dim("customer").agg(F.min(F.col("customer_id").cast("long")).cast("string")).first()[0]
    out = reports.slice_dice(star, {"customer_id": first}, ["gender", "product_category", "year"],
                             ("customer", "product", "time"))
    return out.withColumn("year", F.col("year").cast("long"))


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = load_test_warehouse(spark, sf_dir)
    return load.read(spark, root, "sales_fact").select(
        "order_id", "customer_sk", "product_sk", "store_sk", "supplier_sk", "date_sk",
        "quantity", "unit_price", "total_amount")


def fact_sales_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact's surrogate key over a clean first batch: 1..n without a gap."""
    fact = load.read(spark, load_test_warehouse(spark, sf_dir), "sales_fact")
    return fact.agg(F.count(F.lit(1)).alias("fact_rows"), F.min("sales_sk").alias("first_sk"),
                    F.max("sales_sk").alias("last_sk"), F.countDistinct("sales_sk").alias("distinct_sk"),
                    F.count("created_date").alias("dated_rows"))


def business_fact(spark: SparkSession, root: str) -> DataFrame:
    """The written star's fact with business keys in place of surrogate keys. Where the session's
    shuffle partitions would get over ``TASK_ROWS`` sales each, the fact is dealt to more tasks for
    the two large dimensions: sorts that don't fit in memory are spilled."""
    snap = commits.snapshot(spark, root)
    fact = snap.rows("sales_fact")
    tasks = -(-(commits.published_facts(snap) or 0) // TASK_ROWS)
    dealt = tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    # products first: the load leaves the sales of one near each other
    for name in ("product", "customer", "store", "supplier"):
        bk, sk, attrs = load.DIM_SPECS[name]
        dim = snap.rows(f"dim_{name}").select(sk, bk, *attrs)
        if dealt and name in ("customer", "product"):
            fact, dim = fact.repartition(tasks, sk), dim.repartition(tasks, sk)
        fact = fact.join(dim, sk)
    return fact


def load_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even orders load while the customer master lacks every key ending in 0, odd orders load
    with the whole master, then the first batch is replayed with it, and a second source
    loads the odd orders of customers ending in 7 again. Rows of each table by batch, and
    members against distinct keys."""
    root = scratch_path(spark, "two-batches")
    customers, products = _masters(spark, sf_dir)
    sup = tm.supplier_master(spark, sf_dir).withColumn("supplier_id", F.col("supplier_id").cast("int"))
    raw = tm.raw_transactions(spark, sf_dir)
    order = F.col("order_id").cast("long")
    even, odd = raw.where(order % 2 == 0), raw.where(order % 2 == 1)
    some = customers.where(~F.col("customer_id").endswith("0"))

    def run(rows: DataFrame, master: DataFrame, source: str, offset: str) -> None:
        load.load_batch(spark, rows, master, products, root, suppliers=sup, source=source,
                        offset=offset)

    run(even, some, "first", "0")
    run(odd, customers, "first", "1")
    run(even, customers, "first", "0")
    run(odd.where(F.col("customer_id").endswith("7")), customers, "second", "0")
    parts = []
    for name in ("sales_fact", "quarantine"):
        parts.append(load.read(spark, root, name).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(name).alias("table_name"), "batch_id", "n"))
    for name, (bk, sk, _) in load.DIM_SPECS.items():
        dim = load.read(spark, root, f"dim_{name}")
        parts.append(dim.agg(F.countDistinct(bk).alias("n"))
                     .select(F.lit(f"dim_{name} members").alias("table_name"),
                             F.lit(-1).cast("long").alias("batch_id"), "n"))
        parts.append(dim.agg(F.countDistinct(sk).alias("n"))
                     .select(F.lit(f"dim_{name} keys").alias("table_name"),
                             F.lit(-1).cast("long").alias("batch_id"), "n"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _state(spark: SparkSession, root: str, phase: str) -> DataFrame:
    """Rows, and the sum of amounts where there is one, of the published tables: (phase,
    table_name, n, amount)."""
    snap = commits.snapshot(spark, root)
    no = F.lit(None).cast("decimal(22,2)")
    parts = [("sales_fact", F.count(F.lit(1)), F.sum("total_amount").cast("decimal(22,2)")),
             ("quarantine", F.count(F.lit(1)), no),
             ("store_quarterly_sales", F.sum("transaction_count"), F.sum("total_sales").cast("decimal(22,2)"))]
    parts += [(f"dim_{name}", F.countDistinct(sk), no) for name, (_, sk, _) in load.DIM_SPECS.items()]
    out = None
    for table, n, amount in parts:
        row = snap.rows(table).agg(n.alias("n"), amount.alias("amount")).select(
            F.lit(phase).alias("phase"), F.lit(table).alias("table_name"), "n", "amount")
        out = row if out is None else out.unionByName(row)
    return out


def load_failed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even orders are loaded. The load of the odd ones breaks off after all its tables are
    written, just before it is published; then it runs again. What readers see after either."""
    root = scratch_path(spark, "failed-batch")
    customers, products = _masters(spark, sf_dir)
    sup = tm.supplier_master(spark, sf_dir).withColumn("supplier_id", F.col("supplier_id").cast("int"))
    raw = tm.raw_transactions(spark, sf_dir)
    order = F.col("order_id").cast("long")
    args = dict(customers=customers, products=products, root=root, suppliers=sup, source="s",
                rows=tm.read_table(spark, sf_dir, "lineitem").count() // 2)
    load.load_batch(spark, raw.where(order % 2 == 0), offset="0", **args)
    load.write_batch(spark, raw.where(order % 2 == 1), offset="1", **args)  # and no publish
    failed = _state(spark, root, "failed")
    load.load_batch(spark, raw.where(order % 2 == 1), offset="1", **args)
    return failed.unionByName(_state(spark, root, "again"))


# ------------------------------------------------------------------ SCD2
def scd2_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot 1 = customer master on 1995-01-01; snapshot 2 on the last order date with
    the city changed for customers whose key ends in 0."""
    customers, _ = _masters(spark, sf_dir)
    o = tm.read_table(spark, sf_dir, "orders")
    day2 = o.agg(F.to_date(F.max("o_orderdate")).alias("d"))
    snap1 = customers.select("customer_id", "city_category")
    changed = F.col("customer_id").endswith("0")
    nxt = F.when(F.col("city_category") == "A", "B").when(F.col("city_category") == "B", "C") \
        .otherwise("A")
    snap2 = snap1.select("customer_id",
                         F.when(changed, nxt).otherwise(F.col("city_category"))
                         .alias("city_category"))
    first = scd2.initial(snap1, "customer_id", F.lit("1995-01-01").cast("date"))
    effective = day2.first()["d"]  # one scalar
    return scd2.merge(first, snap2, "customer_id", ["city_category"], effective).select(
        "customer_id", "city_category", "valid_from", "valid_to", "is_current")


HISTORY_FROM, HISTORY_CHANGE = _dt.date(1995, 1, 1), _dt.date(1997, 1, 1)


def fact_sales_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even orders are loaded with the customer master of 1995; odd ones with that of 1997, in
    which customers whose key ends in 0 have moved. All sales by the city that the customer
    lived in on the day of the sale."""
    customers, products = _masters(spark, sf_dir)
    root = scratch_path(spark, "history")
    sup = tm.supplier_master(spark, sf_dir).withColumn("supplier_id", F.col("supplier_id").cast("int"))
    raw = tm.raw_transactions(spark, sf_dir)
    order = F.col("order_id").cast("long")
    city = F.col("city_category")
    moved = F.when(city == "A", "B").when(city == "B", "C").otherwise("A")
    later = customers.withColumn("city_category", F.when(F.col("customer_id").endswith("0"), moved).otherwise(city))
    for n, (master, day) in enumerate(((customers, HISTORY_FROM), (later, HISTORY_CHANGE))):
        load.load_batch(spark, raw.where(order % 2 == n), master, products, root, suppliers=sup, source="s", offset=str(n),
                        scd2={"customer": ["city_category"]}, effective=day)
    sales = WarehouseStar(spark, root).joined_as_of("customer", ["city_category"])
    return sales.groupBy("city_category", F.year("transaction_date").alias("year")).agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("total_amount").cast("decimal(22,2)").alias("total_sales"),
        F.countDistinct("customer_id").alias("customers"))


# ------------------------------------------------------------------ data quality
def _dq_star(spark: SparkSession, sf_dir: str) -> str:
    """A loaded warehouse whose fact carries injected orphans (see ``quality``)."""
    return load_test_warehouse(spark, sf_dir, raw=dirty_transactions(spark, sf_dir))


def dq_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw input is counted by itself, not as the loader saw it."""
    root = _dq_star(spark, sf_dir)
    return quality.completeness(dirty_transactions(spark, sf_dir),
                                load.read(spark, root, "sales_fact"),
                                load.read(spark, root, "quarantine"))


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _dq_star(spark, sf_dir)
    # defect: customers whose key ends in 0 are missing from the dimension
    dims = {n: load.read(spark, root, f"dim_{n}") for n in
            ("customer", "product", "store", "supplier", "time")}
    dims["customer"] = dims["customer"].where(~F.col("customer_id").endswith("0"))
    return quality.orphans(load.read(spark, root, "sales_fact"), dims)


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, products = _masters(spark, sf_dir)
    # defect: the customer master is read twice for keys ending in 7
    dup = customers.unionByName(customers.where(F.col("customer_id").endswith("7")))
    return quality.duplicates({"customer_master": (dup, "customer_id"),
                               "product_master": (products, "product_id")})


def dq_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = cleanse.classify(dirty_transactions(spark, sf_dir), *_masters(spark, sf_dir))
    return quality.null_counts(classified, "transactions",
                               ["order_id", "customer_id", "product_id", "quantity",
                                "transaction_date", "gender", "product_category", "price"])


def dq_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = tm.TestTableStar(spark, sf_dir)
    return quality.ranges(star.fact(), ["unit_price", "total_amount", "quantity",
                                        "transaction_date"], "sales_fact")


def dq_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, _ = _masters(spark, sf_dir)
    return quality.domains(customers)


# ------------------------------------------------------------------ streaming
#: Transactions of one staged file, about: a task writes it.
FILE_ROWS = 1_000_000


def _parts(spark: SparkSession, sf_dir: str, files: int, rows: int = FILE_ROWS) -> int:
    """Files that each of ``files`` portions of the transactions takes (a look at the footers)."""
    return max(1, -(-tm.read_table(spark, sf_dir, "lineitem").count() // (files * rows)))


def streamed_warehouse(spark: SparkSession, sf_dir: str, files: int = 4) -> str:
    """The whole transaction table staged as CSV files and loaded by the streaming loader,
    one file per micro-batch, or several where a file would get too long for a task
    (``availableNow``); the root of the star it wrote."""
    base = scratch_path(spark, "stream")
    src = f"{base}/incoming"
    parts = _parts(spark, sf_dir, files)
    masters.write_transactions_csv(tm.raw_transactions(spark, sf_dir, tasks=files * parts), src)
    schema = masters.transaction_schema(spark, src)
    sup = lambda: tm.supplier_master(spark, sf_dir).withColumn(
        "supplier_id", F.col("supplier_id").cast("int"))
    q = loader.start(spark, src, schema, f"{base}/warehouse", f"{base}/_checkpoint",
                     customers=lambda: tm.customer_master(spark, sf_dir),
                     products=lambda: tm.product_master(spark, sf_dir), suppliers=sup,
                     max_files_per_trigger=parts)
    q.awaitTermination()
    return f"{base}/warehouse"


def stream_sales_enriched(spark: SparkSession, sf_dir: str, files: int = 4) -> DataFrame:
    """Enriched sales as the star holds them that the stream wrote."""
    return business_fact(spark, streamed_warehouse(spark, sf_dir, files)).select(*ENRICHED_COLS)


def stream_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact that the stream wrote, by business keys."""
    return business_fact(spark, streamed_warehouse(spark, sf_dir)).select(
        "order_id", "customer_id", "product_id", "store_id", "supplier_id", "date_sk", "quantity",
        "unit_price", "total_amount")


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of four files are streamed one by one; then a stream with a new checkpoint takes
    three files at a time, the fourth among them; then a batch loads the whole folder. The fact
    by business keys: each file once. A file too long for a task is several, taken together."""
    base = scratch_path(spark, "stream-restart")
    src, root = f"{base}/incoming", f"{base}/warehouse"
    share = F.pmod(F.xxhash64("order_id"), F.lit(4))
    parts = _parts(spark, sf_dir, 4)
    masters.write_transactions_csv(tm.raw_transactions(spark, sf_dir, tasks=3 * parts).where(share < 3), src)
    schema = masters.transaction_schema(spark, src)
    sup = lambda: tm.supplier_master(spark, sf_dir).withColumn(
        "supplier_id", F.col("supplier_id").cast("int"))
    customers, products = lambda: tm.customer_master(spark, sf_dir), lambda: tm.product_master(spark, sf_dir)

    def stream(checkpoint: str, files: int) -> None:
        loader.start(spark, src, schema, root, f"{base}/{checkpoint}", customers=customers, products=products,
                     suppliers=sup, max_files_per_trigger=files * parts).awaitTermination()

    stream("one", 1)
    masters.write_transactions_csv(tm.raw_transactions(spark, sf_dir, tasks=parts).where(share == 3), src, mode="append")
    stream("two", 3)
    load.load_batch(spark, masters.read_transactions(spark, src, schema), customers(), products(), root, suppliers=sup(),
                    source="folder")
    return business_fact(spark, root).select(
        "order_id", "customer_id", "product_id", "store_id", "supplier_id", "date_sk", "quantity",
        "unit_price", "total_amount")


def mv_customer_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even orders, then odd ones, then the even ones again (a replay), each load keeping its
    customers as bitmaps; the cells of Q2, Q3, Q7, Q8 and Q14 from the merged bitmaps."""
    root = scratch_path(spark, "bitmaps")
    customers, products = _masters(spark, sf_dir)
    sup = tm.supplier_master(spark, sf_dir).withColumn("supplier_id", F.col("supplier_id").cast("int"))
    raw = tm.raw_transactions(spark, sf_dir)
    for n in (0, 1, 0):
        load.load_batch(spark, raw.where(F.col("order_id").cast("long") % 2 == n), customers, products, root,
                        suppliers=sup, source="s", offset=str(n), distincts=True)
    star = WarehouseStar(spark, root)
    out = None
    for cube, keys in distincts.CUBES.items():
        named = [F.col(k).cast("string") for k in keys] + [F.lit(None).cast("string")] * (3 - len(keys))
        part = star.customer_cube(cube).select(
            F.lit(cube).alias("cube"), *[k.alias(f"k{i + 1}") for i, k in enumerate(named)], "customers",
            F.col("_s").cast("decimal(22,2)").alias("total_sales"), F.col("_q").cast("long").alias("total_quantity"),
            F.col("_n").cast("long").alias("transaction_count"))
        out = part if out is None else out.unionByName(part)
    return out


MV_BATCHES = 4


def mv_store_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-aggregate maintained batch by batch (orders dealt by their key, so every store and
    quarter has partial sums in several batches), then read by merging them."""
    star = tm.TestTableStar(spark, sf_dir)
    path = scratch_path(spark, "store-quarterly")
    sales = star.joined("store")
    for batch in range(MV_BATCHES):
        part = sales.where(F.col("order_id").cast("long") % MV_BATCHES == batch)
        preagg.apply_batch(part, path, batch)
    return preagg.read(spark, path).select(
        "store_id", "store_name", "year", "quarter", "total_sales", "total_quantity",
        "transaction_count", "avg_sale_value")
