"""Batch / micro-batch load of the star: cleanse -> dimensions -> fact -> quarantine.

Layout under ``root`` (all Parquet, every table with a folder per ``batch_id`` and ``attempt``):
    _commits/            the log (``plans.commits``): source, offset, state, counters
    dim_customer/ dim_product/ dim_store/ dim_supplier/ dim_time/
    sales_fact/          batch_id, attempt, then sale_year
    quarantine/          rejected rows with reason
    store_quarterly_sales/  partial sums of the pre-aggregate
    customer_bitmaps/    customers of report cells, if the load keeps them
    file_ledger/         the files that the batch has loaded

Every table is written in its schema (``schema.TABLES``) and read with it, so an empty
table, a batch without accepted rows or a first batch of rejects only are ordinary cases.

Publishing. ``write_batch`` writes the folders of an attempt, which no reader sees; ``publish``
makes them visible in one step. A load that breaks off anywhere leaves all reports as they
were, and its next run is a new attempt of the same batch.

Exactly once by file. Rows that carry their file (``_file``, as ``sources.masters`` reads them) are
loaded only if no published batch has that file, by path, size and time, in the ledger:
however files are grouped into micro-batches, by whatever checkpoint, in a stream or a
batch. The ledger's rows are part of the attempt, so they are published with its facts.

Replays. The log tells whether (source, offset) was loaded before; the new attempt takes the
place of the published one, partitions that become empty included. Dimensions are append-only:
a batch adds the members that no published batch has yet, numbered after the largest key of
all, so members keep their keys whatever is replayed, and in whatever order. Dimensions are
written before facts, and rows whose store, supplier, price or amount is no value are
quarantined beforehand, so each accepted row finds all its members.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema
from ..functions import calendar as cal
from ..operators import cleanse, keys
from ..operators import scd2 as history
from ..session import drop_path, read_or_empty, scratch_path, sized_exchanges, stored
from ..streaming import distincts as bitmaps
from ..streaming import preagg
from . import commits

DIM_SPECS = {
    # name: (business key, surrogate key, attributes)
    "customer": ("customer_id", "customer_sk",
                 ["gender", "age_group", "age_numeric", "occupation", "city_category",
                  "stay_in_current_city_years", "marital_status"]),
    "product": ("product_id", "product_sk", ["product_category", "price"]),
    "store": ("store_id", "store_sk", ["store_name"]),
    "supplier": ("supplier_id", "supplier_sk", ["supplier_name"]),
}
# Keys of a batch's facts start at batch_id * SALES_SK_SPAN + 1: unique without a look at the
# facts of earlier batches. A quarantined row leaves a gap, as a failed insert does.
SALES_SK_SPAN = 1 << 40


FILE_KEY = ["path", "size", "modified"]
# From so many sales on a batch's facts are written by the tasks that have them, each into every
# year: an exchange by year would then cost more than it saves in files.
UNDEALT_ROWS = 5_000_000


@dataclass(frozen=True)
class Pending:
    """A batch that is written but not published; ``batch`` is None if it had nothing to do."""
    batch: commits.Batch | None
    counts: dict[str, int]


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The published rows of a table in its schema, whether it has rows or not."""
    return commits.snapshot(spark, root).rows(name)


def read_attempt(spark: SparkSession, root: str, name: str, batch: commits.Batch) -> DataFrame:
    """What one attempt has written to a table, published or not."""
    return read_or_empty(spark, f"{root}/{name}", schema.full(name)).where(
        (F.col("batch_id") == batch.batch_id) & (F.col("attempt") == batch.attempt))


def conform(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the column order and types of table ``name``; an absent column is NULL, the
    audit columns are the time of the write."""
    cols, present = [], set(df.columns)
    for f in schema.TABLES[name][0].fields:
        if f.name in ("created_date", "updated_date"):
            cols.append(F.current_timestamp().alias(f.name))
        elif f.name in present:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [p for p in schema.TABLES[name][1] if p not in ("batch_id", "attempt")]
    return df.select(*cols, *extra)


def _write(df: DataFrame, path: str, batch_id: int, extra_parts: tuple[str, ...] = (),
           cluster_by: tuple[str, ...] = (), attempt: int | None = None,
           bloom: tuple[str, ...] = (), deal: bool = True) -> None:
    """Write the folder of batch ``batch_id``, or of an attempt of it, as a whole. ``cluster_by``
    sorts rows inside each task after the partition columns - the writer needs that
    order anyway - so Parquet row groups get tight min/max statistics on those columns.

    With partition columns (the fact's ``sale_year``) the rows are rebalanced on them
    first: each task then writes one partition folder instead of every task writing
    into every year (tasks x years small files), and AQE sizes the output tasks to the
    advisory partition size, splitting a hot year over several tasks. Without ``deal`` each
    task writes the rows that it has."""
    laid_out(df, extra_parts, cluster_by, bloom, deal).parquet(
        f"{path}/batch_id={batch_id}" + ("" if attempt is None else f"/attempt={attempt}"))


def laid_out(df: DataFrame, parts: tuple[str, ...] = (), cluster_by: tuple[str, ...] = (),
             bloom: tuple[str, ...] = (), deal: bool = True) -> DataFrameWriter:
    """A writer of ``df`` in folders of ``parts``, files sorted by ``cluster_by``, with Parquet Bloom
    filters on ``bloom``. A filter is as large as its row group's distinct values need (the
    adaptive form keeps the smallest that fits); a row group whose values are all in a
    dictionary has none, and the dictionary serves the same end."""
    if parts and deal:
        df = df.hint("rebalance", *parts)
    if cluster_by:
        df = df.sortWithinPartitions(*parts, *cluster_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    for name in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true") \
            .option(f"parquet.bloom.filter.adaptive.enabled#{name}", "true")
    return writer.partitionBy(*parts).option("compression", "zstd") if parts else writer


def _known(name: str) -> str:
    """The column of a member's key in the published dimension, null for a new member."""
    return f"_known_{name}"


def _with_dim_attrs(rows: DataFrame) -> DataFrame:
    if "age_group" in rows.columns and "age_numeric" not in rows.columns:
        rows = rows.withColumn("age_numeric",
                               F.regexp_extract("age_group", r"^(\d+)", 1).try_cast("int"))
    return rows


def time_members(dates: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """DIM_TIME rows for a set of dates (column ``transaction_date``). ``holidays`` is an
    optional table of holiday dates (column ``holiday_date``)."""
    if holidays is None:
        return dates.select(*cal.calendar_columns("transaction_date"))
    h = (holidays.select(F.col("holiday_date").alias("transaction_date"))
         .distinct().withColumn("_hol", F.lit(1)))
    d = dates.join(h, "transaction_date", "left")
    return d.select(*cal.calendar_columns(
        "transaction_date", holidays=F.coalesce(F.col("_hol"), F.lit(0))))


def _sales_keys(staged: DataFrame, batch_id: int) -> DataFrame:
    """(_pid, _first): the key before the first row of each staging task. One row per task;
    the window over them is bounded by the number of tasks."""
    per = staged.groupBy(F.shiftright("_row", 33).alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("_pid", (F.coalesce(F.sum("_n").over(before), F.lit(0))
                               + F.lit(batch_id * SALES_SK_SPAN)).alias("_first"))


def unloaded(spark: SparkSession, raw: DataFrame, snap: commits.Snapshot) -> tuple[DataFrame, DataFrame, int, str]:
    """(rows of files that no published batch has loaded, those files with their row counts,
    their number, their digest)."""
    present = raw.groupBy(*[F.col(f"_file.{c}").alias(c) for c in FILE_KEY]).agg(F.count(F.lit(1)).alias("rows"))
    ledger = snap.rows("file_ledger").select(*FILE_KEY).distinct().withColumn("_old", F.lit(True))
    files = stored(spark, present.join(ledger, FILE_KEY, "left"), "files")
    fresh = files.where("_old IS NULL").drop("_old")
    n, digest = commits.digest(fresh)
    if n != files.count():  # else no row needs a join
        keys_ = F.struct(*[F.col(c) for c in FILE_KEY])
        raw = raw.join(fresh.select(keys_.alias("_file")), "_file", "left_semi")
    return raw, fresh, n, digest


def write_batch(spark: SparkSession, raw: DataFrame, customers: DataFrame, products: DataFrame,
                root: str, batch_id: int | None = None, suppliers: DataFrame | None = None,
                holidays: DataFrame | None = None,
                cluster_fact_by_date: bool = False,
                micro_batch: bool = False, source: str | None = None,
                offset: str | None = None, replay: bool = False,
                scd2: dict[str, list[str]] | None = None, effective: _dt.date | None = None,
                point_keys: tuple[str, ...] = (), distincts: bool = False, rows: int | None = None) -> Pending:
    """Write all tables of a batch as a new attempt that no reader sees yet; the parameters
    are those of ``load_batch``."""
    root = root.rstrip("/")
    for name in scd2 or {}:
        if f"dim_{name}_history" not in schema.HISTORIES or effective is None:
            raise ValueError(f"history of {name!r} needs a master of that name and the day it is of")
    snap = commits.snapshot(spark, root)
    files = None
    if "_file" in raw.columns:
        if replay:
            files = raw.groupBy(*[F.col(f"_file.{c}").alias(c) for c in FILE_KEY]).agg(F.count(F.lit(1)).alias("rows"))
            files = stored(spark, files, "files")
            owners = snap.rows("file_ledger").join(files.select(*FILE_KEY), FILE_KEY, "left_semi") \
                .select("batch_id").distinct().take(2)
            n, digest = commits.digest(files)
            if len(owners) > 1:
                raise ValueError("these files were loaded by several batches and can't be replayed as one")
        else:
            raw, files, n, digest = unloaded(spark, raw, snap)
        if not n:
            return Pending(None, {"rows": 0, "facts": 0, "rejects": 0})
        offset = digest if offset is None else offset
        raw = raw.drop("_file")
        rows = files.agg(F.sum("rows")).first()[0]
    if source is None:
        source, offset = "manual", str(uuid.uuid4() if batch_id is None else batch_id)
        if batch_id is not None and not replay and not commits.log(spark, root).where(
                (F.col("batch_id") == batch_id) & (F.col("state") == "done")).isEmpty():
            raise ValueError(f"batch {batch_id} is in the warehouse already")
    batch = commits.begin(spark, root, source, str(offset), wanted=batch_id)
    number, attempt = batch.batch_id, batch.attempt

    # a batch of more rows than members gains nothing from a cut of the masters and dimensions
    small = micro_batch
    if micro_batch and files is not None:
        small = rows < customers.count() + products.count()
    masters = {}
    for name, master in (("customer", customers), ("product", products)):
        bk, sk, _ = DIM_SPECS[name]
        master = cleanse.referenced(master, raw, bk) if small else master
        known = snap.rows(f"dim_{name}").select(bk, F.col(sk).alias(_known(name)))
        masters[name] = cleanse.unique(master, bk, keys.members_in(known, master, bk) if small else known)

    seen = Observation()
    raw = raw.observe(seen, F.count(F.lit(1)).alias("rows"))
    classified = cleanse.classify(raw, masters["customer"], masters["product"], unique_masters=False)
    # members' attributes are the masters': they are neither staged nor shuffled with every sale
    idle = [a for name in masters for a in DIM_SPECS[name][2] if a != "price" and a in masters[name].columns]
    staging = scratch_path(spark, "staging")
    # fixes each row's number and cuts lineage: no lost executor changes what was classified
    numbered = classified.drop(*idle).withColumn("_row", F.monotonically_increasing_id())
    with sized_exchanges(spark, rows):
        numbered.write.option("compression", "zstd").parquet(staging)
    staged = spark.read.parquet(staging)
    rows = int(seen.get["rows"])

    good = cleanse.accepted(staged)
    for key in ("store_id", "supplier_id"):
        if key in good.columns:
            good = good.withColumn(key, F.expr(f"try_cast({key} AS INT)"))
    sold = good
    if suppliers is not None and "supplier_name" not in good.columns:
        good = good.join(suppliers, "supplier_id", "left")

    # dimensions (all written before the facts). The five builds read the same staged
    # batch and write separate tables, so they are submitted as concurrent Spark jobs.
    def build_dim(name: str, bk: str, sk: str, attrs: list[str]) -> None:
        table = f"dim_{name}"
        if name in masters:  # a sale tells only that its member is new
            new = sold.where(F.col(_known(name)).isNull()).select(bk).distinct()
            arrivals = stored(spark, _with_dim_attrs(masters[name]).join(new, bk, "left_semi"), "arrivals")
            present = [a for a in attrs if a in arrivals.columns]
            fresh = keys.new_members(arrivals, None, bk, sk, present, base=keys.max_key(snap.rows(table), sk))
        else:
            present = [a for a in attrs if a in good.columns]
            fresh = keys.new_members(good, snap.rows(table), bk, sk, present, reduce=small)
        _write(conform(fresh, table), f"{root}/{table}", number, attempt=attempt)

    def build_time() -> None:
        dates = sold.select("transaction_date").distinct()
        known = keys.members_in(snap.rows("dim_time").select("transaction_date"), dates,
                                "transaction_date")
        fresh = time_members(dates.join(known, "transaction_date", "left_anti"), holidays)
        _write(conform(fresh, "dim_time"), f"{root}/dim_time", number, attempt=attempt)

    def build_history(name: str, tracked: list[str]) -> None:
        table, bk = f"dim_{name}_history", DIM_SPECS[name][0]
        fields = schema.HISTORIES[table][0].fields
        master = cleanse.one_per_key(_with_dim_attrs({"customer": customers, "product": products}[name]), bk)
        master = master.select(bk, *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields
                                     if f.name in master.columns and f.name != bk])
        fresh = history.opened(snap.rows(table), master, bk, tracked, effective)
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields if f.name not in fresh.columns]
        _write(fresh.select("*", *missing).select(*[f.name for f in fields]), f"{root}/{table}", number, attempt=attempt)

    tasks = [(build_dim, (name, bk, sk, attrs)) for name, (bk, sk, attrs) in DIM_SPECS.items()
             if bk in good.columns] + [(build_time, ())]
    tasks += [(build_history, (name, tracked)) for name, tracked in (scd2 or {}).items()]
    with sized_exchanges(spark, rows), ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        for fut in [pool.submit(fn, *args) for fn, args in tasks]:
            fut.result()

    # facts: business keys -> surrogate keys, with this attempt's own members
    own = snap.with_own(batch)
    fact = good
    for name in ("product", "customer"):  # the staged sales of a product are near each other
        bk, sk, _ = DIM_SPECS[name]
        fresh = read_attempt(spark, root, f"dim_{name}", batch).select(bk, sk)
        fact = keys.fill_keys(fact, fresh, bk, sk, _known(name), some_known=bool(snap.members))
    lookups = [(own.rows(f"dim_{name}"), bk, sk) for name, (bk, sk, _) in DIM_SPECS.items()
               if name not in masters and bk in good.columns]
    fact = keys.lookup_keys(fact, lookups, reduce=small)
    fact = (fact.withColumn("_pid", F.shiftright("_row", 33))
            .join(F.broadcast(_sales_keys(staged, number)), "_pid")  # a row per staging task
            .withColumn("sales_sk", F.col("_first") + 1
                        + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))
            .withColumn("date_sk", cal.date_sk("transaction_date"))
            .withColumn("sale_year", F.year("transaction_date")))
    # the fact and the quarantine read only the staged batch: two concurrent jobs
    with sized_exchanges(spark, rows), ThreadPoolExecutor(max_workers=2) as pool:
        jobs = [pool.submit(_write, conform(fact, "sales_fact"), f"{root}/sales_fact", number,
                            ("sale_year",), ("transaction_date",) if cluster_fact_by_date else point_keys[:1],
                            attempt, point_keys, rows < UNDEALT_ROWS),
                pool.submit(_write, conform(cleanse.rejected(staged, raw.columns), "quarantine"),
                            f"{root}/quarantine", number, (), (), attempt)]
        for job in jobs:
            job.result()
    if files is not None:
        _write(files.select(*FILE_KEY, "rows"), f"{root}/file_ledger", number, attempt=attempt)

    # the quarterly pre-aggregate: this batch's partial sums (store attributes attached)
    written = read_attempt(spark, root, "sales_fact", batch)
    stores = own.rows("dim_store").select("store_sk", "store_id", "store_name")
    preagg.apply_batch(written.join(stores, "store_sk"), f"{root}/store_quarterly_sales", number, attempt)
    if distincts:
        _write(bitmaps.partials(written, own.rows("dim_customer"), own.rows("dim_product")),
               f"{root}/{bitmaps.TABLE}", number, cluster_by=("cube",), attempt=attempt)
    counts = {"rows": rows, "facts": written.count(),
              "rejects": read_attempt(spark, root, "quarantine", batch).count()}
    drop_path(spark, staging)
    return Pending(batch, counts)


def publish(spark: SparkSession, root: str, pending: Pending) -> dict[str, int]:
    """Make a written batch visible to readers, all tables at once; its counters."""
    if pending.batch is not None:
        commits.done(spark, root.rstrip("/"), pending.batch, pending.counts)
    return pending.counts


def load_batch(spark: SparkSession, raw: DataFrame, customers: DataFrame, products: DataFrame,
               root: str, batch_id: int | None = None, suppliers: DataFrame | None = None,
               holidays: DataFrame | None = None,
               cluster_fact_by_date: bool = False,
               micro_batch: bool = False, source: str | None = None,
               offset: str | None = None, replay: bool = False,
               scd2: dict[str, list[str]] | None = None, effective: _dt.date | None = None,
               point_keys: tuple[str, ...] = (), distincts: bool = False, rows: int | None = None) -> dict[str, int]:
    """Load one batch of raw transactions into the star at ``root`` and publish it. Returns
    counters: rows in, facts and rejects written. ``source`` and ``offset`` identify the batch
    (see ``plans.commits``); without them it is a new one, or ``batch_id``, which must be new
    unless ``replay`` says that it is to be replaced. Rows with their file (``_file``) are loaded
    if no batch has loaded that file; the default offset is then a digest of the files, and
    ``replay`` loads the files of one batch again, in its place.

    ``cluster_fact_by_date`` sorts fact rows by date inside each written file (tighter
    row-group statistics for sub-year date filters; measured about +15 % load time at sf0.1,
    so off by default - years are pruned by partition). ``micro_batch`` turns on semi-join
    reductions against masters and dimensions: a small batch then scans, never shuffles,
    big tables (the streaming loader sets it).

    ``scd2`` keeps history: for "customer" or "product" the attributes to track. The load's
    master is then the state of its members from the day ``effective`` on, and every member
    that is new or differs opens a version, published with the batch
    (``WarehouseStar.joined_as_of`` reads facts with the version of their day).

    ``point_keys``: surrogate keys by which single members' facts are asked for. Fact files are
    sorted by the first (unless by date) and have Bloom filters on all, so a slice of a few
    members (``WarehouseStar.of_members``) skips the row groups that lack them.

    ``distincts`` keeps the customers of the cells of five reports as bitmaps
    (``streaming.distincts``). Reports read them once every published batch has them
    (``compact --distincts`` makes those of batches loaded without).

    ``rows``: transactions, about, if the caller knows; exchanges are sized by it (transactions
    with their file are counted)."""
    return publish(spark, root, write_batch(
        spark, raw, customers, products, root, batch_id, suppliers, holidays, cluster_fact_by_date,
        micro_batch, source, offset, replay, scd2, effective, point_keys, distincts, rows))
