"""Command line: load the warehouse from CSV files and run reports on it.

    python -m tidemart load --customers C.csv --products P.csv --transactions DIR \\
        --warehouse ROOT [--stream --checkpoint CK --max-files 1] [--batch-id N]
        [--holidays H.csv] [--replay] [--distincts]
        (the warehouse's log numbers batches; files that are loaded already are left out,
        --replay loads the files of one batch again, in its place)
    python -m tidemart report q05_top_occupations --warehouse ROOT [--as-of 2017-12-31]
        [--year 2017] [--k 5] [--show 20] [--out PATH]
    python -m tidemart ddl --warehouse ROOT [--database DB] [--drop]
    python -m tidemart dq --warehouse ROOT      # exit code 1 when a check fails
    python -m tidemart compact --warehouse ROOT [--keep-old]  # merge the folders of batches
    python -m tidemart vacuum --warehouse ROOT  # remove folders that no reader needs any more
    python -m tidemart bucket --warehouse ROOT --database DB [--buckets N]

Runs on whatever master the session is given (``spark-submit --master ...``); no local
folders are implied - every path is passed in.
"""

from __future__ import annotations

import argparse
import inspect
import json
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema
from .functions import calendar as cal
from .plans import commits, load, reports
from .plans.star import WarehouseStar
from .sources import masters
from .streaming import loader

REPORTS = {n: f for n, f in vars(reports).items()
           if (n.startswith("q") or n.startswith("util_")) and callable(f)}


def _session() -> SparkSession:
    return SparkSession.builder.appName("tidemart").getOrCreate()


def cmd_load(a: argparse.Namespace) -> int:
    spark = _session()
    # masters keep their file order: a repeated key resolves to its first record
    customers = lambda: masters.read_customer_master(spark, a.customers, row_order=True)
    products = lambda: masters.read_product_master(spark, a.products, row_order=True)
    if a.stream:
        import logging

        from .streaming.progress import ProgressLogger
        logging.basicConfig(level=logging.INFO)
        progress = ProgressLogger()
        spark.streams.addListener(progress)
        sch = masters.transaction_schema(spark, a.transactions)
        q = loader.start(spark, a.transactions, sch, a.warehouse, a.checkpoint, customers,
                         products, max_files_per_trigger=a.max_files,
                         available_now=not a.continuous, processing_time=a.trigger, distincts=a.distincts)
        q.awaitTermination()
        print(json.dumps(progress.totals()))
        spark.streams.removeListener(progress)
    else:
        raw = masters.read_transactions(spark, a.transactions)
        holidays = None
        if a.holidays:
            holidays = spark.read.option("header", "true").csv(a.holidays)
            holidays = holidays.select(cal.parse_date(holidays.columns[0]).alias("holiday_date")).dropna()
        print(json.dumps(load.load_batch(
            spark, raw, customers(), products(), a.warehouse, a.batch_id,
            source=f"files:{a.transactions.rstrip('/')}", replay=a.replay, holidays=holidays,
            distincts=a.distincts)))
    return 0


def cmd_report(a: argparse.Namespace) -> int:
    spark = _session()
    fn = REPORTS[a.name]
    params = inspect.signature(fn).parameters
    kw = {}
    for opt in ("as_of", "year", "k"):
        val = getattr(a, opt)
        if val is not None and opt in params:
            kw[opt] = val
    df = fn(WarehouseStar(spark, a.warehouse), **kw)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        rows = df.take(a.show + 1)
        spark.createDataFrame(rows[:a.show], df.schema).show(a.show, truncate=False)
        if len(rows) > a.show:
            print(f"the first {a.show} rows; --show N shows more, --out PATH writes all")
    return 0


def warehouse_checks(spark: SparkSession, root: str) -> dict[str, list[dict]]:
    """The published warehouse checks over a loaded star (DQ-1..5, DQ-8)."""
    from .operators import quality
    from .plans.load import DIM_SPECS

    read = commits.snapshot(spark, root).rows
    fact = read("sales_fact")
    dims = {n: read(f"dim_{n}") for n in ("customer", "product", "store", "supplier", "time")}
    # rows in, as the log counted the raw input of each batch's last run
    log = commits.log(spark, root.rstrip("/")).where("state = 'done'")
    last = log.groupBy("batch_id").agg(F.max_by("rows", "attempt").alias("rows"))
    rows_in = int(last.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])
    out = {
        "completeness": quality.completeness(rows_in, fact, read("quarantine")),
        "orphans": quality.orphans(fact, dims),
        "duplicates": quality.duplicates(
            {f"dim_{n}": (dims[n], bk) for n, (bk, _, _) in DIM_SPECS.items()}
            | {"dim_time": (dims["time"], "transaction_date"), "sales_fact": (fact, "sales_sk")}),
        "nulls": quality.null_counts(fact, "sales_fact", ["order_id", "customer_sk",
                                                          "product_sk", "store_sk",
                                                          "supplier_sk", "date_sk"]),
        "ranges": quality.ranges(fact, ["unit_price", "total_amount", "quantity",
                                        "transaction_date"], "sales_fact"),
        "domains": quality.domains(dims["customer"]),
        "lengths": reduce(DataFrame.unionByName, [
            quality.lengths(read(t), limits, t) for t, limits in schema.VARCHAR.items()]),
    }
    return {k: [r.asDict() for r in v.collect()] for k, v in out.items()}


def cmd_dq(a: argparse.Namespace) -> int:
    res = warehouse_checks(_session(), a.warehouse)
    print(json.dumps(res, default=str, indent=1))
    # value domains are reported; the keys, counts and lengths decide
    bad = (abs(res["completeness"][0]["unaccounted_rows"])
           + sum(r["orphan_rows"] for r in res["orphans"])
           + sum(r["duplicate_keys"] for r in res["duplicates"])
           + sum(r["null_count"] or 0 for r in res["nulls"])
           + sum(r["too_long"] for r in res["lengths"]))
    return 1 if bad else 0


def cmd_bucket(a: argparse.Namespace) -> int:
    from .plans.bucketed import export_bucketed
    for t in export_bucketed(_session(), a.warehouse, a.database, a.buckets):
        print(t)
    return 0


def cmd_compact(a: argparse.Namespace) -> int:
    from .plans.compact import compact
    print(json.dumps(compact(_session(), a.warehouse, keep_old=a.keep_old, point_keys=tuple(a.point_key or ()),
                             distincts=a.distincts)))
    return 0


def cmd_vacuum(a: argparse.Namespace) -> int:
    from .plans.compact import vacuum
    print(json.dumps({"removed": vacuum(_session(), a.warehouse)}))
    return 0


def cmd_ddl(a: argparse.Namespace) -> int:
    spark = _session()
    if a.drop:
        schema.drop_tables(spark, a.database)
        return 0
    for t in schema.create_tables(spark, a.warehouse, a.database):
        print(t)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemart")
    sub = p.add_subparsers(dest="cmd", required=True)
    lp = sub.add_parser("load")
    lp.add_argument("--customers", required=True)
    lp.add_argument("--products", required=True)
    lp.add_argument("--transactions", required=True)
    lp.add_argument("--warehouse", required=True)
    lp.add_argument("--batch-id", type=int)
    lp.add_argument("--stream", action="store_true")
    lp.add_argument("--continuous", action="store_true")
    lp.add_argument("--trigger", default="30 seconds")
    lp.add_argument("--checkpoint")
    lp.add_argument("--max-files", type=int, default=1)
    lp.add_argument("--replay", action="store_true")
    lp.add_argument("--holidays")
    lp.add_argument("--distincts", action="store_true")
    lp.set_defaults(fn=cmd_load)
    rp = sub.add_parser("report")
    rp.add_argument("name", choices=sorted(REPORTS))
    rp.add_argument("--warehouse", required=True)
    rp.add_argument("--as-of", dest="as_of")
    rp.add_argument("--year", type=int)
    rp.add_argument("--k", type=int)
    rp.add_argument("--show", type=int, default=20)
    rp.add_argument("--out")
    rp.set_defaults(fn=cmd_report)
    dp = sub.add_parser("ddl")
    dp.add_argument("--warehouse", required=True)
    dp.add_argument("--database")
    dp.add_argument("--drop", action="store_true")
    dp.set_defaults(fn=cmd_ddl)
    bp = sub.add_parser("bucket")
    bp.add_argument("--warehouse", required=True)
    bp.add_argument("--database", required=True)
    bp.add_argument("--buckets", type=int)
    bp.set_defaults(fn=cmd_bucket)
    cp = sub.add_parser("compact")
    cp.add_argument("--warehouse", required=True)
    cp.add_argument("--keep-old", action="store_true")
    cp.add_argument("--point-key", action="append", choices=["customer_sk", "product_sk", "store_sk", "supplier_sk"])
    cp.add_argument("--distincts", action="store_true")
    cp.set_defaults(fn=cmd_compact)
    vp = sub.add_parser("vacuum")
    vp.add_argument("--warehouse", required=True)
    vp.set_defaults(fn=cmd_vacuum)
    qp = sub.add_parser("dq")
    qp.add_argument("--warehouse", required=True)
    qp.set_defaults(fn=cmd_dq)
    a = p.parse_args(argv)
    if a.cmd == "load" and a.stream and not a.checkpoint:
        p.error("--stream needs --checkpoint")
    return a.fn(a)


if __name__ == "__main__":
    sys.exit(main())
