"""Loads that must lose nothing: replays, odd values, rejects only, other columns, hot keys."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemart.__main__ import main, warehouse_checks
from tidemart.operators import cleanse, scd2
from tidemart.plans import load
from tidemart.sources import masters

RAW = "order_id string, customer_id string, product_id string, quantity string, date string"
PRODUCT = ("product_id string, product_category string, price double, store_id string, store_name string, "
           "supplier_id string, supplier_name string")


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def people(spark, *ids):
    return spark.createDataFrame([(i, "F") for i in ids], "customer_id string, gender string")


def goods(spark, *rows):
    rows = rows or (("P1", "x", 10.0, "1", "S", "1", "Sup"),)
    return spark.createDataFrame(list(rows), PRODUCT)


def facts(spark, root):
    return sorted((r.order_id, r.batch_id) for r in load.read(spark, root, "sales_fact").collect())


def test_a_used_batch_id_is_refused_and_nothing_is_lost(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    load.load_batch(spark, raw(spark, ("o1", "C1", "P1", "1", "2017-01-01"), ("o2", "C2", "P1", "1", "2018-01-01")),
                    people(spark, "C1", "C2"), goods(spark), root, 0)
    with pytest.raises(ValueError):
        load.load_batch(spark, raw(spark, ("o3", "C9", "P1", "1", "2017-01-01")), people(spark, "C9"), goods(spark), root, 0)
    load.load_batch(spark, raw(spark, ("o3", "C9", "P1", "1", "2017-01-01")), people(spark, "C9"), goods(spark), root)
    assert facts(spark, root) == [("o1", 0), ("o2", 0), ("o3", 1)]
    keys = [(r.customer_id, r.customer_sk) for r in load.read(spark, root, "dim_customer").collect()]
    assert sorted(keys) == [("C1", 1), ("C2", 2), ("C9", 3)]


def test_a_replay_replaces_the_whole_batch(spark, tmp_dir):
    """The master has grown meanwhile and a year has become empty."""
    root = f"{tmp_dir}/wh"
    load.load_batch(spark, raw(spark, ("o1", "C1", "P1", "1", "2017-01-01"), ("o2", "C5", "P1", "1", "2018-01-01")),
                    people(spark, "C1"), goods(spark), root, source="s", offset="0")
    load.load_batch(spark, raw(spark, ("o3", "C3", "P1", "1", "2017-01-01")), people(spark, "C3"), goods(spark), root,
                    source="s", offset="1")
    counts = load.load_batch(spark, raw(spark, ("o2", "C5", "P1", "1", "2018-01-01")), people(spark, "C1", "C5"),
                             goods(spark), root, source="s", offset="0")
    assert counts == {"rows": 1, "facts": 1, "rejects": 0}
    assert facts(spark, root) == [("o2", 0), ("o3", 1)]
    assert load.read(spark, root, "quarantine").count() == 0
    keys = dict((r.customer_id, r.customer_sk) for r in load.read(spark, root, "dim_customer").collect())
    assert len(set(keys.values())) == 3 and keys["C1"] == 1  # members keep their keys
    checks = warehouse_checks(spark, root)
    assert checks["completeness"][0]["unaccounted_rows"] == 0
    assert all(r["orphan_rows"] == 0 for r in checks["orphans"])
    assert all(r["duplicate_keys"] == 0 for r in checks["duplicates"])


def test_values_that_do_not_fit_reject_their_row_only(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    products = goods(spark, ("P1", "x", 10.0, "1", "S", "1", "Sup"), ("P2", "x", 1e12, "1", "S", "1", "Sup"),
                     ("P3", "x", 1.0, "none", "S", "1", "Sup"), ("P4", "x", 1.0, "1", "S", None, "Sup"))
    rows = [(f"o{i}", "C1", p, q, "2017-01-01") for i, (p, q) in enumerate(
        [("P1", "1"), ("P1", "2000000000"), ("P2", "1"), ("P3", "1"), ("P4", "1"), ("P9", "1")])]
    counts = load.load_batch(spark, raw(spark, *rows), people(spark, "C1"), products, root)
    assert counts == {"rows": 6, "facts": 1, "rejects": 5}
    found = {r.order_id: r.reject_reason for r in load.read(spark, root, "quarantine").collect()}
    assert found == {"o1": "bad_amount", "o2": "bad_price", "o3": "bad_store", "o4": "bad_supplier",
                     "o5": "unknown_product"}


def test_a_first_batch_of_rejects_only_and_a_clean_load(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    counts = load.load_batch(spark, raw(spark, ("o1", "C1", "P1", "x", "2017-01-01")), people(spark, "C1"), goods(spark), root)
    assert counts == {"rows": 1, "facts": 0, "rejects": 1}
    assert main(["dq", "--warehouse", root]) == 0
    other = f"{tmp_dir}/clean"
    load.load_batch(spark, raw(spark, ("o1", "C1", "P1", "3", "2017-01-01")), people(spark, "C1"), goods(spark), other)
    assert main(["dq", "--warehouse", other]) == 0


def test_other_columns_of_a_file_are_ignored(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "t.csv"), "w") as f:
        f.write("orderID,price,Customer_ID,Gender,Product_ID,quantity,date,_row\no1,5,C1,M,P1,2,2017-01-01,9\n")
    rows = masters.read_transactions(spark, os.path.join(tmp_dir, "t.csv"))
    root = f"{tmp_dir}/wh"
    assert load.load_batch(spark, rows, people(spark, "C1"), goods(spark), root)["facts"] == 1
    assert load.read(spark, root, "sales_fact").first().unit_price == 10
    assert load.read(spark, root, "dim_customer").first().gender == "F"


def test_tables_have_the_types_of_the_schema(spark, tmp_dir):
    from tidemart import schema
    root = f"{tmp_dir}/wh"
    load.load_batch(spark, raw(spark, ("o1", "C1", "P1", "3", "2017-01-01")), people(spark, "C1"), goods(spark), root)
    spark.sql("CREATE DATABASE IF NOT EXISTS tidemart_types")
    try:
        for table in schema.create_tables(spark, root, "tidemart_types"):
            spark.sql(f"SELECT * FROM {table}").collect()
            name = table.split(".")[1]
            folder = f"{root}/{name}"
            if os.path.isdir(folder):
                stored = {f.name: f.dataType for f in spark.read.parquet(folder).schema.fields}
                want = {f.name: f.dataType for f in schema.TABLES[name][0].fields}
                assert {k: stored[k] for k in want if k in stored} == {k: v for k, v in want.items() if k in stored}
        row = spark.sql("SELECT * FROM tidemart_types.sales_fact").first()
        assert row.sales_sk == 1 and row.created_date is not None
        assert main(["ddl", "--warehouse", root, "--database", "tidemart_types", "--drop"]) == 0
        assert spark.sql("SHOW TABLES IN tidemart_types").where("NOT isTemporary").count() == 0
    finally:
        spark.sql("DROP DATABASE tidemart_types CASCADE")


def test_a_hot_unknown_customer_is_split(spark):
    """Half of the rows name a customer that the master lacks: adaptive execution splits it."""
    rows = spark.range(40000).select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("id") % 2 == 0, "UNKNOWN").otherwise((F.col("id") % 997).cast("string")).alias("customer_id"),
        F.lit("P1").alias("product_id"), F.lit("1").alias("quantity"), F.lit("2017-01-01").alias("date"))
    people_ = spark.range(997).select(F.col("id").cast("string").alias("customer_id"), F.lit("F").alias("gender"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = cleanse.classify(rows, people_, goods(spark))
        counts = {r.reject_reason: r.n for r in out.groupBy("reject_reason").agg(F.count("*").alias("n")).collect()}
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert counts == {"unknown_customer": 20000, "ok": 20000}
    assert "skew=true" in plan


def test_scd2_keeps_other_columns_and_numbers_versions(spark):
    day = lambda n: dt.date(2017, 1, n)
    first = spark.createDataFrame([("C1", "A", "x"), ("C2", "B", "y")], "id string, city string, note string")
    hist = scd2.initial(first, "id", F.lit(day(1)))
    second = spark.createDataFrame([("C1", "B", "x2"), ("C2", "B", "y2")], "id string, city string, note string")
    out = scd2.merge(hist, second, "id", ["city"], day(5))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    rows = sorted((r.id, r.city, r.note, r.is_current, r.version_sk) for r in scd2.with_version_keys(out, "id").collect())
    assert rows == [("C1", "A", "x", False, 1), ("C1", "B", "x2", True, 2), ("C2", "B", "y2", True, 3)]


def test_compaction_keeps_answers_and_refuses_old_replays(spark, tmp_dir, capsys):
    from tidemart.plans import reports as R
    from tidemart.plans.star import WarehouseStar
    root = f"{tmp_dir}/wh"

    def run(n, source="s"):
        rows = raw(spark, (f"o{n}", f"C{n % 3}", "P1", str(n + 1), f"201{6 + n % 3}-02-03"), (f"x{n}", "none", "P1", "1", "2017-01-01"))
        return load.load_batch(spark, rows, people(spark, "C0", "C1", "C2"), goods(spark), root, source=source, offset=str(n))

    def answers():
        star = WarehouseStar(spark, root)
        return [sorted(map(tuple, f(star).collect()), key=str) for f in (R.q02_customer_demographics, R.q17_revenue_rollup,
                                                                R.q20_store_quarterly_view, R.util_revenue_summary)]

    for n in range(4):
        run(n)
    before, checks = answers(), warehouse_checks(spark, root)
    keys = sorted(r.sales_sk for r in load.read(spark, root, "sales_fact").collect())
    assert main(["compact", "--warehouse", root]) == 0
    assert sorted(os.listdir(f"{root}/sales_fact")) == ["batch_id=2", "batch_id=3"]
    assert answers() == before and warehouse_checks(spark, root) == checks
    assert sorted(r.sales_sk for r in load.read(spark, root, "sales_fact").collect()) == keys
    with pytest.raises(ValueError):
        run(1)
    assert run(3)["facts"] == 1 and answers() == before  # the newest batch can be replayed
    run(4)
    run(5, "other")
    before = answers()
    assert main(["compact", "--warehouse", root]) == 0
    assert sorted(os.listdir(f"{root}/sales_fact")) == ["batch_id=3", "batch_id=4", "batch_id=5"]
    assert answers() == before and warehouse_checks(spark, root)["completeness"][0]["unaccounted_rows"] == 0
    capsys.readouterr()


def test_lines_without_an_order_id_are_no_basket(spark, tmp_dir):
    from tidemart.plans import reports as R
    from tidemart.plans.star import WarehouseStar
    root = f"{tmp_dir}/wh"
    products = goods(spark, ("P1", "x", 10.0, "1", "S", "1", "Sup"), ("P2", "x", 5.0, "1", "S", "1", "Sup"))
    rows = [("", "C1", "P1", "1", "2017-01-01"), ("", "C1", "P2", "1", "2018-01-01"),
            ("o1", "C1", "P1", "1", "2017-01-01"), ("o1", "C1", "P2", "2", "2017-01-01")]
    assert load.load_batch(spark, raw(spark, *rows), people(spark, "C1"), products, root)["facts"] == 4
    pairs = R.q16_product_affinity(WarehouseStar(spark, root)).collect()
    assert [(r.frequency_purchased_together, r.combined_revenue) for r in pairs] == [(1, 20)]
