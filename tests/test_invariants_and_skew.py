
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart.operators import olap
from tidemart.plans import etl
from tidemart.plans import reports as R
from tidemart.sources.testmap import TestTableStar

SF = "/root/testdata/sf0.001"


def test_rows_in_equal_facts_plus_quarantine(spark):
    r = etl.dq_completeness(spark, SF).first()
    assert r["unaccounted_rows"] == 0
    assert r["source_rows"] == r["loaded_rows"] + r["rejected_rows"]
    assert r["rejected_rows"] > 0


def test_rollup_levels_add_up(spark):
    out = R.q17_revenue_rollup(TestTableStar(spark, SF))
    by = {g: (s, n) for g, s, n in out.groupBy("grouping_id").agg(
        F.sum("total_revenue").alias("s"), F.sum("transaction_count").alias("n")).collect()}
    grand = by[15]
    for level in (0, 1, 3, 7):
        assert by[level] == grand


def test_preaggregate_equals_direct_aggregate(spark):
    star = TestTableStar(spark, SF)
    mv = etl.mv_store_quarterly(spark, SF).select(
        "store_name", "year", "quarter", "total_sales", "total_quantity", "transaction_count")
    direct = R.store_quarterly_sales(star).select(
        "store_name", "year", "quarter", "total_sales", "total_quantity", "transaction_count")
    assert mv.exceptAll(direct).count() == 0 and direct.exceptAll(mv).count() == 0


def test_half_years_add_up(spark):
    out = R.q18_half_year_sales(TestTableStar(spark, SF), as_of=dt.date(1998, 6, 1))
    bad = out.where((F.col("h1_revenue") + F.col("h2_revenue") != F.col("yearly_revenue"))
                    | (F.col("h1_quantity") + F.col("h2_quantity") != F.col("yearly_quantity")))
    assert out.count() > 0 and bad.count() == 0


def test_stream_equals_batch(spark):
    a = etl.stream_sales_enriched(spark, SF, files=3)
    b = etl.enrich_sales_batch(spark, SF)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _skew_conf(spark, on: bool):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    if on:
        old = {k: spark.conf.get(k, None) for k in keys}
        for k, v in keys.items():
            spark.conf.set(k, v)
        return old
    return None


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_basket_exact_under_skew_split(spark):
    """One basket holds a third of all lines; AQE splits the skewed join partition and the
    pair counts still equal the brute-force self join."""
    hot = [("HOT", 1, p % 40, Decimal(p % 7 + 1)) for p in range(2000)]
    cold = [(f"o{i}", 2, (i * 7 + j) % 50, Decimal(j + 1)) for i in range(300) for j in range(4)]
    df = spark.createDataFrame(hot + cold, "o string, c int, p int, amt decimal(12,2)")
    old = _skew_conf(spark, True)
    try:
        fast = olap.basket_pairs(df, ["o", "c"], "p", "amt")
        got = {(r["item1"], r["item2"]): (r["frequency"], r["combined_revenue"])
               for r in fast.collect()}
        plan = fast._jdf.queryExecution().executedPlan().toString()
    finally:
        _restore(spark, old)
    a, b = df.alias("a"), df.alias("b")
    brute = (a.join(b, (F.col("a.o") == F.col("b.o")) & (F.col("a.c") == F.col("b.c"))
                    & (F.col("a.p") < F.col("b.p")))
             .groupBy(F.col("a.p").alias("i1"), F.col("b.p").alias("i2"))
             .agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.col("a.amt") + F.col("b.amt")).alias("s")))
    want = {(r["i1"], r["i2"]): (r["n"], r["s"]) for r in brute.collect()}
    assert got == want
    assert "SortMergeJoin(skew=true)" in plan  # the hot basket was split over tasks


def test_hot_customer_exact(spark):
    """A customer with a third of all fact rows: eager aggregation collapses it to one
    row before the customer join; results equal the plain join."""
    star = TestTableStar(spark, SF)
    fact = star.joined()
    # deterministic: about half of the lines are re-assigned to customer 7
    hot = fact.where(F.col("product_sk") % 2 == 0).withColumn("customer_sk",
                                                              F.lit(7).cast("long"))
    skewed = fact.unionByName(hot)

    class SkewStar(TestTableStar):
        def joined(self, *dims, period=None):
            assert not dims and period is None
            return skewed

    old = _skew_conf(spark, True)
    try:
        got = R.q02_customer_demographics(SkewStar(spark, SF)).collect()
    finally:
        _restore(spark, old)
    cust = star.dim("customer")
    plain = skewed.join(cust, "customer_sk").groupBy("gender", "age_group", "city_category") \
        .agg(F.countDistinct("customer_sk").alias("customer_count"),
             F.sum("total_amount").alias("s"), F.count(F.lit(1)).alias("n"))
    want = {(r[0], r[1], r[2]): (r[3], r[4], r[5]) for r in plain.collect()}
    assert {(r["gender"], r["age_group"], r["city_category"]):
            (r["customer_count"], r["total_purchase_amount"], r["transaction_count"])
            for r in got} == want


def test_hot_year_write_is_split(spark, tmp_dir):
    """A year holding most rows is written by several tasks (AQE rebalance splits it),
    a small year by one; every row is written once."""
    import glob
    from tidemart.plans.load import _write
    rows = spark.range(0, 60000).select(
        F.when(F.col("id") < 55000, F.lit(2017)).otherwise(F.lit(2016)).alias("sale_year"),
        F.col("id"), (F.col("id") * 7 % 1000).alias("v"))
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "true"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        _write(rows, f"{tmp_dir}/t", 0, extra_parts=("sale_year",))
    finally:
        _restore(spark, old)
    hot = glob.glob(f"{tmp_dir}/t/batch_id=0/sale_year=2017/*.parquet")
    cold = glob.glob(f"{tmp_dir}/t/batch_id=0/sale_year=2016/*.parquet")
    assert len(hot) > 1 and len(cold) >= 1
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 60000


def test_every_join_and_sum_of_the_rollup_is_dealt_as_sales_grow(spark, monkeypatch):
    """the joins of the sales with orders and products sorted a share of the session's
    partitions each, and the sums behind them took as much again."""
    from __spark_entry__ import queries
    run = lambda: queries()["q17_revenue_rollup"](spark, "/root/testdata/sf0.001")
    want = list(map(repr, run().collect()))
    monkeypatch.setattr(R, "TASK_ROWS", 300)
    monkeypatch.setattr(TestTableStar, "sales", lambda self: 3000)
    df = run()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    for by in ("[l_orderkey", "[o_orderkey", "[product_sk", "[store_sk", "[store_name"):
        assert any(line.strip(" :+-").startswith("RepartitionByExpression " + by) and "10" in line
                   for line in plan.splitlines()), by
    assert list(map(repr, df.collect())) == want


@pytest.mark.parametrize("name", ["q13_supplier_contribution"])
def test_sums_are_dealt_to_more_tasks_as_sales_grow(spark, monkeypatch, name):
    """F8: the exchanges of these sums had the session's partitions whatever the sales."""
    from __spark_entry__ import queries
    plain = queries()[name](spark, "/root/testdata/sf0.001")
    want = sorted(map(repr, plain.collect()))
    monkeypatch.setattr(R, "TASK_ROWS", 300)
    df = queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 2
    assert sorted(map(repr, df.collect())) == want
