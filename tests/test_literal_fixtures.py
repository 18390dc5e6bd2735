"""Unit tests on the literal fixtures of FIXTURES.md section 3."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidemart.functions import calendar as cal
from tidemart.operators import olap, scd2


def D(s):
    return dt.date.fromisoformat(s)


def test_f3_calendar(spark):
    rows = [(D("2017-01-01"),), (D("2017-03-01"),), (D("2016-02-29"),), (D("2017-12-30"),),
            (D("2017-11-30"),)]
    df = spark.createDataFrame(rows, "d date").select(*cal.calendar_columns("d"))
    got = {r["transaction_date"]: (r["quarter"], r["day_of_week"], r["is_weekend"], r["season"])
           for r in df.collect()}
    assert got[D("2017-01-01")] == (1, 6, 1, "Winter")
    assert got[D("2017-03-01")] == (1, 2, 0, "Spring")
    assert got[D("2016-02-29")] == (1, 0, 0, "Winter")
    assert got[D("2017-12-30")] == (4, 5, 1, "Winter")
    assert got[D("2017-11-30")] == (4, 3, 0, "Fall")
    r = df.where(F.col("transaction_date") == D("2017-01-01")).first()
    assert r["date_sk"] == 20170101 and r["month_name"] == "January" and r["day_name"] == "Sunday"


def test_f4_month_boundaries(spark):
    start = cal.months_back_start(D("2017-07-01"), 6)
    assert start == D("2017-01-01")
    df = spark.createDataFrame([(D("2017-01-31"),), (D("2016-12-31"),), (D("2017-08-01"),)],
                               "d date")
    kept = {r["d"] for r in df.where(F.col("d") >= F.lit(start)).collect()}
    assert kept == {D("2017-01-31"), D("2017-08-01")}
    diffs = {r["d"]: r["n"] for r in df.select(
        "d", cal.month_boundaries_between("d", F.lit(D("2017-07-01"))).alias("n")).collect()}
    assert diffs == {D("2017-01-31"): 6, D("2016-12-31"): 7, D("2017-08-01"): -1}


def test_f5_growth(spark):
    rows = [("c", 2017, 1, Decimal("100")), ("c", 2017, 2, Decimal("150")),
            ("c", 2017, 4, Decimal("75")), ("c", 2017, 5, Decimal("0")),
            ("c", 2017, 6, Decimal("10"))]
    df = spark.createDataFrame(rows, "k string, y int, m int, v decimal(22,2)")
    out = olap.period_growth(df, ["k"], ["y", "m"], "v", "prev", "g").orderBy("m").collect()
    assert [r["g"] for r in out] == [0.0, 50.0, -50.0, -100.0, None]
    assert out[2]["prev"] == Decimal("150.00")  # the gap month is skipped


def test_f6_spikes(spark):
    rows = [("P", 1, Decimal("1")), ("P", 2, Decimal("1")), ("P", 3, Decimal("1")),
            ("P", 4, Decimal("9")), ("R", 1, Decimal("1")), ("R", 2, Decimal("1")),
            ("R", 3, Decimal("4"))]
    df = spark.createDataFrame(rows, "p string, d int, v decimal(22,2)")
    out = olap.revenue_spikes(df, "p", "v", 2).collect()
    assert len(out) == 1 and out[0]["p"] == "P" and out[0]["v"] == Decimal("9.00")
    assert out[0]["avg_daily_sales"] == 3.0


def test_f7_basket(spark):
    rows = [("O", "C", "A", Decimal("10")), ("O", "C", "A", Decimal("20")),
            ("O", "C", "B", Decimal("5")), ("Q", "C1", "A", Decimal("1")),
            ("Q", "C2", "B", Decimal("1"))]
    df = spark.createDataFrame(rows, "o string, c string, p string, amt decimal(12,2)")
    out = olap.basket_pairs(df, ["o", "c"], "p", "amt").collect()
    assert len(out) == 1
    r = out[0]
    assert (r["item1"], r["item2"], r["frequency"], r["combined_revenue"]) == \
        ("A", "B", 2, Decimal("40.00"))


def test_f7_basket_matches_self_join(spark):
    rows = [(o, "c", p, Decimal(str(a))) for o, p, a in
            [(1, 3, 5), (1, 3, 7), (1, 4, 1), (1, 5, 2), (2, 3, 1), (2, 5, 9), (2, 5, 3)]]
    df = spark.createDataFrame(rows, "o int, c string, p int, amt decimal(12,2)")
    fast = {(r["item1"], r["item2"]): (r["frequency"], r["combined_revenue"])
            for r in olap.basket_pairs(df, ["o", "c"], "p", "amt").collect()}
    a, b = df.alias("a"), df.alias("b")
    brute = (a.join(b, (F.col("a.o") == F.col("b.o")) & (F.col("a.c") == F.col("b.c"))
                    & (F.col("a.p") < F.col("b.p")))
             .groupBy(F.col("a.p").alias("i1"), F.col("b.p").alias("i2"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("a.amt") + F.col("b.amt")).alias("s")))
    slow = {(r["i1"], r["i2"]): (r["n"], r["s"]) for r in brute.collect()}
    assert fast == slow


def test_f8_rollup(spark):
    rows = [("S1", "X", "cat", 2017, Decimal("1")), (None, "X", "cat", 2017, Decimal("2"))]
    df = spark.createDataFrame(rows, "store string, sup string, cat string, y int, amt decimal(12,2)")
    out = olap.rollup_report(df, ["store", "sup", "cat", "y"],
                             {"rev": ("amt", "sum_money"), "n": ("amt", "count")}).collect()
    assert len(out) == 9
    levels = sorted(r["grouping_id"] for r in out)
    assert levels == [0, 0, 1, 1, 3, 3, 7, 7, 15]
    total = [r for r in out if r["grouping_id"] == 15][0]
    assert total["rev"] == Decimal("3.00") and total["n"] == 2


def test_f9_scd2(spark):
    snap1 = spark.createDataFrame([("C1", "A"), ("C2", "B")], "id string, city string")
    hist = scd2.initial(snap1, "id", F.lit(D("2017-01-01")))
    snap2 = spark.createDataFrame([("C1", "B"), ("C2", "B")], "id string, city string")
    out = scd2.merge(hist, snap2, "id", ["city"], D("2017-01-05")).collect()
    rows = sorted((r["id"], r["city"], r["valid_from"], r["valid_to"], r["is_current"]) for r in out)
    assert rows == [("C1", "A", D("2017-01-01"), D("2017-01-05"), False),
                    ("C1", "B", D("2017-01-05"), None, True),
                    ("C2", "B", D("2017-01-01"), None, True)]
