"""Unit tests of the data-quality operators and multi-step SCD2 on literal inputs."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidemart.operators import quality, scd2


def D(s):
    return dt.date.fromisoformat(s)


def test_orphans_and_duplicates(spark):
    fact = spark.createDataFrame([(1, 10, 1, 1, 20170101), (2, 11, 1, 9, 20170102),
                                  (3, 10, 1, 1, 20170101)],
                                 "customer_sk long, product_sk long, store_sk long, "
                                 "supplier_sk long, date_sk int")
    dims = {"customer": spark.createDataFrame([(1,), (2,)], "customer_sk long"),
            "product": spark.createDataFrame([(10,), (11,)], "product_sk long"),
            "store": spark.createDataFrame([(1,)], "store_sk long"),
            "supplier": spark.createDataFrame([(1,)], "supplier_sk long"),
            "time": spark.createDataFrame([(20170101,)], "date_sk int")}
    got = {r["fk_column"]: r["orphan_rows"] for r in quality.orphans(fact, dims).collect()}
    assert got == {"customer_sk": 1, "product_sk": 0, "store_sk": 0, "supplier_sk": 1,
                   "date_sk": 1}
    master = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("c",), ("c",)], "k string")
    d = quality.duplicates({"m": (master, "k")}).first()
    assert (d["duplicate_keys"], d["excess_rows"]) == (2, 3)


def test_nulls_ranges_domains(spark):
    df = spark.createDataFrame([(1, None, Decimal("2.50"), D("2017-01-02")),
                                (None, "x", Decimal("9.99"), D("2016-05-01"))],
                               "a int, b string, p decimal(10,2), d date")
    nulls = {r["column_name"]: r["null_count"] for r in
             quality.null_counts(df, "t", ["a", "b", "p"]).collect()}
    assert nulls == {"a": 1, "b": 1, "p": 0}
    rng = {r["column_name"]: (r["min_value"], r["max_value"]) for r in
           quality.ranges(df, ["p", "d"], "t").collect()}
    assert rng == {"p": ("2.50", "9.99"), "d": ("2016-05-01", "2017-01-02")}
    cust = spark.createDataFrame([("F", "26-35", 3, "A", 0), ("MM", "99+", 21, "D", 2)],
                                 "gender string, age_group string, occupation int, "
                                 "city_category string, marital_status int")
    dom = {r["rule"]: r["violations"] for r in quality.domains(cust).collect()}
    assert dom == {"gender_char1": 1, "city_category_char1": 1, "occupation_range": 1,
                   "age_group_band": 1, "marital_status_flag": 1}


def test_scd2_three_snapshots(spark):
    s1 = spark.createDataFrame([("C1", "A"), ("C2", "B")], "id string, city string")
    h = scd2.initial(s1, "id", F.lit(D("2017-01-01")))
    # day 5: C1 moves, C3 appears, C2 absent from the snapshot (kept as is)
    s2 = spark.createDataFrame([("C1", "B"), ("C3", "C")], "id string, city string")
    h = scd2.merge(h, s2, "id", ["city"], D("2017-01-05"))
    # day 9: C1 moves back, C3 unchanged
    s3 = spark.createDataFrame([("C1", "A"), ("C3", "C")], "id string, city string")
    h = scd2.merge(h, s3, "id", ["city"], D("2017-01-09"))
    rows = sorted((r["id"], r["city"], r["valid_from"], r["valid_to"], r["is_current"])
                  for r in h.collect())
    assert rows == [
        ("C1", "A", D("2017-01-01"), D("2017-01-05"), False),
        ("C1", "A", D("2017-01-09"), None, True),
        ("C1", "B", D("2017-01-05"), D("2017-01-09"), False),
        ("C2", "B", D("2017-01-01"), None, True),
        ("C3", "C", D("2017-01-05"), None, True),
    ]
    # exactly one current row per key
    assert h.where("is_current").groupBy("id").count().where("count > 1").count() == 0


def test_scd2_null_safe_compare(spark):
    s1 = spark.createDataFrame([("C1", None)], "id string, city string")
    h = scd2.initial(s1, "id", F.lit(D("2017-01-01")))
    same = scd2.merge(h, s1, "id", ["city"], D("2017-01-02"))
    assert same.count() == 1  # NULL == NULL: no new version
