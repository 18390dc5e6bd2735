"""History in the load: versions are append-only, facts meet the version of their day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_load_safety import goods, raw

from tidemart.operators import olap, scd2
from tidemart.plans import compact, load
from tidemart.plans.star import WarehouseStar

DAY = lambda y: dt.date(y, 1, 1)


def test_opened_versions_and_the_version_of_a_day(spark):
    schema = "id string, city string, note string, valid_from date, batch_id long, attempt long"
    history = spark.createDataFrame([("a", "X", "1", DAY(2000), 0, 0), ("b", None, "1", DAY(2000), 0, 0),
                                     ("c", "X", "1", DAY(2005), 1, 0), ("c", "Y", "2", DAY(2005), 1, 1)], schema)
    snap = spark.createDataFrame([("a", "Z", "n"), ("b", None, "n"), ("c", "Y", "n"), ("d", "X", "n")], "id string, city string, note string")
    fresh = scd2.opened(history, snap, "id", ["city"], DAY(2010))
    assert sorted((r.id, r.city, r.valid_from) for r in fresh.collect()) == [("a", "Z", DAY(2010)), ("d", "X", DAY(2010))]
    whole = history.unionByName(fresh.withColumn("batch_id", F.lit(2)).withColumn("attempt", F.lit(0)))
    rows = sorted((r.id, r.city, r.valid_from, r.valid_to, r.is_current) for r in scd2.versions(whole, "id").collect())
    assert rows == [("a", "X", DAY(2000), DAY(2010), False), ("a", "Z", DAY(2010), None, True), ("b", None, DAY(2000), None, True),
                    ("c", "Y", DAY(2005), None, True), ("d", "X", DAY(2010), None, True)]
    facts = spark.createDataFrame([(1, "a", dt.date(1999, 5, 5)), (2, "a", dt.date(2009, 12, 31)), (3, "a", DAY(2010)),
                                   (4, "c", DAY(2004)), (5, "e", DAY(2004)), (6, None, DAY(2004))], "n int, id string, day date")
    found = sorted((r.n, r.city) for r in scd2.as_of(facts, whole, "id", "day").collect())
    assert found == [(1, "X"), (2, "X"), (3, "Z"), (4, "Y"), (5, None), (6, None)]


def test_loads_open_versions_and_reports_read_them(spark, tmp_dir):
    root = f"{tmp_dir}/wh"

    def run(n, city, year, write=load.load_batch, offset=None):
        people = spark.createDataFrame([("C1", city), ("C2", "B")], "customer_id string, city_category string")
        rows = raw(spark, (f"o{n}", "C1", "P1", "1", f"{year}-06-01"), (f"p{n}", "C2", "P1", "1", f"{year}-06-01"))
        return write(spark, rows, people, goods(spark), root, source="s", offset=offset or str(n),
                     scd2={"customer": ["city_category"]}, effective=DAY(year))

    def cities():
        df = WarehouseStar(spark, root).joined_as_of("customer", ["city_category"])
        return sorted((r.order_id, r.city_category) for r in df.collect())

    with pytest.raises(ValueError):
        load.load_batch(spark, raw(spark), goods(spark), goods(spark), root, scd2={"store": ["store_name"]}, effective=DAY(2017))
    run(0, "A", 2016)
    run(1, "B", 2017)
    want = [("o0", "A"), ("o1", "B"), ("p0", "B"), ("p1", "B")]
    assert cities() == want
    assert load.read(spark, root, "dim_customer_history").count() == 3  # C2 hasn't changed
    run(2, "C", 2018, write=load.write_batch)  # breaks off
    assert cities() == want
    run(2, "C", 2018)
    run(3, "C", 2019)
    want = sorted([*want, ("o2", "C"), ("p2", "B"), ("o3", "C"), ("p3", "B")])
    assert cities() == want
    run(1, "A", 2017, offset="1")  # a replay says that C1 hadn't moved by then
    want = sorted([("o1", "A") if w[0] == "o1" else w for w in want])
    assert cities() == want
    compact.compact(spark, root)
    assert cities() == want


def test_rollup_levels_from_the_level_below(spark):
    rows = [(a, b, c, i) for i, (a, b, c) in enumerate([("x", "p", 1), ("x", "p", 2), ("x", None, 1), (None, "p", 1), ("y", "q", 3), ("x", "p", 1)])]
    df = spark.createDataFrame(rows, "a string, b string, c int, v int").withColumn("m", F.col("v").cast("decimal(12,2)"))
    out = olap.rollup_report(df, ["a", "b", "c"], {"s": ("m", "sum_money"), "q": ("v", "sum"), "n": ("v", "count")})
    want = df.rollup("a", "b", "c").agg(F.grouping_id().cast("int").alias("grouping_id"), F.sum("m").cast("decimal(22,2)").alias("s"),
                                        F.sum("v").alias("q"), F.count(F.lit(1)).alias("n"))
    assert out.columns == want.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
