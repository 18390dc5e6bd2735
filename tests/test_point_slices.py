"""Slices of single members skip the row groups that lack them."""

from pyspark.sql import functions as F

from tidemart.plans import compact, etl
from tidemart.plans import reports as R
from tidemart.plans.star import WarehouseStar
from tidemart.sources import testmap as tm

SF = "/root/testdata/sf0.001"
KEYS = ["gender", "product_category"]


def read_rows(spark, star):
    """(rows that the fact's scan hands on, plan) for the fact of ``star``."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.parquet.enableVectorizedReader", "true")
    try:
        df = star.fact().select("customer_sk", "product_sk", "total_amount")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves()
        rows = sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
        return rows, plan.toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_customer_reads_few_row_groups(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = conf.get("parquet.block.size")
    conf.set("parquet.block.size", "4096")  # many row groups, as a large file has
    conf.set("parquet.block.size.row.check.min", "100")
    try:
        root = etl.load_test_warehouse(spark, SF, point_keys=("customer_sk", "product_sk"))
    finally:
        conf.unset("parquet.block.size") if old is None else conf.set("parquet.block.size", old)
    star = WarehouseStar(spark, root)
    whole, _ = read_rows(spark, star)
    ids = [r[0] for r in star.dim("customer").orderBy("customer_id").select("customer_id").limit(3).collect()]
    one = star.of_members({"customer_id": ids[0]})
    read, plan = read_rows(spark, one)
    want = star.fact().join(star.dim("customer").where(F.col("customer_id") == ids[0]), "customer_sk").count()
    assert one.fact().count() == want > 0
    assert "EqualTo(customer_sk" in plan or "In(customer_sk" in plan
    assert read < whole / 3, (read, whole)
    for filters in ({"customer_id": ids[0]}, {"customer_id": ids}, {"customer_id": -5}, {"customer_id": None}, {"customer_id": []},
                    {"customer_id": ids, "gender": "M"}, {"customer_id": ids[0], "product_id": "1"},
                    {"customer_id": list(range(5000))}):
        plain = R.olap.slice_dice(star.joined("customer", "product"), filters, KEYS).orderBy(*KEYS).collect()
        assert R.slice_dice(star, filters, KEYS, ("customer", "product")).collect() == plain, filters


def test_compaction_lays_out_for_point_slices(spark):
    raw = tm.raw_transactions(spark, SF)
    root = etl.load_test_warehouse(spark, SF, raw=raw.where("cast(order_id as long) % 2 = 0"))
    customers, products = etl._masters(spark, SF)
    for i, rest in ((1, 1), (2, 3)):
        etl.load.load_batch(spark, raw.where(f"cast(order_id as long) % 4 = {rest}"), customers, products, root, i)
    star = WarehouseStar(spark, root)
    before = star.fact().groupBy("customer_sk").agg(F.sum("total_amount").alias("s")).orderBy("customer_sk").collect()
    assert compact.compact(spark, root, point_keys=("customer_sk",))
    star = WarehouseStar(spark, root)
    assert star.fact().groupBy("customer_sk").agg(F.sum("total_amount").alias("s")).orderBy("customer_sk").collect() == before
    merged = star.snapshot().rows("sales_fact").select("customer_sk", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i"))
    files = {}
    for r in merged.orderBy("f", "i").collect():
        files.setdefault(r.f, []).append(r.customer_sk)
    big = max(files.values(), key=len)
    assert len(big) > 100 and big == sorted(big)
