"""Customers of report cells, kept as bitmaps: exact against a count of the facts."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart import schema
from tidemart.plans import commits, compact, etl, load
from tidemart.plans import reports as R
from tidemart.plans.star import WarehouseStar
from tidemart.sources import testmap as tm
from tidemart.streaming import distincts

SF = "/root/testdata/sf0.001"
REPORTS = (R.q02_customer_demographics, R.q03_category_by_occupation, R.q07_stay_duration_gender,
           R.q08_top_cities_category, R.q14_seasonal_category)


class PlainStar(WarehouseStar):
    """The same warehouse without its bitmaps."""

    def customer_cube(self, cube):
        return None


def equal_reports(spark, root):
    kept, plain = WarehouseStar(spark, root), PlainStar(spark, root)
    for report in REPORTS:
        a, b = report(kept), report(plain)
        assert a.schema.names == b.schema.names
        assert [f.dataType for f in a.schema] == [f.dataType for f in b.schema], report
        assert a.collect() == b.collect(), report
    return kept


def batch(spark, root, share, offset, **kw):
    customers, products = etl._masters(spark, SF)
    raw = tm.raw_transactions(spark, SF).where(F.col("order_id").cast("long") % 4 == share)
    sup = tm.supplier_master(spark, SF).withColumn("supplier_id", F.col("supplier_id").cast("int"))
    return load.load_batch(spark, raw, customers, products, root, suppliers=sup, source="s", offset=offset, **kw)


def reads_facts(star):
    return any("sales_fact" in f for f in R.q02_customer_demographics(star).inputFiles())


def test_reports_from_bitmaps_through_batches_replays_and_compaction(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    for share in (0, 1, 2, 0):  # batch 0 is replayed
        batch(spark, root, share, str(share), distincts=True)
    star = equal_reports(spark, root)
    assert not reads_facts(star)
    # an attempt that isn't published shows nowhere
    customers, products = etl._masters(spark, SF)
    load.write_batch(spark, tm.raw_transactions(spark, SF).limit(50), customers, products, root, source="s", offset="x",
                     distincts=True)
    assert not reads_facts(equal_reports(spark, root))
    assert compact.compact(spark, root)["customer_bitmaps"] == 3
    star = equal_reports(spark, root)
    assert not reads_facts(star)
    low = star.snapshot().rows("customer_bitmaps").where("attempt > 0 AND batch_id = 2")
    assert low.count() == low.select("cube", *distincts.ATTRS, "bucket").distinct().count() > 0
    # a batch without them: reports go back to the facts, whole, until a compaction makes them
    batch(spark, root, 3, "3")
    assert reads_facts(equal_reports(spark, root))
    batch(spark, root, 3, "4", distincts=True)
    assert reads_facts(equal_reports(spark, root))
    assert compact.compact(spark, root, distincts=True)
    assert not reads_facts(equal_reports(spark, root))


def test_old_state_and_slices_go_to_the_facts(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    batch(spark, root, 0, "0", distincts=True)
    old = WarehouseStar(spark, root)
    before = R.q14_seasonal_category(old).collect()
    batch(spark, root, 1, "1", distincts=True)
    assert R.q14_seasonal_category(old).collect() == before  # its snapshot stays
    some = old.dim("customer").first()["customer_id"]
    assert old.of_members({"customer_id": some}).customer_cube("season") is None
    assert commits.published_facts(old.snapshot()) == old.fact().count()
    assert commits.published_facts(old.snapshot(refresh=True)) == old.fact().count()


def test_bitmaps_against_brute_force(spark):
    """Keys on both sides of a bucket's edge, null attributes, repeated and shared customers."""
    rng = random.Random(5)
    keys = [1, 2, 32767, 32768, 32769, 65536, 65537, 10**9]
    attrs = {k: (rng.choice(["M", "F", None]), rng.choice(["A", "B", None]), rng.choice([1, 2, None])) for k in keys}
    customers = spark.createDataFrame(
        [(k, g, "18-25", c, o, 1) for k, (g, c, o) in attrs.items()],
        "customer_sk long, gender string, age_group string, city_category string, occupation int, "
        "stay_in_current_city_years int")
    products = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "product_sk long, product_category string")
    sales = [(rng.choice(keys), rng.choice([1, 2, 3]), f"1997-{rng.randint(1, 12):02d}-03", 2, i % 7) for i in range(300)]
    fact = spark.createDataFrame(sales, "customer_sk long, product_sk long, d string, quantity int, total_amount int").select(
        "customer_sk", "product_sk", F.to_date("d").alias("transaction_date"), "quantity",
        F.col("total_amount").cast("decimal(12,2)").alias("total_amount"))
    halves = [distincts.partials(fact.where(c), customers, products) for c in ("customer_sk % 2 = 0", "customer_sk % 2 = 1")]
    whole = distincts.partials(fact.where("quantity > 5"), customers, products)  # nothing
    rows = halves[0].unionByName(halves[1]).unionByName(whole).unionByName(distincts.partials(fact, customers, products))
    assert [f.name for f in rows.schema] == schema.CUSTOMER_BITMAPS.names
    season = lambda d: {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring",
                        6: "Summer", 7: "Summer", 8: "Summer"}.get(int(d[5:7]), "Fall")
    for merged in (rows, distincts.merged(rows)):
        for cube, names in distincts.CUBES.items():
            want = {}
            for c, p, d, q, t in sales:
                g, city, o = attrs[c]
                at = dict(gender=g, age_group="18-25", city_category=city, occupation=o, stay_in_current_city_years=1,
                          product_category={1: "x", 2: "y", 3: None}[p], season=season(d))
                cell = want.setdefault(tuple(at[n] for n in names), [set(), 0, 0, 0])
                cell[0].add(c)
                for i, v in ((1, t), (2, q), (3, 1)):
                    cell[i] += 2 * v
            got = {tuple(r[n] for n in names): [r["customers"], int(r["_s"]), r["_q"], r["_n"]]
                   for r in distincts.cells(merged, cube).collect()}
            assert got == {k: [len(v[0]), *v[1:]] for k, v in want.items()}, cube


def test_no_rows(spark, tmp_dir):
    empty = spark.createDataFrame([], schema.CUSTOMER_BITMAPS)
    assert distincts.covered(empty) == 0
    assert distincts.cells(empty, "season").count() == 0
    fact = spark.createDataFrame([], T.StructType(schema.SALES_FACT.fields))
    members = [spark.createDataFrame([], s) for s in (schema.DIM_CUSTOMER, schema.DIM_PRODUCT)]
    assert distincts.partials(fact, *members).count() == 0


def test_a_cell_is_built_behind_one_exchange_of_its_rows(spark):
    star = tm.TestTableStar(spark, SF)
    plan = distincts.partials(star.fact(), star.dim("customer"), star.dim("product"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    bitmaps = [line for line in text.splitlines() if "bitmap_construct_agg" in line]
    # partial and final aggregate stand in one stage: no bitmap is exchanged
    first, last = text.index(bitmaps[0]), text.index(bitmaps[-1])
    assert "Exchange" not in text[first:last]
