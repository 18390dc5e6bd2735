"""What a load exchanges and writes for each sale (findings F3 to F6 of round 3)."""

import glob

import pytest
from pyspark.sql import functions as F

from tidemart import session
from tidemart.operators import cleanse
from tidemart.plans import etl, load
from tidemart.sources import masters
from tidemart.sources import testmap as tm

SF = "/root/testdata/sf0.001"
FACT = ["order_id", "customer_id", "product_id", "store_id", "supplier_id", "date_sk", "quantity", "unit_price", "total_amount"]


def _rows(df):
    return sorted(map(repr, df.select(*FACT).collect()))


def test_exchanges_grow_with_the_rows_for_the_time_of_a_load(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.sized_exchanges(spark, 40 * session.TASK_ROWS + 1):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "41"
    for rows in (None, 0, 1):  # never fewer
        with session.sized_exchanges(spark, rows):
            assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with pytest.raises(ZeroDivisionError), session.sized_exchanges(spark, 40 * session.TASK_ROWS):
        raise ZeroDivisionError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_exchanges_of_the_master_joins_carry_no_parsed_values(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = cleanse.classify(tm.raw_transactions(spark, SF), tm.customer_master(spark, SF), tm.product_master(spark, SF)) \
            ._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("quantity_text") < plan.index("Join LeftOuter") < plan.rindex("Join LeftOuter")
    assert "quantity_text" not in plan[plan.index("Join LeftOuter"):]


def test_orders_are_dealt_to_files_in_the_exchange_of_their_join(spark, tmp_dir):
    """The lines took an exchange of their own to the files, and were written as plain text."""
    raw = tm.raw_transactions(spark, SF, tasks=3)
    assert "RoundRobin" not in raw._jdf.queryExecution().executedPlan().toString()
    masters.write_transactions_csv(raw, f"{tmp_dir}/tx")
    assert len(glob.glob(f"{tmp_dir}/tx/*.csv.gz")) == 3
    got = masters.read_transactions(spark, f"{tmp_dir}/tx")
    files = got.select("order_id", "_file.path").distinct()
    assert files.count() == files.select("order_id").distinct().count()
    cols = tm.raw_transactions(spark, SF).columns
    want = tm.raw_transactions(spark, SF).select(*[F.col(c).cast("string").alias(c) for c in cols])
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.collect()))


def test_a_large_batch_is_written_without_an_exchange_by_year(spark, monkeypatch):
    """Nor is its fact joined by the staging task, whose key put half of a batch into one task."""
    plans = []
    write = load._write

    def spy(df, path, *args, **kw):
        if path.endswith("/sales_fact"):
            plans.append((df._jdf.queryExecution().optimizedPlan().toString(), args[-1] if args else kw))
        return write(df, path, *args, **kw)

    monkeypatch.setattr(load, "_write", spy)
    want = _rows(etl.business_fact(spark, etl.load_test_warehouse(spark, SF)))
    monkeypatch.setattr(load, "UNDEALT_ROWS", 1)
    root = etl.load_test_warehouse(spark, SF)
    assert _rows(etl.business_fact(spark, root)) == want
    assert [deal for _, deal in plans] == [True, False]
    assert all("strategy=broadcast" in plan for plan, _ in plans)
    fact = load.read(spark, root, "sales_fact")
    assert fact.where(F.year("transaction_date") != F.col("sale_year")).isEmpty()


def test_the_fact_is_dealt_to_more_tasks_for_its_large_dimensions(spark, monkeypatch):
    root = etl.load_test_warehouse(spark, SF)
    want = _rows(etl.business_fact(spark, root))
    monkeypatch.setattr(etl, "TASK_ROWS", 300)
    df = etl.business_fact(spark, root)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 4
    assert _rows(df) == want
