"""Loads are published in one step, files are loaded once, the log and the pre-aggregate stay small."""

import os

import pytest
from pyspark.sql import functions as F
from test_load_safety import facts, goods, people, raw

from tidemart.__main__ import main, warehouse_checks
from tidemart.plans import commits, compact, load
from tidemart.plans import reports as R
from tidemart.plans.star import WarehouseStar
from tidemart.sources import masters
from tidemart.streaming import loader, preagg

REPORTS = (R.q02_customer_demographics, R.q17_revenue_rollup, R.q20_store_quarterly_view, R.util_revenue_summary,
           R.util_table_counts)


def answers(spark, root):
    star = WarehouseStar(spark, root)
    return [sorted(map(tuple, f(star).collect()), key=str) for f in REPORTS]


def batch(spark, root, n, write=load.load_batch, source="s", customer=None):
    c = customer or f"C{n}"
    return write(spark, raw(spark, (f"o{n}", c, "P1", "1", f"201{n % 3 + 6}-01-01"), (f"x{n}", "none", "P1", "1", "2017-01-01")),
                 people(spark, c), goods(spark), root, source=source, offset=str(n))


def test_a_load_that_breaks_off_is_invisible_and_runs_again(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    batch(spark, root, 0)
    before, checks = answers(spark, root), warehouse_checks(spark, root)
    pending = batch(spark, root, 1, write=load.write_batch)
    assert os.path.isdir(f"{root}/sales_fact/batch_id=1/attempt=0")  # all is written, nothing shows
    assert answers(spark, root) == before and warehouse_checks(spark, root) == checks
    # another batch goes ahead; the failed one's members and keys are free for it
    batch(spark, root, 2)
    keys = {r.customer_id: r.customer_sk for r in load.read(spark, root, "dim_customer").collect()}
    assert keys == {"C0": 1, "C2": 2}
    again = batch(spark, root, 1)
    assert again == {"rows": 2, "facts": 1, "rejects": 1} == pending.counts
    assert facts(spark, root) == [("o0", 0), ("o1", 1), ("o2", 2)]
    keys = {r.customer_id: r.customer_sk for r in load.read(spark, root, "dim_customer").collect()}
    assert keys == {"C0": 1, "C2": 2, "C1": 3}
    checks = warehouse_checks(spark, root)
    assert checks["completeness"][0]["unaccounted_rows"] == 0
    assert all(r["orphan_rows"] == 0 for r in checks["orphans"]) and all(r["duplicate_keys"] == 0 for r in checks["duplicates"])


def test_a_star_keeps_its_snapshot_and_a_broken_replay_changes_nothing(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    batch(spark, root, 0)
    star = WarehouseStar(spark, root)
    assert star.fact().count() == 1
    batch(spark, root, 1)
    assert star.fact().count() == 1 and star.dim("customer").count() == 1
    assert star.snapshot(refresh=True).rows("sales_fact").count() == 2
    before = answers(spark, root)
    batch(spark, root, 1, write=load.write_batch, customer="C9")  # a replay that isn't published
    assert answers(spark, root) == before
    batch(spark, root, 1, customer="C9")
    assert facts(spark, root) == [("o0", 0), ("o1", 1)]
    members = {r.customer_id for r in load.read(spark, root, "dim_customer").collect()}
    assert members == {"C0", "C1", "C9"}  # those of the attempt before stay


def test_the_catalog_shows_published_batches_only(spark, tmp_dir):
    from tidemart import schema
    root = f"{tmp_dir}/wh"
    batch(spark, root, 0)
    batch(spark, root, 1, write=load.write_batch)
    spark.sql("CREATE DATABASE IF NOT EXISTS tidemart_publish")
    try:
        schema.create_tables(spark, root, "tidemart_publish")
        assert [r.order_id for r in spark.table("tidemart_publish.sales_fact").collect()] == ["o0"]
        batch(spark, root, 1)
        schema.create_tables(spark, root, "tidemart_publish")
        assert sorted(r.order_id for r in spark.table("tidemart_publish.sales_fact").collect()) == ["o0", "o1"]
    finally:
        spark.sql("DROP DATABASE tidemart_publish CASCADE")


def test_compaction_switches_at_once_and_merges_the_preaggregate(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    for n in (0, 3, 1, 6):  # 0, 3 and 6 fall into one quarter
        batch(spark, root, n)
    batch(spark, root, 9, write=load.write_batch, source="broken")  # never ends, and is in nobody's way
    batch(spark, root, 12, source="other")
    old = WarehouseStar(spark, root)
    old.snapshot()
    before, checks = answers(spark, root), warehouse_checks(spark, root)
    merged = compact.compact(spark, root, keep_old=True)
    assert merged["sales_fact"] == 3
    assert answers(spark, root) == before and warehouse_checks(spark, root) == checks
    assert old.fact().count() == 5  # a report under way still finds its folders
    rows = load.read(spark, root, "store_quarterly_sales").where("batch_id <= 2")
    assert rows.count() == rows.select(*preagg.KEYS).distinct().count() == 2
    assert compact.vacuum(spark, root) > 0 and answers(spark, root) == before
    assert sorted(os.listdir(f"{root}/sales_fact")) == [f"batch_id={n}" for n in (2, 3, 4, 5)]
    assert commits.begin(spark, root, "s", "6").attempt == 1
    with pytest.raises(ValueError):
        commits.begin(spark, root, "s", "0")


def test_the_log_stays_small(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(commits, "TAIL", 6)
    root = f"{tmp_dir}/wh"
    most = 0
    for n in range(15):
        b = commits.begin(spark, root, "s", str(n % 12))
        if n != 5:
            commits.done(spark, root, b, {"rows": n})
        most = max(most, commits.log_files(spark, root))
    assert most <= 8
    snap = commits.snapshot(spark, root)
    assert snap.facts == ((0, 3, 4), (0, 6, 11), (1, 0, 2))
    assert snap.members == ((0, 0, 4), (0, 6, 11), (1, 0, 2))
    assert commits.begin(spark, root, "s", "5") == commits.Batch(5, True, 1, "s", "5")
    assert len([d for d in os.listdir(f"{root}/_commits") if d.startswith("epoch=")]) == 2
    done = commits.log(spark, root).where("state = 'done'").groupBy("batch_id").agg(F.max_by("rows", "attempt").alias("n"))
    assert {r.batch_id: r.n for r in done.collect()} == {n: (n + 12 if n < 3 else n) for n in range(12) if n != 5}


HEAD = "orderID,Customer_ID,Product_ID,quantity,date\n"


def _files(src, *names):
    os.makedirs(src, exist_ok=True)
    for i, name in enumerate(names):
        with open(f"{src}/{name}.csv", "w") as f:
            f.write(HEAD + "".join(f"{name}{k},C1,P1,1,2017-01-01\n" for k in range(3)))
        os.utime(f"{src}/{name}.csv", (1_000_000_000 + ord(name[0]),) * 2)


def test_each_file_is_loaded_once_however_it_comes(spark, tmp_dir):
    src, root = f"{tmp_dir}/in", f"{tmp_dir}/wh"
    _files(src, "a", "b", "c")
    schema = masters.transaction_schema(spark, f"{src}/a.csv")

    def stream(checkpoint, files):
        loader.start(spark, src, schema, root, f"{tmp_dir}/{checkpoint}", lambda: people(spark, "C1"), lambda: goods(spark),
                     max_files_per_trigger=files).awaitTermination()
        return [o for o, _ in facts(spark, root)]

    def folder(**options):
        return load.load_batch(spark, masters.read_transactions(spark, src, schema), people(spark, "C1"), goods(spark), root,
                               source="folder", **options)

    want = [f"{n}{k}" for n in "abc" for k in range(3)]
    assert stream("ck1", 1) == want
    assert stream("ck2", 2) == want  # grouped otherwise
    _files(src, "d")
    assert folder()["facts"] == 3
    assert folder() == {"rows": 0, "facts": 0, "rejects": 0}
    assert [o for o, _ in facts(spark, root)] == want + ["d0", "d1", "d2"]
    assert stream("ck1", 3) == stream("ck3", 4) == want + ["d0", "d1", "d2"]
    with pytest.raises(ValueError):
        folder(replay=True)  # its files lie in several batches
    compact.compact(spark, root)
    _files(src, "e")
    assert folder()["facts"] == 3
    ledger = load.read(spark, root, "file_ledger")
    assert {os.path.basename(r.path): r.rows for r in ledger.collect()} == {f"{n}.csv": 3 for n in "abcde"}


def test_headers_are_compared_where_files_are_read(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    _files(src, "a")
    for name, text in (("b", "Customer_ID,orderID,Product_ID,quantity,date\nC1,b0,P1,1,2017-01-01\n"),
                       ("c", HEAD.strip() + ",more\nc0,C1,P1,1,2017-01-01,9\n"),
                       ("d", HEAD + HEAD + "d0,C1,P1,1,2017-01-01\n"), ("e", HEAD), ("f", "\n" + HEAD + "f0,C1,P1,1,2017-01-01\n")):
        with open(f"{src}/{name}.csv", "w") as f:
            f.write(text)
    schema = masters.transaction_schema(spark, f"{src}/a.csv")
    # files of several splits: only the first block has the header
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    try:
        rows = masters.read_transactions(spark, src, schema).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = sorted((os.path.basename(r["_file"]["path"]), r.order_id, r["_bad_header"]) for r in rows)
    assert found == [("a.csv", f"a{k}", False) for k in range(3)] + [
        ("b.csv", "C1", True), ("c.csv", "c0", True), ("d.csv", "d0", False), ("d.csv", "orderID", False), ("f.csv", "f0", False)]
    with open(masters.__file__) as f:
        assert "_jvm" not in f.read()


def test_a_replay_of_files_takes_the_place_of_their_batch(spark, tmp_dir, capsys):
    src, root = f"{tmp_dir}/in", f"{tmp_dir}/wh"
    _files(src, "a")
    for name, text in (("customers", "Customer_ID,Gender\nC0,F\n"),
                       ("products", "Product_ID,Product_Category,price$,storeID,storeName,supplierID,supplierName\nP1,x,2,1,S,1,T\n"),
                       ("holidays", "holiday_date\n2017-01-01\n")):
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write(text)

    def run(*more):
        assert main(["load", "--customers", f"{tmp_dir}/customers.csv", "--products", f"{tmp_dir}/products.csv",
                     "--transactions", src, "--warehouse", root, *more]) == 0
        return load.read(spark, root, "sales_fact").count()

    assert run() == 0  # no customer is known yet
    with open(f"{tmp_dir}/customers.csv", "a") as f:
        f.write("C1,M\n")
    assert run() == 0
    assert run("--replay", "--holidays", f"{tmp_dir}/holidays.csv") == 3
    assert load.read(spark, root, "quarantine").count() == 0
    assert [r.is_holiday for r in load.read(spark, root, "dim_time").collect()] == [1]
    capsys.readouterr()
