"""End to end in the reference's file layout: master CSVs (index column, price$,
store/supplier on the product), a transaction folder, load, then reports from the CLI."""

import os

from tidemart.__main__ import main
from tidemart.plans import reports as R
from tidemart.plans.star import WarehouseStar

CUST = """,Customer_ID,Gender,Age,Occupation,City_Category,Stay_In_Current_City_Years,Marital_Status
0,1000001,F,26-35,10,A,2,0
1,1000002,M,18-25,4,B,1,1
2,1000003,F,55+,7,C,4+,1
"""
PROD = """,Product_ID,Product_Category,price$,storeID,storeName,supplierID,supplierName
0,P1,Electronics,9.63,1,North,11,Acme
1,P2,Grocery,77.51,2,South,12,Bolt
"""
TX = """,orderID, Customer_ID,Product_ID,quantity,date
0,O1, 1000001,P1,2,2017-01-07
1,O1, 1000001,P2,1,2017-1-7
2,O2, 1000002,P1,3,2017-04-02
3,O3, 1000003,P2,1,2017-07-15
4,O4, 1000002,P2,x,2017-07-15
"""


def _w(d, name, text):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def test_cli_load_and_report(spark, tmp_dir, capsys):
    _w(tmp_dir, "customers.csv", CUST)
    _w(tmp_dir, "products.csv", PROD)
    _w(os.path.join(tmp_dir, "tx"), "t1.csv", TX)
    wh = os.path.join(tmp_dir, "wh")
    assert main(["load", "--customers", os.path.join(tmp_dir, "customers.csv"),
                 "--products", os.path.join(tmp_dir, "products.csv"),
                 "--transactions", os.path.join(tmp_dir, "tx"), "--warehouse", wh]) == 0
    assert '"facts": 4' in capsys.readouterr().out
    star = WarehouseStar(spark, wh)
    rev = R.util_revenue_summary(star).first()
    assert rev["total_transactions"] == 4
    assert str(rev["total_revenue"]) == "203.17"  # 19.26 + 77.51 + 28.89 + 77.51
    stores = {r["store_name"]: r["total_sales"] for r in R.q20_store_quarterly_view(star).collect()}
    assert set(stores) == {"North", "South"}
    # customer 1000003 has stay "4+" -> NULL after the typed read, still loaded
    assert star.dim("customer").count() == 3
    assert main(["report", "q12_store_quarter_growth", "--warehouse", wh, "--year", "2017"]) == 0
    out = capsys.readouterr().out
    assert "North" in out and "South" in out


def test_cli_dq_checks(spark, tmp_dir, capsys):
    _w(tmp_dir, "customers.csv", CUST)
    _w(tmp_dir, "products.csv", PROD)
    _w(os.path.join(tmp_dir, "tx"), "t1.csv", TX)
    wh = os.path.join(tmp_dir, "wh")
    main(["load", "--customers", os.path.join(tmp_dir, "customers.csv"),
          "--products", os.path.join(tmp_dir, "products.csv"),
          "--transactions", os.path.join(tmp_dir, "tx"), "--warehouse", wh])
    capsys.readouterr()
    assert main(["dq", "--warehouse", wh]) == 0
    out = capsys.readouterr().out
    assert '"unaccounted_rows": 0' in out and '"loaded_rows": 4' in out


def test_cli_bucket_export(spark, tmp_dir, capsys):
    from tidemart.plans.bucketed import CatalogStar
    _w(tmp_dir, "customers.csv", CUST)
    _w(tmp_dir, "products.csv", PROD)
    _w(os.path.join(tmp_dir, "tx"), "t1.csv", TX)
    wh = os.path.join(tmp_dir, "wh")
    main(["load", "--customers", os.path.join(tmp_dir, "customers.csv"),
          "--products", os.path.join(tmp_dir, "products.csv"),
          "--transactions", os.path.join(tmp_dir, "tx"), "--warehouse", wh])
    assert main(["bucket", "--warehouse", wh, "--database", "tidemart_cli_bucket",
                 "--buckets", "4"]) == 0
    assert "tidemart_cli_bucket.sales_fact_by_customer" in capsys.readouterr().out
    a = R.q02_customer_demographics(CatalogStar(spark, wh, "tidemart_cli_bucket"))
    b = R.q02_customer_demographics(WarehouseStar(spark, wh))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    spark.sql("DROP DATABASE tidemart_cli_bucket CASCADE")


def test_cli_every_report_runs_on_a_warehouse(spark, capsys):
    from tidemart.__main__ import REPORTS
    from tidemart.plans import etl
    root = etl.load_test_warehouse(spark, "/root/testdata/sf0.001")
    for name in sorted(REPORTS):
        assert main(["report", name, "--warehouse", root, "--show", "1",
                     "--as-of", "1998-12-31", "--year", "1997"]) == 0, name
    capsys.readouterr()
    assert len(REPORTS) >= 22
