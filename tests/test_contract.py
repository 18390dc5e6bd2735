"""Driver contract: bench.py prints exactly one JSON line; entry has a stable schema."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1",
               BENCH_CPUS="2", BENCH_WAREHOUSE="0", BENCH_QUERIES="q02_customer_demographics")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["metric"] and isinstance(d["value"], (int, float))
    assert set(d["queries"]) == {"q02_customer_demographics"} and d["sf"] == "0.001"


def test_entry_schema_is_stable(spark):
    from __spark_entry__ import entry
    a, b = entry(spark), entry(spark)
    assert a.schema == b.schema
    assert a.columns == ["gender", "age_group", "city_category", "customer_count",
                         "total_purchase_amount", "avg_purchase_amount", "transaction_count"]
