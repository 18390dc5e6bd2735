"""Property tests: the custom operators against brute force on random small inputs."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemart.operators import keys, olap

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

lines = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 1), st.integers(0, 6),
                           st.integers(1, 500)), min_size=1, max_size=40)


@SETTINGS
@given(rows=lines)
def test_basket_pairs_brute_force(spark, rows):
    df = spark.createDataFrame([(o, c, p, Decimal(a) / 100) for o, c, p, a in rows],
                               "o int, c int, p int, amt decimal(12,2)")
    got = {(r["item1"], r["item2"]): (r["frequency"], r["combined_revenue"])
           for r in olap.basket_pairs(df, ["o", "c"], "p", "amt").collect()}
    want = defaultdict(lambda: [0, Decimal(0)])
    for i, (o1, c1, p1, a1) in enumerate(rows):
        for j, (o2, c2, p2, a2) in enumerate(rows):
            if o1 == o2 and c1 == c2 and p1 < p2:
                want[(p1, p2)][0] += 1
                want[(p1, p2)][1] += (Decimal(a1) + Decimal(a2)) / 100
    assert got == {k: (v[0], v[1]) for k, v in want.items()}


@SETTINGS
@given(ids=st.lists(st.text("abc0123", min_size=1, max_size=4), min_size=1, max_size=60),
       base=st.integers(0, 1000), parts=st.integers(1, 7))
def test_dense_keys_brute_force(spark, ids, base, parts):
    df = spark.createDataFrame([(i,) for i in ids], "k string")
    got = {r["k"]: r["sk"] for r in keys.dense_keys(df, "k", "sk", base, parts).collect()}
    ordered = sorted(set(ids), key=lambda s: s.encode())
    assert got == {k: base + i + 1 for i, k in enumerate(ordered)}


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(0, 2), st.integers(1, 30), st.integers(0, 900)),
                     min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1])))
def test_spikes_brute_force(spark, vals):
    df = spark.createDataFrame([(k, d, Decimal(v)) for k, d, v in vals],
                               "k int, d int, v decimal(22,2)")
    got = {(r["k"], r["d"]) for r in olap.revenue_spikes(df, "k", "v", 2).collect()}
    by = defaultdict(list)
    for k, d, v in vals:
        by[k].append((d, v))
    want = {(k, d) for k, xs in by.items() for d, v in xs
            if v * len(xs) > 2 * sum(x for _, x in xs)}
    assert got == want


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(0, 1), st.integers(1, 12), st.integers(0, 50)),
                     min_size=1, max_size=24, unique_by=lambda t: (t[0], t[1])))
def test_period_growth_brute_force(spark, vals):
    df = spark.createDataFrame([(k, m, Decimal(v)) for k, m, v in vals],
                               "k int, m int, v decimal(22,2)")
    got = {(r["k"], r["m"]): r["g"]
           for r in olap.period_growth(df, ["k"], ["m"], "v", "prev", "g").collect()}
    want = {}
    for k in {k for k, _, _ in vals}:
        series = sorted((m, v) for kk, m, v in vals if kk == k)
        prev = None
        for m, v in series:
            if prev is None:
                want[(k, m)] = 0.0
            elif prev == 0:
                want[(k, m)] = None
            else:
                # ROUND(x, 2) rounds half away from zero (T-SQL and Spark), on the
                # shortest decimal form of the double
                x = (v - prev) / prev * 100.0
                want[(k, m)] = float(Decimal(repr(x)).quantize(Decimal("0.01"),
                                                               rounding=ROUND_HALF_UP)) + 0.0
            prev = v
    assert got.keys() == want.keys()
    for key, g in got.items():
        w = want[key]
        assert (g is None and w is None) or abs(g - w) < 1e-9


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", "y"]),
                               st.integers(1, 99)), min_size=1, max_size=30))
def test_rollup_brute_force(spark, rows):
    df = spark.createDataFrame([(a, b, Decimal(v)) for a, b, v in rows],
                               "a string, b string, v decimal(12,2)")
    out = olap.rollup_report(df, ["a", "b"], {"s": ("v", "sum_money"), "n": ("v", "count")})
    got = {(r["grouping_id"], r["a"], r["b"]): (r["s"], r["n"]) for r in out.collect()}
    want = defaultdict(lambda: [Decimal(0), 0])
    for a, b, v in rows:
        for gid, key in ((0, (a, b)), (1, (a, None)), (3, (None, None))):
            want[(gid,) + key][0] += v
            want[(gid,) + key][1] += 1
    assert got == {k: (v[0], v[1]) for k, v in want.items()}


def test_first_writer_is_deterministic(spark):
    df = spark.createDataFrame([("k", "late", 2), ("k", "early", 1), ("j", "only", 5)],
                               "key string, attr string, seq int")
    got = {r["key"]: r["attr"] for r in keys.first_writer(df, "key", ["attr"], "seq").collect()}
    assert got == {"k": "early", "j": "only"}
    got2 = {r["key"]: r["attr"] for r in keys.first_writer(df, "key", ["attr"]).collect()}
    assert got2 == {"k": "early", "j": "only"}  # smallest attribute set without an order
    assert keys.first_writer(df.where(F.lit(False)), "key", ["attr"]).count() == 0


@SETTINGS
@given(ids=st.lists(st.text("abc0123", min_size=1, max_size=4), min_size=1, max_size=60),
       base=st.integers(0, 1000))
def test_dense_keys_small_path_brute_force(spark, ids, base):
    df = spark.createDataFrame([(i,) for i in ids], "k string")
    got = {r["k"]: r["sk"] for r in keys.dense_keys(df, "k", "sk", base).collect()}
    ordered = sorted(set(ids), key=lambda s: s.encode())
    assert got == {k: base + i + 1 for i, k in enumerate(ordered)}
