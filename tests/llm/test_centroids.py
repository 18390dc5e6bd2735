import hashlib
import math
import random

import numpy as np
from pyspark.sql import types as T

from tidemart.llm import centroids
from tidemart.llm.common import table

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                     T.StructField("cluster", T.StringType()), T.StructField("v", T.StringType())])


def brute(rows, k=40, rounds=5, scale=256, dims=64):
    """Plain Python integers: (id, cluster, distance, cluster inertia, inertia, sha256)."""
    kept = [(i, [math.floor(scale * x) if abs(x) < 1e300 else scale * int(x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [v for _, v in first[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(near(v)[1], []).append(v)
        centers = [[sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c for n, c in enumerate(centers)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    cap = lambda x: min(x, (1 << 63) - 1)
    of = lambda n: cap(sum(cap(d) for _, c, d in found if c == n))
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted([(i, c, cap(d), of(c), cap(sum(cap(x[2]) for x in found)), sha[c]) for i, c, d in found], key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], ROWS).repartition(3)
    assigned, centers = centroids.clusters(df, **options)
    out = centroids.with_inertia(assigned, centers).select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted(map(tuple, out.collect()), key=str)


def test_awkward_rows_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(400), [rng.gauss(0, 1) + 3 * (i % 5) for _ in range(4)]) for i in range(300)]
    rows += [rows[0]] * 50 + [(7, [0.0, 0.0, 0.0, 0.0])] * 5 + [(None, [1.0, 2.0, 3.0, 4.0])] * 2
    rows += [(1, None), (2, [1.0, None, 2.0, 3.0]), (3, [float("nan")] * 4), (4, [float("inf"), 1.0, 1.0, 1.0]), (5, [1.0, 2.0])]
    options = dict(k=12, rounds=5, dims=4)
    assert found(spark, rows, **options) == brute(rows, **options)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(i, [float(i % 2), 1.0]) for i in range(6)]
    assert found(spark, rows, k=40, dims=2) == brute(rows, k=40, dims=2)
    assert found(spark, [(1, None)], k=40, dims=2) == []


def test_components_beyond_64_bits(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.choice([0, 6, 20, 38, 300]) for _ in range(3)]) for i in range(60)]
    rows += [(100, [1.7e308, -1.7e308, 5e6])]
    assert found(spark, rows, k=7, dims=3) == brute(rows, k=7, dims=3)


def test_ties_go_to_the_smaller_number():
    lists = centroids.Lists([[4, 0], [0, 4], [-4, 0], [0, -4], [4, 0]])
    number, distance = lists.nearest(np.array([[0, 0], [2, 2], [-1, -1], [9, 0]], np.int64))
    assert number.tolist() == [0, 0, 2, 0] and distance.tolist() == [16, 8, 10, 25]


def test_walks_stop_early_where_clusters_are_apart():
    rng = np.random.default_rng(5)
    centers = [[1000 * i, 1000 * i] for i in range(200)]
    lists = centroids.Lists(centers)
    steps = []
    whole = lists.ids
    class Counted(type(whole)):  # noqa: E306
        def __getitem__(self, at):
            steps.append(len(at[1]))
            return np.asarray(super().__getitem__(at))
    lists.ids = whole.view(Counted)
    vectors = rng.integers(0, 200_000, (300, 2))
    number, _ = lists.nearest(vectors)
    assert (number == ((vectors[:, None] - np.array(centers)[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert sum(steps) < 300 * 200 / 2  # rows looked at, against a step for each centroid


def test_the_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    df = centroids.op12_centroids(spark, sf)
    assert df.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"),
                         ("inertia", "bigint"), ("centroid_sha256", "string")]
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    assert sorted(map(tuple, df.collect()), key=str) == brute(rows)
