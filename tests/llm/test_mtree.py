import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemart.llm import mtree

SCHEMA = "vec_id long, embedding array<float>, label int, score long, copies int, v string, exact int"


def brute(rows, k=10, scale=1024):
    good = [(i, np.floor(np.array(v, np.float32).astype(float) * scale).astype(np.int64)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if q % 100 == 0:
            best = sorted((-int(v @ w), i) for i, w in good if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def run(spark, rows, **params):
    df = spark.createDataFrame([(i, v, 1, 2, 3, 'x', 4) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in mtree.top_k(df, F.col("id") % 100 == 0, **params).collect())


def test_against_brute_force_with_ties_and_blocks(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + rng.normal(size=8) * 0.2).tolist()) for i in range(900)]
    rows += [(1000 + i, [0.5] * 8) for i in range(60)]  # many equal vectors: ties by id
    assert run(spark, rows, block_rows=200, query_rows=4, page=8) == brute(rows)


def test_awkward_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
            (5, [-1.0, -2.0]), (6, [0.0, 0.0]), (None, [9.0, 9.0]), (100, [1.0, 2.0]), (7, [0.5, 0.5])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(1, [1.0])]) == []


def test_repeated_rows_are_candidates_each_and_indexed_once(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(150)]
    rows += [(7, [9.0, 9.0, 9.0])] * 4 + [(8, [-9.0, -9.0, -9.0])] * 500
    rows += [(9, [3.0, 0.0, 0.0]), (9, [0.0, 3.0, 0.0])] * 2  # an id of two vectors
    assert run(spark, rows, block_rows=40, page=4) == brute(rows)
    ids, vectors = np.array([1, 2]), np.array([[5, 5], [1, 1]])
    pages = mtree.build(ids, vectors, 50.0, 4, copies=np.array([1000, 1]))
    assert mtree.search(pages, 50.0, np.array([1, 1]), 5, 3) == [(10, 1)] * 3


def test_large_finite_components(spark):
    def exact(rows, k=10):
        clip = lambda x: max(-2 ** 63, min(2 ** 63 - 1, x))
        good = [(i, [clip(math.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows]
        out = []
        for q, v in good:
            if q % 100 == 0:
                best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:k]
                out += [(q, r, i, clip(-s)) for r, (s, i) in enumerate(best, 1)]
        return sorted(out)

    rng = np.random.default_rng(6)
    for size in (5e6, 3e12, 1e17, 3e38):
        rows = [(i, (rng.normal(size=4) * size / 4).clip(-3e38, 3e38).tolist()) for i in range(201)]
        rows += [(300 + i, rng.normal(size=4).tolist()) for i in range(30)]
        assert run(spark, rows, block_rows=60, page=4) == exact(rows), size


def test_limbs_compare_like_the_number():
    numbers = [-2 ** 132, -2 ** 126 - 1, -2 ** 63 - 1, -2 ** 63, -1, 0, 1, 2 ** 63 - 1, 2 ** 63, 2 ** 126, 2 ** 132]
    assert sorted(numbers, key=mtree.limbs) == numbers
    assert all(-2 ** 63 <= x < 2 ** 63 for n in numbers for x in mtree.limbs(n))


def test_the_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    df = mtree.op10_mtree(spark, sf)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(tuple(r) for r in df.collect()) == brute(rows)


def test_other_lengths_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 1.0]), (2, [5.0]), (3, [])]
    assert run(spark, rows) == [(0, 1, 1, 3 * 1024 * 1024)]


def clustered(spread, seed):
    rng = np.random.default_rng(seed)
    return np.floor(np.concatenate([rng.normal(size=(300, 4)) * 3 + c for c in rng.normal(size=(10, 4)) * spread])).astype(np.int64)


def test_pages_cover_their_rows():
    rows = clustered(500, 2)
    top = float((rows * rows).sum(axis=1).max())
    pages = mtree.build(np.arange(len(rows)), rows, top, 16)

    def below(i):
        p = pages[i]
        return p.ids if p.children is None else np.concatenate([below(c) for c in p.children])

    points = np.concatenate([rows, np.sqrt(top - (rows * rows).sum(axis=1))[:, None]], axis=1)
    assert sorted(below(len(pages) - 1).tolist()) == list(range(len(rows)))
    for i, p in enumerate(pages):
        far = np.sqrt(((points[below(i)] - p.route) ** 2).sum(axis=1))
        assert far.max() <= p.radius + 1e-9 and len(p.to_parent) <= 16
    assert sum(p.children is not None for p in pages) > 1


def test_search_opens_few_rows_of_clustered_data():
    rows = clustered(500, 3)
    top = float((rows * rows).sum(axis=1).max())
    pages = mtree.build(np.arange(len(rows)), rows, top, 32)
    opened = []

    class Counting(np.ndarray):
        def __getitem__(self, item):
            opened.append(len(item))
            return np.asarray(self)[item]

    for p in pages:
        if p.rows is not None:
            p.rows = p.rows.view(Counting)
    best = mtree.search(pages, top, rows[7], 7, 5)
    want = sorted(((int(s), i) for i, s in enumerate(rows @ rows[7]) if i != 7), key=lambda x: (-x[0], x[1]))[:5]
    assert sorted(best, key=lambda x: (-x[0], x[1])) == want
    assert sum(opened) < len(rows) / 2


def test_matrix_keeps_whole_numbers():
    ids, rows = mtree.matrix(pa.table({"id": [1, 2], "v": [[1, 2], [3, 4]]}), "id", "v")
    assert ids.tolist() == [1, 2] and rows.tolist() == [[1, 2], [3, 4]]
