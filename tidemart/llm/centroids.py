"""Clustering around centroids (Lloyd's rounds on integers), nearest centroids found by the
threshold algorithm.

Vectors of ``dims`` finite components become integers, ``floor(scale * x)``. The first centroids
are the ``k`` vectors whose sha256 of ``<salt>:<id>`` is least, in this order. A round assigns
each vector to its nearest centroid (squared Euclidean distance; ties: the smaller number) and
replaces each centroid with vectors by the floor of their mean, component by component; one
without vectors stays. After the rounds vectors are assigned once more.

Threshold algorithm: each dimension has its centroids in a list sorted by their component. A
search walks every list outward from the vector's own value, one centroid a step; each
centroid that a list names gets its exact distance. The gaps that the lists have reached bound
all centroids not yet named, so the search stops once the sum of their squares strictly exceeds
the best exact distance (an equal one may still be a tie). Searches of a block of vectors run
side by side.

Plan: the vectors that take part are written once. A round is one job: tasks assign their
vectors and add them up per centroid, and only these sums, at most ``k`` * ``dims`` rows a task,
are shuffled and added up; the new centroids, ``k`` vectors, are all that the driver sees.
However many vectors one cluster holds, no task gets them together.

All arithmetic is exact: in 64 bits while the integers stay below 2**27, in Python's integers
beyond. A distance, or a sum of distances, over 2**63 - 1 is reported as that number.

Defined results: a vector that is null, has another length or a null, NaN or infinite component
has no row in the result. Repeated rows take part one by one. Rows without an id take part,
but come last for the first centroids; of equal ids the least vector comes first. With fewer
than ``k`` vectors each is a centroid; an empty table gives an empty result. Only the two
named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import map_batches, position, table, written

#: Integers up to this size have exact distances in 64 bits.
SMALL = 1 << 27
LARGEST = (1 << 63) - 1
DIGIT = 60
BLOCK = 1024


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as int64, or as Python integers where those may not be exact."""
    scaled = np.floor(scale * vectors)
    if not len(vectors) or np.abs(scaled).max() <= SMALL:
        return scaled.astype(np.int64)
    whole = [int(s) if np.isfinite(s) else scale * int(x) for s, x in zip(scaled.ravel().tolist(), vectors.ravel().tolist())]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(vectors.shape)


class Lists:
    """Centroids with a sorted list per dimension."""

    def __init__(self, centers: list[list[int]]):
        small = max(abs(x) for c in centers for x in c) <= SMALL
        self.centers = np.array(centers, np.int64 if small else object)
        order = np.argsort(self.centers, axis=0, kind="stable")
        self.ids = order.T
        self.values = np.take_along_axis(self.centers, order, axis=0).T

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's nearest centroid."""
        if vectors.dtype == object or self.centers.dtype == object:
            vectors = vectors.astype(object)
        number, distance = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), vectors.dtype)
        for start in range(0, len(vectors), BLOCK):
            some = slice(start, start + BLOCK)
            number[some], distance[some] = self._walk(vectors[some])
        return number, distance

    def _walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, dims = self.centers.shape
        far = 1 << 62 if x.dtype != object else 1 << 4096
        values, lane = self.values, np.arange(dims)
        right = np.stack([np.searchsorted(values[d], x[:, d]) for d in range(dims)], axis=1)
        left = right - 1
        seen = np.zeros((len(x), k), bool)
        number, best = np.full(len(x), -1), np.empty(len(x), x.dtype)
        live = np.arange(len(x))
        while len(live):
            own, low, high = x[live], left[live], right[live]
            down = np.where(low >= 0, own - values[lane, np.maximum(low, 0)], far)
            up = np.where(high < k, values[lane, np.minimum(high, k - 1)] - own, far)
            lower = (down <= up).astype(bool)
            frontier = np.where(lower, down, up)
            named = self.ids[lane, np.where(lower, np.maximum(low, 0), np.minimum(high, k - 1))]
            left[live] = low - lower
            right[live] = high + ~lower
            new = np.zeros((len(live), k), bool)
            new[np.arange(len(live))[:, None], named] = True
            new &= ~seen[live]
            seen[live] |= new
            # numbers ascend within a row, so the first least distance is that of the smaller number
            row, center = np.nonzero(new)
            exact = ((own[row] - self.centers[center]) ** 2).sum(axis=1)
            some, at = np.unique(row, return_index=True)
            for r, a, z in zip(some.tolist(), at.tolist(), [*at[1:].tolist(), len(row)]):
                i = a + int(exact[a:z].argmin())
                v = live[r]
                if number[v] < 0 or (exact[i], center[i]) < (best[v], number[v]):
                    best[v], number[v] = exact[i], center[i]
            bound = (frontier ** 2).sum(axis=1)
            live = live[~((bound > best[live]).astype(bool) | seen[live].all(axis=1))]
        return number, best


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), dims)


def digits(n: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of a whole number in base 2**DIGIT; all digits carry its sign."""
    sign, n, place = (-1, -n, 0) if n < 0 else (1, n, 0)
    while n:
        yield place, sign * (n & ((1 << DIGIT) - 1))
        n, place = n >> DIGIT, place + 1


def moved(rows: DataFrame, centers: list[list[int]], scale: int) -> list[list[int]]:
    """The centroids after one round over ``rows`` (column ``v``)."""
    dims, lists = len(centers[0]), Lists(centers)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, int]] = {}
        for batch in batches:
            vectors = integers(matrix(batch.column(0), dims), scale)
            number, _ = lists.nearest(vectors)
            for c in np.unique(number).tolist():
                mine = vectors[number == c]
                total, n = sums.get(c, (np.zeros(dims, object), 0))
                sums[c] = total + mine.sum(axis=0).astype(object), n + len(mine)
        out = [(c, -1, 0, n) for c, (_, n) in sums.items()]
        out += [(c, d, place, digit) for c, (total, _) in sums.items() for d in range(dims)
                for place, digit in digits(int(total[d]))]
        columns = [list(x) for x in zip(*out)] or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                         ["c", "d", "place", "digit"])

    parts = rows.select("v").mapInArrow(add, "c int, d int, place int, digit long")
    # at most k * (dims + 1) sums, times the digits of one
    added = parts.groupBy("c", "d", "place").agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("s")).collect()
    totals: dict[tuple[int, int], int] = {}
    for r in added:
        totals[r.c, r.d] = totals.get((r.c, r.d), 0) + (int(r.s) << DIGIT * r.place)
    return [[totals.get((c, d), 0) // totals[c, -1] for d in range(dims)] if (c, -1) in totals else center
            for c, center in enumerate(centers)]


def usable(rows: DataFrame, id_: str, vector: str, dims: int) -> DataFrame:
    """id and v of the rows that take part."""
    element = rows.schema[vector].dataType.elementType
    v = F.col(vector) if isinstance(element, (T.FloatType, T.DoubleType)) else F.col(vector).cast("array<double>")
    finite = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return (rows.select(F.col(id_).alias("id"), v.alias("v")).filter("v IS NOT NULL").filter(F.size("v") == dims)
            .filter(finite))


def clusters(rows: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, dims: int = 64, salt: str = "2",
             id_: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of each vector that takes part, and the final centroids."""
    spark = rows.sparkSession
    ready = written(spark, usable(rows, id_, vector, dims), "centroids-rows")
    mark = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = ready.orderBy(mark.asc_nulls_last(), "v").limit(k).collect()
    result = "id {}, cluster int, distance long".format(ready.schema["id"].dataType.simpleString())
    if not first:
        return spark.createDataFrame([], result), []
    centers = [[int(x) for x in row] for row in integers(np.array([r.v for r in first], np.float64), scale)]
    for _ in range(rounds):
        centers = moved(ready, centers, scale)
    lists, at = Lists(centers), position(ready, "v")

    def assign(batch: pa.RecordBatch) -> list:
        number, distance = lists.nearest(integers(matrix(batch.column(at), dims), scale))
        if distance.dtype == object:
            distance = np.array([min(int(x), LARGEST) for x in distance], np.int64)
        return [*batch.columns, pa.array(number.astype(np.int32)), pa.array(distance, pa.int64())]

    named = map_batches(ready, assign, "cluster int, distance long").drop("v")
    return written(spark, named, "centroids-assigned"), centers


def with_inertia(assigned: DataFrame, centers: list[list[int]]) -> DataFrame:
    """``assigned`` with the sums of distances of the cluster and of all, and the sha256 of the
    centroid's components. The joined table has a row a centroid."""
    spark = assigned.sparkSession
    sums = {r.cluster: int(r.s) for r in assigned.groupBy("cluster")
            .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = min(sum(sums.values()), LARGEST)
    about = [(c, min(s, LARGEST), total, hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest())
             for c, s in sorted(sums.items())]
    about = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centers = clusters(table(spark, sf_dir, "embeddings"))
    return with_inertia(assigned, centers).select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia",
                                                  "inertia", "centroid_sha256")


def _round(i: int) -> str:
    return f"""
a{i} AS (SELECT e.v, arg_min(c.c, (list_dot_product(e.v, e.v) + list_dot_product(c.v, c.v) - 2 * list_dot_product(e.v, c.v), c.c)) AS c
        FROM e, c{i} c GROUP BY e.row, e.v),
m{i} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i})
        GROUP BY c, i),
n{i} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS v FROM m{i} GROUP BY c),
c{i + 1} AS (SELECT c.c, coalesce(n.v, c.v) AS v FROM c{i} c LEFT JOIN n{i} n ON n.c = c.c),"""


#: The same in DuckDB's SQL: every vector against every centroid, five rounds written out.
OP12_SQL = """
WITH e AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM e QUALIFY c < 40),""" + "".join(
    map(_round, range(5))) + """
d AS (SELECT e.vec_id, min((list_dot_product(e.v, e.v) + list_dot_product(c.v, c.v) - 2 * list_dot_product(e.v, c.v), c.c)) AS near
      FROM e, c5 c GROUP BY e.row, e.vec_id),
f AS (SELECT vec_id, near[2]::INTEGER AS cluster, near[1]::BIGINT AS distance FROM d)
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c5.v, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM f JOIN c5 ON c5.c = f.cluster
"""
