"""Exact top-k by inner product: M-trees over blocks of rows, best-first search.

Vectors become integers, ``floor(scale * x)``. Inner product is no metric, so each row gets one
more coordinate, sqrt(M - |x|^2) with M the largest squared norm; with 0 in this place for a
query q, the squared Euclidean distance is |q|^2 + M - 2 q.x, so the nearest rows are those
of the largest inner product, and the triangle inequality holds.

Index: rows are dealt by hash into blocks of about ``block_rows``, and a task builds the tree
of each block. A page is a leaf of at most ``page`` rows or a node of at most ``page`` pages;
it has a routing vector, a covering radius, and its entries' distances to that vector. Pages
are written as a table. Queries are dealt into batches of ``query_rows``, and each batch meets
each block once (a stated query set against all rows, in blocks): a task opens the pages of
its block and searches best-first. A page is entered in the order of its least possible
distance and none is entered once that exceeds the k-th best found; an entry is passed over
without a distance when the stored distance to its parent already proves it too far.
Scores of opened rows are exact integers, and pruning keeps a margin above rounding, so ties
are complete. The k best of each block are merged with one window per query.

Equal rows (id and vector) are counted before they are dealt, and indexed once with their
number, so no block grows with the copies of a row.

Defined results: vectors that are null or hold a null, NaN or infinite component take no
part, nor do rows without an id; the number of components is the most common one (of
ties the largest), others take no part; repeated rows are candidates each, and a query's own id
never is (rows of a query that are equal ask once); k candidates or all if fewer; an empty
table gives an empty result. Components beyond 64 bits count as the nearest 64-bit number.
Scores are exact whatever their size and ranked so; one beyond 64 bits is reported as the nearest
64-bit number.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import table, written

SLACK = 1e-6
#: From this squared norm on, scores are summed in whole numbers without a limit.
WIDE = 2.0 ** 62
LONG_MAX = (1 << 63) - 1
#: A page as a row of the index: the root has the highest number of its block; a node has
#: children, a leaf ids and integer vectors.
PAGES = ("block int, page int, radius double, route binary, to_parent binary, children binary, ids binary, "
         "rows binary, copies binary")


@dataclass
class Page:
    """A page with its entries' distances to the routing vector. Of a node the entries are
    pages (by number), of a leaf rows: ids, integer vectors and copies lie in the page."""
    route: np.ndarray
    radius: float
    to_parent: np.ndarray
    children: np.ndarray | None
    ids: np.ndarray | None = None
    rows: np.ndarray | None = None
    copies: np.ndarray | None = None


def build(ids: np.ndarray, rows: np.ndarray, top: float, page: int, seed: int = 1,
          copies: np.ndarray | None = None) -> list[Page]:
    """Pages of a tree over integer vectors, the root last. Each level is made of the one
    below: members are dealt to the nearest of some random ones, crowded ones again."""
    copies = np.ones(len(ids), np.int64) if copies is None else copies
    rng = np.random.default_rng(seed)
    pages: list[Page] = []
    real = rows.astype(np.float64)
    rest = np.sqrt(np.maximum(top - (real * real).sum(axis=1), 0.0))
    vectors, radii = np.concatenate([real, rest[:, None]], axis=1), np.zeros(len(rows))
    places = None
    while True:
        made = []
        for group in clusters(vectors, page, rng):
            route = vectors[group].mean(axis=0)
            far = np.sqrt(((vectors[group] - route) ** 2).sum(axis=1))
            radius = float((far + radii[group]).max())
            if places is None:
                pages.append(Page(route, radius, far, None, ids[group], rows[group], copies[group]))
            else:
                pages.append(Page(route, radius, far, places[group]))
            made.append(len(pages) - 1)
        if len(made) == 1:
            return pages
        places = np.array(made)
        vectors = np.stack([pages[i].route for i in made])
        radii = np.array([pages[i].radius for i in made])


def clusters(vectors: np.ndarray, page: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Places of ``vectors`` in groups of at most ``page``. Equal vectors, which no routing
    vector parts, are cut by place."""
    out, work = [], [np.arange(len(vectors))]
    while work:
        group = work.pop()
        if len(group) <= page:
            out.append(group)
            continue
        seeds = vectors[rng.choice(group, min(page, -(-len(group) * 2 // page), 64), replace=False)]
        near = np.empty(len(group), np.int64)
        for start in range(0, len(group), 4096):
            part = vectors[group[start:start + 4096]]
            near[start:start + 4096] = (-2 * part @ seeds.T + (seeds ** 2).sum(axis=1)).argmin(axis=1)
        parts = [group[near == i] for i in range(len(seeds))]
        parts = [p for p in parts if len(p)]
        if len(parts) == 1:
            parts = [group[start:start + page] for start in range(0, len(group), page)]
        work += parts
    # groups far below a page's size would make a deep tree of small pages
    return merged_small(out, page)


def merged_small(groups: list[np.ndarray], page: int) -> list[np.ndarray]:
    """Neighbouring groups joined while they fit one page (they come from one split)."""
    out: list[np.ndarray] = []
    for group in groups:
        if out and len(out[-1]) + len(group) <= page:
            out[-1] = np.concatenate([out[-1], group])
        else:
            out.append(group)
    return out


def search(pages: list[Page], top: float, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The k best (score, id) of a tree for a query vector; ``own``: its id, never found."""
    wide = np.append(query.astype(np.float64), 0.0)
    base = float(wide @ wide) + top
    best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst first
    limit = np.inf  # the k-th best distance so far
    start = float(np.sqrt(((pages[-1].route - wide) ** 2).sum()))
    queue = [(max(0.0, start - pages[-1].radius), len(pages) - 1, start)]
    while queue:
        least, at, distance = heapq.heappop(queue)
        if least > limit:
            break
        page = pages[at]
        # |d(q, route) - d(entry, route)| is at most d(q, entry): no distance needed
        gap = np.abs(distance - page.to_parent)
        if page.children is not None:
            radii = np.array([pages[c].radius for c in page.children])
            open_ = page.children[gap - radii <= limit]
            if len(open_):
                far = np.sqrt(((np.stack([pages[c].route for c in open_]) - wide) ** 2).sum(axis=1))
                for c, d in zip(open_.tolist(), far.tolist()):
                    low = max(0.0, d - pages[c].radius)
                    if low <= limit:
                        heapq.heappush(queue, (low, c, d))
            continue
        open_ = np.flatnonzero(gap <= limit)
        rows, named, copies = page.rows[open_], page.ids[open_], page.copies[open_]
        # no score exceeds the largest squared norm
        score = rows @ query if top < WIDE else rows.astype(object) @ query.astype(object)
        keep = named != own
        if len(best) == k:
            keep &= (score >= best[0][0]).astype(bool)
        found = zip(score[keep].tolist(), named[keep].tolist(), copies[keep].tolist())
        for value, number, n in heapq.nsmallest(k, found, key=lambda f: (-f[0], f[1])):
            for _ in range(min(n, k)):
                if len(best) < k:
                    heapq.heappush(best, (value, -number))
                elif (value, -number) > best[0]:
                    heapq.heapreplace(best, (value, -number))
        if len(best) == k:
            limit = margin(base - 2 * float(best[0][0]), top)
    return [(s, -i) for s, i in best]


def margin(squared: float, top: float) -> float:
    """A distance with room for rounding, which grows with the vectors' length: the last
    coordinate is a root of a difference of numbers up to ``top``."""
    return float(np.sqrt(max(squared, 0.0)) * (1 + SLACK) + SLACK * (1 + np.sqrt(top)))


def limbs(score: int) -> list[int]:
    """A whole number as 64-bit ones that compare like it, the first one signed."""
    return [score >> 126, score >> 63 & LONG_MAX, score & LONG_MAX]


def usable(rows: DataFrame, id_: str, vector: str, scale: int) -> DataFrame:
    """id and v (array of long) of the rows that take part."""
    x = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    rows = (rows.select(F.col(id_).cast("long").alias("id"), x.alias("x")).filter("id IS NOT NULL AND x IS NOT NULL")
            .filter(finite))
    sizes = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    size = sizes[0]["n"] if sizes else 0
    return rows.filter(F.size("x") == size).select("id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"))


def top_k(rows: DataFrame, is_query, k: int = 10, scale: int = 1024, id_: str = "vec_id", vector: str = "embedding",
          block_rows: int = 4096, query_rows: int = 2048, page: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for each row that ``is_query``
    (a condition on ``id``) holds for."""
    spark = rows.sparkSession
    ready = usable(rows, id_, vector, scale).groupBy("id", "v").agg(F.count(F.lit(1)).alias("copies"))
    ready = written(spark, ready, "mtree-rows")
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    n, top = ready.agg(F.count(F.lit(1)), F.max(norm)).first()
    blocks = max(1, -(-n // block_rows))

    def index(key: tuple, members: pa.Table) -> pa.Table:
        ids, vectors = matrix(members, "id", "v")
        order = np.lexsort((*vectors.T[::-1], ids))  # however the rows arrive, the same tree
        tree = build(ids[order], vectors[order], float(top), page, copies=members["copies"].to_numpy()[order])
        raw = lambda x, kind: None if x is None else np.ascontiguousarray(x, kind).tobytes()
        return pa.table({
            "block": pa.array([key[0].as_py()] * len(tree), pa.int32()), "page": pa.array(range(len(tree)), pa.int32()),
            "radius": [p.radius for p in tree], "route": [raw(p.route, "<f8") for p in tree],
            "to_parent": [raw(p.to_parent, "<f8") for p in tree],
            "children": pa.array([raw(p.children, "<i8") for p in tree], pa.binary()),
            "ids": pa.array([raw(p.ids, "<i8") for p in tree], pa.binary()),
            "rows": pa.array([raw(p.rows, "<i8") for p in tree], pa.binary()),
            "copies": pa.array([raw(p.copies, "<i8") for p in tree], pa.binary())})

    trees = (ready.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")).groupBy("block")
             .applyInArrow(index, PAGES))
    trees = written(spark, trees, "mtree-pages")
    queries = ready.filter(is_query)
    batches = max(1, -(-queries.count() // query_rows))
    # each batch of queries meets each block once: a light row per pair of them is not made,
    # queries are dealt to all blocks and grouped by (block, batch)
    asked = (queries.withColumn("batch", F.pmod(F.xxhash64("id", "v"), F.lit(batches)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    dealt = trees.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))

    def find(tree: pa.Table, some: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(tree) and len(some):
            pages = opened(tree)
            numbers, vectors = matrix(some, "id", "v")
            for number, vector_ in zip(numbers.tolist(), vectors):
                found_ = search(pages, float(top), vector_, number, k)
                out += [(number, vector_.tobytes(), i, s) for s, i in found_]
        columns = list(zip(*out)) if out else [[], [], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "query": pa.array(columns[1], pa.binary()),
                         "vec_id": pa.array(columns[2], pa.int64()), "score": pa.array([max(-LONG_MAX - 1, min(x, LONG_MAX)) for x in columns[3]], pa.int64()),
                         "exact": pa.array([limbs(x) for x in columns[3]], pa.list_(pa.int64()))})

    found = dealt.groupBy("block", "batch").cogroup(asked.groupBy("block", "batch")).applyInArrow(
        find, "query_id long, query binary, vec_id long, score long, exact array<long>")
    by = Window.partitionBy("query_id", "query").orderBy(F.desc("exact"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def opened(table_: pa.Table) -> list[Page]:
    """The pages of a block, by number."""
    pages = []
    for r in table_.sort_by("page").to_pylist():
        get = lambda name, kind: None if r[name] is None else np.frombuffer(r[name], kind)  # noqa: B023, E731
        ids = get("ids", "<i8")
        rows = None if ids is None else get("rows", "<i8").reshape(len(ids), -1)
        pages.append(Page(get("route", "<f8"), r["radius"], get("to_parent", "<f8"), get("children", "<i8"), ids, rows,
                          get("copies", "<i8")))
    return pages


def matrix(rows: pa.Table, id_: str, vector: str) -> tuple[np.ndarray, np.ndarray]:
    ids = rows[id_].to_numpy()
    flat = rows[vector].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return ids, flat.reshape(len(ids), -1).astype(np.int64)


def op10_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


#: The same in DuckDB's SQL: every query against every row.
OP10_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
