"""Compaction: the folders of many small batches become one per table.

A stream leaves a folder per micro-batch and table. ``compact`` rewrites the published batches
up to one id, leaving each source's newest batch alone (a restarted stream may replay that
one), as one attempt under the largest id of them. Rows keep their keys and no report reads the
batch id; partial sums of the pre-aggregate are added up, so it has one row per store and
quarter afterwards. Compacted batches can't be replayed any more; the log refuses that.

The merged folders are an attempt like any other: readers see them from the moment the log
says so, all tables at once, and a run that breaks off before changes nothing. ``vacuum`` then
removes the folders that no snapshot taken from now on refers to; reports that are under
way still read them, so keep them (``keep_old``) while such reports run.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from .. import schema
from ..operators import scd2
from ..session import children, delete_below
from ..streaming import distincts as bitmaps
from ..streaming import preagg
from . import commits, load


def candidates(spark: SparkSession, root: str) -> tuple[int, int] | None:
    """(lowest, highest) batch id to merge, or None if there is nothing to merge. Batches
    that never ended are in nobody's way."""
    log = commits.log(spark, root)
    merged = log.where("state = 'compacted'").agg(F.max("batch_id")).first()[0]
    loads = log.where(F.col("source") != commits.COMPACTION)
    if merged is not None:  # what was merged lies under that id
        loads = loads.where(F.col("batch_id") >= merged)
    last = loads.groupBy("batch_id").agg(F.max("source").alias("source"),
                                         F.max((F.col("state") == "done").cast("int")).alias("done"))
    newest = F.col("batch_id") == F.max("batch_id").over(Window.partitionBy("source"))
    keep = last.withColumn("keep", newest).where("done = 1 OR keep")
    first_kept = keep.where("keep").agg(F.min("batch_id")).first()[0]
    row = keep.where(F.col("batch_id") < (first_kept if first_kept is not None else 0)) \
        .agg(F.min("batch_id"), F.max("batch_id")).first()
    return None if row[0] is None or row[0] == row[1] else (int(row[0]), int(row[1]))


def compact(spark: SparkSession, root: str, keep_old: bool = False,
            point_keys: tuple[str, ...] = (), distincts: bool = False) -> dict[str, int]:
    """Merge what can be merged; batches merged per table. ``point_keys``: the fact's merged files
    are sorted by the first and have Bloom filters on all, as in ``load_batch``. ``distincts``:
    the customers' bitmaps are made anew from the merged facts, for batches that were
    loaded without them."""
    root = root.rstrip("/")
    span = candidates(spark, root)
    if span is None:
        return {}
    low, high = span
    snap = commits.snapshot(spark, root)
    batch = commits.begin_compaction(spark, root, high, low)
    merged = {}
    for name, (_, parts) in (schema.TABLES | schema.INTERNAL).items():
        rows = snap.rows(name).where(F.col("batch_id").between(low, high))
        merged[name] = rows.select("batch_id").distinct().count()
        if name in schema.HISTORIES:  # which load opened a version is told by its folder
            rows = scd2.latest(rows, schema.HISTORIES[name][0].names[0])
        rows = rows.drop("batch_id", "attempt")
        if name == "store_quarterly_sales":
            rows = preagg.merged(rows)
        elif name == bitmaps.TABLE:
            rows = bitmaps.merged(rows) if not distincts else bitmaps.partials(
                snap.rows("sales_fact").where(F.col("batch_id").between(low, high)),
                snap.rows("dim_customer"), snap.rows("dim_product"))
        extra = tuple(p for p in parts if p not in ("batch_id", "attempt"))
        keys = point_keys if name == "sales_fact" else ()
        order = ("cube",) if name == bitmaps.TABLE else keys[:1]
        load.laid_out(rows, extra, order, keys).parquet(f"{root}/{name}/batch_id={high}/attempt={batch.attempt}")
    facts = load.read_attempt(spark, root, "sales_fact", batch).count()
    commits.compacted(spark, root, batch, low, facts)
    if not keep_old:
        vacuum(spark, root)
    return merged


def vacuum(spark: SparkSession, root: str) -> int:
    """Remove the folders that published attempts have taken the place of; their number.
    Names of folders are all that the driver lists. Attempts under way are left alone."""
    root = root.rstrip("/")
    snap = commits.snapshot(spark, root)
    removed = 0
    for name in schema.TABLES | schema.INTERNAL:
        folders = [(int(b[9:]), int(a[8:])) for b in children(spark, f"{root}/{name}") if b.startswith("batch_id=")
                   for a in children(spark, f"{root}/{name}/{b}") if a.startswith("attempt=")]
        for b, a in commits.superseded(snap, name, folders):
            delete_below(spark, root, f"{name}/batch_id={b}/attempt={a}")
            if not [x for x in children(spark, f"{root}/{name}/batch_id={b}") if x.startswith("attempt=")]:
                delete_below(spark, root, f"{name}/batch_id={b}")
            removed += 1
    return removed
