"""Dense surrogate keys and insert-if-absent dimension maintenance.

``dense_keys`` numbers distinct business keys 1..n in ascending key order (plus a
base offset) without a single-partition window:

1. distinct keys, range-partitioned and sorted within partitions;
2. each row tagged with its partition id and ``monotonically_increasing_id`` (which
   increases with the sort order inside a partition);
3. a reliable ``checkpoint()`` (to the cluster's shared ``spark.checkpoint.dir``) fixes
   partition contents, so a lost executor cannot re-sample different range bounds;
4. per-partition counts (one row per partition - bounded by the partition count)
   become offsets, broadcast back and added to the in-partition position.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def dense_keys(df: DataFrame, key: str, sk: str, base: int = 0,
               num_partitions: int | None = None) -> DataFrame:
    """(key, sk) for the distinct non-null ``key`` values of ``df``; sk = base + rank. The
    same distributed numbering whatever the number of keys."""
    spark = df.sparkSession
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    checkpoint_dir(spark)
    # without an explicit count the range exchange uses the session's shuffle partitions
    # and AQE may coalesce small neighbours (ranges stay contiguous and ordered)
    ranged = (keys.repartitionByRange(num_partitions, key) if num_partitions
              else keys.repartitionByRange(key))
    tagged = (ranged.sortWithinPartitions(key)
              .select(key, F.spark_partition_id().alias("_pid"),
                      F.monotonically_increasing_id().alias("_mid")))
    tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"),
                                        F.min("_mid").alias("_first"))
    # one row per partition: a window over it is bounded by the partition count
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_first",
                            F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .select(key, (F.lit(base) + F.col("_off") + (F.col("_mid") - F.col("_first")) + 1)
                    .cast("long").alias(sk)))


def first_writer(rows: DataFrame, key: str, attrs: Sequence[str],
                 order: str | None = None, master: bool = False) -> DataFrame:
    """One attribute set per business key: the earliest by ``order`` (first writer wins),
    or the smallest attribute tuple when no arrival order exists (deterministic). ``master``:
    a key has one row nearly always, so there is one exchange, by the key."""
    if not attrs:
        return rows.select(key).where(F.col(key).isNotNull()).distinct()
    packed = F.struct(*[F.col(a) for a in attrs])
    rows = rows.where(F.col(key).isNotNull())
    if order:
        agg = F.min_by(packed, F.col(order)).alias("_a")
    else:
        # hash-based distinct first (partial aggregation on the map side collapses the
        # fact-sized input to its distinct attribute sets); only that small set meets the
        # sort-based min over a struct
        if not master:
            rows = rows.select(key, *attrs).distinct()
        agg = F.min(packed).alias("_a")
    return (rows.groupBy(key).agg(agg)
            .select(key, *[F.col(f"_a.{a}").alias(a) for a in attrs]))


def max_key(existing: DataFrame | None, sk: str) -> int:
    """Largest surrogate key already issued (a single scalar to the driver)."""
    if existing is None:
        return 0
    row = existing.agg(F.max(sk).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


def new_members(arrivals: DataFrame, existing: DataFrame | None, key: str, sk: str,
                attrs: Sequence[str] = (), order: str | None = None,
                reduce: bool = False, base: int | None = None) -> DataFrame:
    """Insert-if-absent: business keys of ``arrivals`` missing from ``existing``, numbered
    after the largest existing key in ascending key order, with first-writer attributes.
    Output: key, sk, attrs. ``reduce``: semi-join reduction of ``existing`` first (for
    small batches against a big dimension). ``base``: the largest issued key when the
    caller knows it cheaply (else it is computed from ``existing``)."""
    cand = first_writer(arrivals, key, list(attrs), order)
    if existing is not None:
        known = members_in(existing, cand, key) if reduce else existing
        cand = cand.join(known.select(key), key, "left_anti")
    numbered = dense_keys(cand, key, sk, base=max_key(existing, sk) if base is None else base)
    return numbered.join(cand, key).select(key, sk, *attrs)


def upsert_dimension(arrivals: DataFrame, existing: DataFrame | None, key: str, sk: str,
                     attrs: Sequence[str] = (), order: str | None = None) -> DataFrame:
    """The dimension after the batch: existing members (unchanged, ``is_new`` false) plus
    the new ones (``is_new`` true)."""
    fresh = new_members(arrivals, existing, key, sk, attrs, order) \
        .withColumn("is_new", F.lit(True))
    if existing is None:
        return fresh
    old = existing.select(key, sk, *attrs).withColumn("is_new", F.lit(False))
    return old.unionByName(fresh)


def members_in(dim: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Semi-join reduction: the members of a (possibly huge) dimension whose key occurs in
    ``rows``. The dimension is the streamed side and the batch's distinct keys the build
    side, so when a batch is small the dimension is scanned, never shuffled (the planner
    broadcasts the key set only under its size threshold, sort-merge beyond it)."""
    return dim.join(rows.select(key).distinct(), key, "left_semi")


def fill_keys(rows: DataFrame, fresh: DataFrame, key: str, sk: str, known: str,
              some_known: bool = True) -> DataFrame:
    """``sk`` for every row: the column ``known`` where it has a value, else that of its member in
    ``fresh`` (key, sk). Only rows of new members are joined; with no new member there is no join,
    and ``some_known`` false says that all are new."""
    if fresh.isEmpty():
        return rows.withColumnRenamed(known, sk)
    if not some_known:
        return rows.drop(known).join(fresh, key)
    old = rows.where(F.col(known).isNotNull()).withColumnRenamed(known, sk)
    return old.unionByName(rows.where(F.col(known).isNull()).drop(known).join(fresh, key))


def lookup_keys(rows: DataFrame, dims: Sequence[tuple[DataFrame, str, str]],
                reduce: bool = False) -> DataFrame:
    """Replace business keys by surrogate keys: for each (dim, key, sk) an inner equi-join
    on the business key (rows without a member are routed to quarantine beforehand).
    ``reduce``: join only the members this batch references (semi-join reduction)."""
    out = rows
    for dim, key, sk in dims:
        d = dim.select(key, sk)
        out = out.join(members_in(d, rows, key) if reduce else d, key)
    return out
