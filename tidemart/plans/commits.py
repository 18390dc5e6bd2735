"""The warehouse's log: batch identity, attempts, and what readers may see.

A load names its ``source`` (a folder of files, a stream, ...) and the ``offset`` within it (a
digest of its files, a number, ...). A pair that the log knows gets its old batch id back; any
other gets the next id. Every run of a batch is an *attempt* with a number and folders of its
own, so a run never touches what readers see. The row ``done`` publishes an attempt: from then on,
and in one step for all tables, readers take its facts instead of the former attempt's.
Members of dimensions stay from every published attempt, as facts of later batches may refer
to them. A row ``compacted`` publishes one attempt in the place of a span of batches.

``snapshot`` reads the log once and says which (batch, attempt) folders are live, as intervals
of batch ids: conditions on partition columns, so a scan lists no other folder. An attempt
that broke off is never in a snapshot, whatever it has written.

The log is a table of small files below ``<root>/_commits/epoch=N``. Once an epoch has more than
``TAIL`` files its rows are written as one file of the next epoch, without rows that no longer
matter; readers take the newest epoch that is complete, so the files read per load are
bounded however many batches there are. One loader writes to a warehouse at a time; a second
one that begins meanwhile is noticed when both claim an id, and refused.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..session import children, delete_below, read_or_empty

LOG = T.StructType([
    T.StructField("batch_id", T.LongType()), T.StructField("attempt", T.LongType()),
    T.StructField("low", T.LongType()), T.StructField("source", T.StringType()),
    T.StructField("offset", T.StringType()), T.StructField("state", T.StringType()),
    T.StructField("rows", T.LongType()), T.StructField("facts", T.LongType()),
    T.StructField("rejects", T.LongType()), T.StructField("at", T.TimestampType())])
#: Files of an epoch after which the log is condensed into the next one.
TAIL = 32
COMPACTION = "_compaction"


@dataclass(frozen=True)
class Batch:
    batch_id: int
    replay: bool
    attempt: int = 0
    source: str = ""
    offset: str = ""


Spans = tuple[tuple[int, int, int], ...]  # (attempt, lowest batch, highest batch)


def _within(spans: Spans) -> Column:
    cond = F.lit(False)
    for attempt, low, high in spans:
        batches = F.col("batch_id").eqNullSafe(low) if low == high else F.col("batch_id").between(low, high)
        cond = cond | (F.col("attempt").eqNullSafe(attempt) & batches)
    return cond


@dataclass(frozen=True)
class Snapshot:
    """The published folders of a warehouse at one moment."""
    spark: SparkSession = field(repr=False, compare=False)
    root: str
    facts: Spans = ()
    members: Spans = ()

    def live(self, name: str) -> Column:
        return _within(self.members if name.startswith("dim_") else self.facts)

    def rows(self, name: str) -> DataFrame:
        """The published rows of a table, in its schema."""
        return read_or_empty(self.spark, f"{self.root}/{name}", schema.full(name)).where(self.live(name))

    def with_own(self, batch: Batch) -> Snapshot:
        """With the members that a running attempt has written itself."""
        return replace(self, members=(*self.members, (batch.attempt, batch.batch_id, batch.batch_id)))


def _epochs(spark: SparkSession, root: str) -> list[int]:
    """The complete epochs, ascending."""
    named = [name for name in children(spark, f"{root}/_commits") if name.startswith("epoch=")]
    return sorted(int(name[6:]) for name in named if "_SUCCESS" in children(spark, f"{root}/_commits/{name}"))


def log_files(spark: SparkSession, root: str) -> int:
    """Files that a reader of the log opens."""
    epochs = _epochs(spark, root.rstrip("/"))
    return sum(name.endswith(".parquet") for name in
               children(spark, f"{root.rstrip('/')}/_commits/epoch={epochs[-1]}")) if epochs else 0


def log(spark: SparkSession, root: str) -> DataFrame:
    epochs = _epochs(spark, root)
    return read_or_empty(spark, f"{root}/_commits/epoch={epochs[-1] if epochs else 0}", LOG)


def _append(spark: SparkSession, root: str, batch: Batch, state: str, counts: dict[str, int] | None = None,
            low: int | None = None) -> None:
    counts = counts or {}
    row = [(batch.batch_id, batch.attempt, low, batch.source, batch.offset, state, counts.get("rows"),
            counts.get("facts"), counts.get("rejects"))]
    epochs = _epochs(spark, root)
    (spark.createDataFrame(row, T.StructType(LOG.fields[:-1])).withColumn("at", F.current_timestamp()).coalesce(1)
     .write.mode("append").parquet(f"{root}/_commits/epoch={epochs[-1] if epochs else 0}"))


def begin(spark: SparkSession, root: str, source: str, offset: str, wanted: int | None = None) -> Batch:
    """A new attempt of the batch of (source, offset), newly numbered unless the log knows it."""
    known = log(spark, root)
    mine = (F.col("source") == source) & (F.col("offset") == offset)
    found = known.agg(
        F.max(F.when(mine, F.col("batch_id"))).alias("mine"), F.max("batch_id").alias("newest"),
        F.max(F.when(mine & (F.col("state") == "done"), F.col("batch_id"))).alias("finished"),
        F.max(F.when(F.col("state") == "compacted", F.col("batch_id"))).alias("merged")).first()
    newest, merged = found["newest"], found["merged"]
    if found["mine"] is not None and (merged is None or found["mine"] > merged or found["finished"] is not None):
        number = int(found["mine"])
        if merged is not None and number <= merged:
            raise ValueError(f"batch {number} has been compacted and can't be replayed")
        if wanted is not None and wanted != number:
            raise ValueError(f"{source} at {offset} is batch {number}, not {wanted}")
        last = known.where(F.col("batch_id") == number).agg(F.max("attempt")).first()[0]
        batch = Batch(number, True, int(last) + 1, source, offset)
        _append(spark, root, batch, "begun")
        return batch
    # unknown, or broken off before a compaction went past its id
    fresh = 0 if newest is None else int(newest) + 1
    if wanted is not None:
        if newest is not None and wanted <= newest:
            raise ValueError(f"batch id {wanted} isn't newer than {newest}, and it isn't a replay "
                             f"of {source} at {offset}")
        fresh = wanted
    batch = Batch(fresh, False, 0, source, offset)
    _append(spark, root, batch, "begun")
    rivals = log(spark, root).where((F.col("batch_id") == fresh) & (F.col("state") == "begun")) \
        .select("source", "offset").distinct().count()
    if rivals > 1:
        raise RuntimeError(f"another loader began batch {fresh} of this warehouse meanwhile")
    return batch


def done(spark: SparkSession, root: str, batch: Batch, counts: dict[str, int]) -> None:
    """Publish an attempt: all its tables at once."""
    _append(spark, root, batch, "done", counts)
    condense(spark, root)


def begin_compaction(spark: SparkSession, root: str, high: int, low: int) -> Batch:
    last = log(spark, root).where(F.col("batch_id") == high).agg(F.max("attempt")).first()[0]
    batch = Batch(high, False, int(last) + 1, COMPACTION, "")
    _append(spark, root, batch, "begun", low=low)
    return batch


def compacted(spark: SparkSession, root: str, batch: Batch, low: int, facts: int) -> None:
    _append(spark, root, batch, "compacted", {"facts": facts}, low=low)
    condense(spark, root)


def condense(spark: SparkSession, root: str, tail: int | None = None) -> bool:
    """Write the log as one file of the next epoch, if it has more than ``tail`` files. The
    epoch before stays for readers that have just opened it."""
    if log_files(spark, root) <= (TAIL if tail is None else tail):
        return False
    epochs = _epochs(spark, root)
    rows = log(spark, root)
    # what began and ended needs one row; an attempt that didn't end keeps its number taken
    order = Window.partitionBy("batch_id", "attempt").orderBy((F.col("state") == "begun").cast("int"), F.desc("at"))
    last = rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    last.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .parquet(f"{root}/_commits/epoch={epochs[-1] + 1}")
    for old in epochs[:-1]:
        delete_below(spark, root, f"_commits/epoch={old}")
    return True


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    """What readers that begin now see. The folders come to the driver as intervals of
    neighbouring batch ids, not one by one."""
    root = root.rstrip("/")
    ended = log(spark, root).where("state IN ('done', 'compacted')").select("batch_id", "attempt", "state")
    merged = ended.where("state = 'compacted'").agg(F.max("batch_id")).first()[0]
    if merged is not None:  # its attempt holds every batch up to it
        ended = ended.where((F.col("batch_id") > merged) | ((F.col("batch_id") == merged) & (F.col("state") == "compacted")))
    newest = F.col("attempt") == F.max("attempt").over(Window.partitionBy("batch_id"))
    # of two compactions up to one id the later one holds the members, too
    member = F.lit(True) if merged is None else (F.col("batch_id") != merged) | F.col("_newest")
    kinds = F.array(F.when(F.col("_newest"), F.lit("facts")), F.when(member, F.lit("members")))
    kinds = ended.distinct().withColumn("_newest", newest).select(
        "batch_id", "attempt", F.explode(F.array_compact(kinds)).alias("kind"))
    place = F.row_number().over(Window.partitionBy("kind", "attempt").orderBy("batch_id"))
    found = kinds.withColumn("_g", F.col("batch_id") - place).groupBy("kind", "attempt", "_g") \
        .agg(F.min("batch_id").alias("low"), F.max("batch_id").alias("high")).collect()
    spans = {kind: tuple(sorted((int(r["attempt"]), int(r["low"]), int(r["high"])) for r in found if r["kind"] == kind))
             for kind in ("facts", "members")}
    return Snapshot(spark, root, **spans)


def published_facts(snap: Snapshot) -> int | None:
    """Facts of the published batches by the log, without a look at them; None where a batch
    didn't count them."""
    ended = log(snap.spark, snap.root).where("state IN ('done', 'compacted')").where(_within(snap.facts))
    n, counted, facts = ended.agg(F.count(F.lit(1)), F.count("facts"), F.sum("facts")).first()
    return int(facts or 0) if n == counted else None


def digest(files: DataFrame) -> tuple[int, str]:
    """(number, digest) of the rows of ``files`` (path, size, modified); no name is collected."""
    hashed = files.select(F.xxhash64("path", "size", "modified").cast("decimal(38,0)").alias("h"))
    row = hashed.agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("s")).first()
    return int(row["n"]), f"{row['n']} files {row['s'] or 0}"


def superseded(snap: Snapshot, name: str, folders: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those (batch, attempt) folders of a table that no reader of ``snap`` sees and that a
    published attempt has taken the place of; an attempt under way isn't among them."""
    spans = snap.members if name.startswith("dim_") else snap.facts
    holds = lambda b, a: any(x == a and low <= b <= high for x, low, high in spans)
    first = min((low for _, low, _ in snap.facts), default=0)
    newest = {}
    for attempt, low, high in snap.facts:
        for b, _ in folders:
            if low <= b <= high:
                newest[b] = max(newest.get(b, -1), attempt)
    return [(b, a) for b, a in folders if not holds(b, a) and (b < first or a < newest.get(b, -1))]
