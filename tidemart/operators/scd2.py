"""Slowly changing dimension, type 2: keep history rows with validity ranges.

``merge`` compares the current version of each key with a new snapshot (null-safe on
the tracked attributes): changed keys get their current row closed at ``effective``
and a new current row opened; unseen keys are opened; keys absent from the snapshot
and unchanged keys are kept as they are. One full outer join on the key; each of its rows
is exploded into the versions it yields, and history rows that are not current pass through
untouched. Attributes that are not tracked travel along: an unchanged key takes them from
the snapshot (they are overwritten in place), a closed version keeps its own.

``with_version_keys`` adds a dense version key; ``(key, valid_from)`` identifies a version.

A warehouse keeps its history append-only (``opened``): a load adds the versions that it opens,
and no row is ever rewritten to be closed. ``versions`` derives the ends of validity when it
is read, and ``as_of`` gives each fact the version of its day.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .keys import dense_keys

VALIDITY = ("valid_from", "valid_to", "is_current")


def initial(snapshot: DataFrame, key: str, valid_from: Column) -> DataFrame:
    return snapshot.select("*", valid_from.alias("valid_from"),
                           F.lit(None).cast("date").alias("valid_to"),
                           F.lit(True).alias("is_current"))


def merge(history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str],
          effective: _dt.date) -> DataFrame:
    eff = F.lit(effective).cast("date")
    attrs = [c for c in history.columns if c not in (key, *VALIDITY)]
    missing = [c for c in tracked if c not in attrs]
    if missing:
        raise ValueError(f"tracked columns {missing} are not in the history")
    types = {f.name: f.dataType for f in history.schema.fields}
    cur = history.where("is_current").select(
        key, F.struct(*attrs, "valid_from").alias("_cur"))
    # an attribute that the snapshot lacks keeps its current value
    snap = snapshot.select(key, F.struct(*[F.col(a).cast(types[a]).alias(a) for a in attrs
                                           if a in snapshot.columns]).alias("_new"))
    j = cur.join(snap, key, "full_outer")
    has_cur, seen = F.col("_cur").isNotNull(), F.col("_new").isNotNull()
    same = F.lit(True)
    for a in tracked:
        same = same & F.col(f"_cur.{a}").eqNullSafe(F.col(f"_new.{a}"))
    changed = has_cur & seen & ~same

    def version(cond: Column, fresh: Column, start: Column, end: Column, current: bool) -> Column:
        values = [(F.when(fresh, F.col(f"_new.{a}")).otherwise(F.col(f"_cur.{a}"))
                   if a in snapshot.columns else F.col(f"_cur.{a}")).alias(a) for a in attrs]
        return F.when(cond, F.struct(*values, start.alias("valid_from"), end.alias("valid_to"),
                                     F.lit(current).alias("is_current")))

    none = F.lit(None).cast("date")
    start = F.col("_cur.valid_from")
    versions = F.array(
        version(has_cur & ~changed, seen, start, none, True),       # kept
        version(changed, F.lit(False), start, eff, False),          # closed
        version(changed | ~has_cur, F.lit(True), eff, none, True))  # opened
    now = (j.select(key, F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("_v"))
           .select(key, "_v.*"))
    cols = [key, *attrs, *VALIDITY]
    return history.where(~F.col("is_current")).select(*cols).unionByName(now.select(*cols))


def with_version_keys(history: DataFrame, key: str, sk: str = "version_sk") -> DataFrame:
    """``history`` with a dense key per version, by key and start of validity."""
    named = history.withColumn("_version", F.struct(key, "valid_from"))
    return named.join(dense_keys(named, "_version", sk), "_version").drop("_version")


RUN = ("batch_id", "attempt")


def latest(history: DataFrame, key: str) -> DataFrame:
    """One row per (key, valid_from): of several loads for one day the last one counts."""
    last = Window.partitionBy(key, "valid_from").orderBy(*[F.desc(c) for c in RUN])
    return history.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def opened(history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str],
           effective: _dt.date) -> DataFrame:
    """The versions that ``snapshot`` opens on the day ``effective``: keys without a version on
    that day, and keys whose version of that day differs (null-safe) in a tracked attribute.
    The history meets the snapshot once, as one row per key."""
    day = F.lit(effective).cast("date")
    attrs = [c for c in snapshot.columns if c != key]
    newest = F.max_by(F.struct(*tracked), F.struct("valid_from", *RUN)).alias("_was")
    known = history.where(F.col("valid_from") <= day).groupBy(key).agg(newest)
    same = F.col("_was").isNotNull()
    for a in tracked:
        same = same & F.col(f"_was.{a}").eqNullSafe(F.col(a))
    return snapshot.join(known, key, "left").where(~same).select(key, *attrs, day.alias("valid_from"))


def versions(history: DataFrame, key: str) -> DataFrame:
    """``history`` with valid_to (exclusive, null: still valid) and is_current."""
    after = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    out = latest(history, key).drop(*RUN).withColumn("valid_to", after)
    return out.withColumn("is_current", F.col("valid_to").isNull())


def as_of(facts: DataFrame, history: DataFrame, key: str, date: str) -> DataFrame:
    """``facts`` with the attributes of the version that was valid on the day ``date``; days
    before a key's first version take that one, keys without a version nulls.

    An equi-join on the key with the range as its condition. The versions are stored first: a
    plain exchange on either side lets adaptive execution split a key of many facts."""
    v = versions(history, key)
    first = F.min("valid_from").over(Window.partitionBy(key))
    start = F.when(F.col("valid_from") > first, F.col("valid_from"))
    v = stored(facts.sparkSession, v.withColumn("_start", start).withColumnRenamed(key, "_key"), "versions")
    valid = ((F.col(key) == F.col("_key")) & (F.col("_start").isNull() | (F.col(date) >= F.col("_start")))
             & (F.col("valid_to").isNull() | (F.col(date) < F.col("valid_to"))))
    return facts.join(v, valid, "left").drop("_key", "_start")
