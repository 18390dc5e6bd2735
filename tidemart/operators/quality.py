"""Data-quality checks: the published warehouse checks and the DDL constraints Spark
does not enforce (NOT NULL, UNIQUE, FOREIGN KEY, CHAR(1), value domains).

Each check is one aggregation pass (partial aggregates before the shuffle) or an
anti-join; results are small tables with one row per check.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed domain rules of the customer dimension.
GENDERS = ("M", "F")
CITY_CATEGORIES = ("A", "B", "C")
OCCUPATION_RANGE = (0, 20)
AGE_GROUPS = ("0-17", "18-25", "26-35", "36-45", "46-50", "51-55", "55+")
MARITAL_VALUES = (0, 1)

FK_SPECS = [
    # fact column, dimension, dimension key
    ("customer_sk", "customer", "customer_sk"),
    ("product_sk", "product", "product_sk"),
    ("store_sk", "store", "store_sk"),
    ("supplier_sk", "supplier", "supplier_sk"),
    ("date_sk", "time", "date_sk"),
]


def completeness(source: DataFrame | int, fact: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows in = facts + quarantined (``unaccounted_rows`` must be 0). ``source``: the raw
    input, or the number of its rows where a log has counted it. One union, one aggregate."""
    counted = isinstance(source, int)
    flag = lambda df, *f: df.select(*[F.lit(x).cast("long").alias(n)
                                      for x, n in zip(f, ("s", "f", "q"))])
    rows = flag(fact, 0, 1, 0).unionByName(flag(quarantine, 0, 0, 1))
    if not counted:
        rows = rows.unionByName(flag(source, 1, 0, 0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    out = rows.agg((F.lit(source).cast("long") if counted else total("s")).alias("source_rows"),
                   total("f").alias("loaded_rows"), total("q").alias("rejected_rows"))
    return out.withColumn("unaccounted_rows",
                          F.col("source_rows") - F.col("loaded_rows") - F.col("rejected_rows"))


def orphans(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose foreign key has no dimension member, per foreign key. One scan of the
    fact: its keys are counted by value before they meet the members of all dimensions."""
    specs = [(c, d, k) for c, d, k in FK_SPECS if d in dims]
    pairs = F.array(*[F.struct(F.lit(c).alias("fk_column"), F.col(c).cast("long").alias("value"))
                      for c, _, _ in specs])
    used = (fact.select(F.explode(pairs).alias("p")).groupBy("p.fk_column", "p.value")
            .agg(F.count(F.lit(1)).alias("n")))
    members = None
    for c, d, k in specs:
        part = dims[d].select(F.lit(c).alias("fk_column"), F.col(k).cast("long").alias("value")).distinct()
        members = part if members is None else members.unionByName(part)
    missing = used.join(members, ["fk_column", "value"], "left_anti")
    names = fact.sparkSession.createDataFrame([(c, f"dim_{d}") for c, d, _ in specs],
                                              "fk_column string, dimension string")
    per = missing.groupBy("fk_column").agg(F.sum("n").alias("orphan_rows"))
    return names.join(per, "fk_column", "left").select(
        "fk_column", "dimension", F.coalesce("orphan_rows", F.lit(0)).cast("long").alias("orphan_rows"))


def lengths(df: DataFrame, limits: dict[str, int], table: str) -> DataFrame:
    """Values longer than their VARCHAR(n), per column, in one pass."""
    agg = df.agg(*[F.coalesce(F.sum(F.when(F.length(c) > n, 1).otherwise(0)), F.lit(0)).cast("long").alias(c)
                   for c, n in limits.items()])
    return agg.unpivot([], list(limits), "column_name", "too_long") \
        .select(F.lit(table).alias("table_name"), "column_name", "too_long")


def duplicates(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Business keys that occur more than once (UNIQUE constraint)."""
    parts = []
    for name, (df, key) in tables.items():
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        parts.append(per_key.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                                 F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long")
                                 .alias("excess_rows"))
                     .select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"),
                             "duplicate_keys", "excess_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULLs per column in one aggregation pass, returned one row per column."""
    agg = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(c)
                   for c in columns])
    return agg.unpivot([], list(columns), "column_name", "null_count") \
        .select(F.lit(table).alias("table_name"), "column_name", "null_count")


def ranges(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Min / max per column (as text, so that mixed types share one table)."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).cast("string").alias(f"{c}__min"), F.max(c).cast("string").alias(f"{c}__max")]
    row = df.agg(*aggs)
    stacked = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__min").alias("min_value"),
                        F.col(f"{c}__max").alias("max_value")) for c in columns]
    return row.select(F.explode(F.array(*stacked)).alias("r")).select(
        F.lit(table).alias("table_name"), "r.column_name", "r.min_value", "r.max_value")


def domains(customers: DataFrame) -> DataFrame:
    """Violations of the customer domain rules (CHAR(1) lengths, code ranges, bands)."""
    lo, hi = OCCUPATION_RANGE
    rules = {
        "gender_char1": (F.length("gender") != 1) | ~F.col("gender").isin(*GENDERS),
        "city_category_char1": (F.length("city_category") != 1)
        | ~F.col("city_category").isin(*CITY_CATEGORIES),
        "occupation_range": (F.col("occupation") < lo) | (F.col("occupation") > hi),
        "age_group_band": ~F.col("age_group").isin(*AGE_GROUPS),
        "marital_status_flag": ~F.col("marital_status").isin(*MARITAL_VALUES),
    }
    agg = customers.agg(*[F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(name)
                          for name, cond in rules.items()])
    return agg.unpivot([], list(rules), "rule", "violations")
