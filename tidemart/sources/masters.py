"""CSV readers for the master files and the transaction files.

The source system writes CSV with a leading unnamed index column, blanks after the
commas and (products) a ``price$`` column. Spark maps a user schema onto CSV columns
*by position*, so the header is read once and an all-text schema is built in file
order; columns are then selected *by name* and typed. A transaction file whose header
differs from the schema is quarantined rather than silently mis-assigned; headers are
compared where the files are read, in the tasks of the one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import money
from ..session import stored

# Fixed source column names (CSV headers of the master and transaction files).
CUSTOMER_FIELDS = {
    "Customer_ID": ("customer_id", "string"),
    "Gender": ("gender", "string"),
    "Age": ("age_group", "string"),
    "Occupation": ("occupation", "int"),
    "City_Category": ("city_category", "string"),
    "Stay_In_Current_City_Years": ("stay_in_current_city_years", "int"),
    "Marital_Status": ("marital_status", "int"),
}
PRODUCT_FIELDS = {
    "Product_ID": ("product_id", "string"),
    "Product_Category": ("product_category", "string"),
    "price$": ("price", "double"),
    "storeID": ("store_id", "int"),
    "storeName": ("store_name", "string"),
    "supplierID": ("supplier_id", "int"),
    "supplierName": ("supplier_name", "string"),
}
TRANSACTION_FIELDS = {
    "orderID": "order_id",
    "Customer_ID": "customer_id",
    "Product_ID": "product_id",
    "quantity": "quantity",
    "date": "date",
}

# Empty fields are read as '' (not NULL): a NULL in a text column then means the token
# was missing (short row), which is detectable even when the CSV parser prunes columns
# and leaves ``_corrupt_record`` unset.
_CSV_OPTS = {"header": "true", "ignoreLeadingWhiteSpace": "true",
             "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE",
             "nullValue": "<NULL>", "emptyValue": ""}


def header_schema(spark: SparkSession, path: str) -> T.StructType:
    """All-string schema in file order, names trimmed; the unnamed index column is
    ``_c0``. Reads only the header line(s)."""
    names = spark.read.options(**_CSV_OPTS).csv(path).columns
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _typed_select(df: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    cols = [F.col(ROW_ORDER)] if ROW_ORDER in df.columns else []
    for src, (dst, typ) in fields.items():
        if src in df.columns:
            c = F.trim(F.col(f"`{src}`"))
            cols.append(c.alias(dst) if typ == "string"
                        else F.expr(f"try_cast(trim(`{src}`) AS {typ})").alias(dst))
        else:
            # key absent -> the reference's defaults: 0 for numbers, '' for text
            cols.append((F.lit("") if typ == "string" else F.lit(0).cast(typ)).alias(dst))
    return df.select(*cols)


ROW_ORDER = "_row_order"


def file_row_order():
    """Position of a row in the files of a file-source scan: (file modification time,
    file, split start, position in the split). Exact line order inside a file and file
    order by arrival; deterministic on recompute (a scan's splits are fixed)."""
    m = F.col("_metadata")
    return F.struct(m["file_modification_time"].alias("mtime"), m["file_path"].alias("file"),
                    m["file_block_start"].alias("block"),
                    F.monotonically_increasing_id().alias("pos"))


def _typed_master(raw: DataFrame, fields: dict, row_order: bool) -> DataFrame:
    out = _typed_select(raw.withColumn(ROW_ORDER, file_row_order()) if row_order else raw,
                        fields)
    return out


def read_customer_master(spark: SparkSession, path: str, row_order: bool = False) -> DataFrame:
    """Typed customer master. ``row_order`` adds ``_row_order`` so that a repeated key
    resolves to its first record in file order (as the source system reads it)."""
    schema = header_schema(spark, path)
    raw = spark.read.options(**_CSV_OPTS).schema(schema).csv(path)
    return _typed_master(raw, CUSTOMER_FIELDS, row_order)


def read_product_master(spark: SparkSession, path: str, row_order: bool = False) -> DataFrame:
    schema = header_schema(spark, path)
    raw = spark.read.options(**_CSV_OPTS).schema(schema).csv(path)
    out = _typed_master(raw, PRODUCT_FIELDS, row_order)
    return out.withColumn("price", money.price("price"))


def transaction_schema(spark: SparkSession, sample_path: str) -> T.StructType:
    """Text schema of the transaction files (file order) plus the corrupt-record column."""
    base = header_schema(spark, sample_path)
    return T.StructType(base.fields + [T.StructField("_corrupt_record", T.StringType(), True)])


# Defaults for a transaction column that is absent from the header (the source's
# ``row.get(name, default)``): '' for text, 0 for the quantity. A column that is present
# but has no token on a short row stays NULL and marks the row corrupt.
TRANSACTION_DEFAULTS = {"order_id": "", "customer_id": "", "product_id": "", "quantity": "0",
                        "date": ""}


# Further columns that are used if a file has them; any other column is ignored, whatever
# its name (one called as a master's attribute would be ambiguous after the join).
OPTIONAL_FIELDS = ("line_number", "supplier_id", "_corrupt_record")


def _by_name(df: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    cols = []
    for src, dst in TRANSACTION_FIELDS.items():
        cols.append(F.col(f"`{src}`").alias(dst) if src in df.columns
                    else F.lit(TRANSACTION_DEFAULTS[dst]).alias(dst))
    known = {c.lower(): c for c in df.columns}
    extra = [F.col(f"`{known[c]}`").alias(c) for c in OPTIONAL_FIELDS if c in known]
    return df.select(*cols, *extra, *more)


# Transaction files are read without the reader's own header handling: the first line of each
# file arrives as a row like any other and is compared with the schema where it is read.
_RAW_OPTS = {**_CSV_OPTS, "header": "false", "columnNameOfCorruptRecord": "_corrupt_record"}


def _is_header(schema: T.StructType):
    """Whether a row's fields are the column names of ``schema``, in this order (a blank name is
    ``_c`` and its place; a byte-order mark may precede the first one)."""
    names = [f.name for f in schema.fields if f.name != "_corrupt_record"]
    same = F.col("_corrupt_record").isNull() if "_corrupt_record" in schema.names else F.lit(True)
    for i, name in enumerate(names):
        field = F.coalesce(F.col(f"`{name}`"), F.lit(""))
        if i == 0:
            field = F.trim(F.regexp_replace(field, "^\ufeff", ""))
        same = same & field.eqNullSafe(F.lit("" if name == f"_c{i}" else name))
    return same


def _with_file(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name, with the row's file and block, and whether it looks like a header."""
    m = F.col("_metadata")
    named = raw.select("*", _is_header(schema).alias("_head"), m["file_path"].alias("_path"), m["file_size"].alias("_size"),
                       m["file_modification_time"].alias("_modified"), m["file_block_start"].alias("_block"))
    extra = ["_head", "_path", "_size", "_modified", "_block"]
    return _by_name(named, extra)


def numbered(rows: DataFrame) -> DataFrame:
    """Rows in the order in which their files are read."""
    return rows.withColumn("_row", F.monotonically_increasing_id())


def resolved(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Transactions of files that were read with their headers: rows are written once to the
    shared folder; each file's first line (the first row of the block that starts at 0) is
    dropped and tells ``_bad_header`` for all rows of the file; ``_file`` names the file."""
    staged = stored(spark, rows, "transactions", "zstd")
    heads = staged.where("_block = 0").groupBy("_path").agg(F.min("_row").alias("_first"),
                                                           F.min_by("_head", "_row").alias("_good"))
    heads = stored(spark, heads, "headers")  # a row per file
    out = staged.join(heads, "_path", "left").where(F.coalesce(F.col("_row") != F.col("_first"), F.lit(True)))
    return out.withColumn("_bad_header", ~F.coalesce("_good", F.lit(False))).withColumn(
        "_file", F.struct(F.col("_path").alias("path"), F.col("_size").alias("size"), F.col("_modified").alias("modified"))) \
        .drop("_path", "_size", "_modified", "_block", "_row", "_head", "_first", "_good")


def read_transactions(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Batch read of transaction CSV files (text columns, by name), in one scan. Rows of a file
    whose header differs from the schema carry ``_bad_header = true`` (quarantined by the
    cleanser): their values would be mapped to the wrong columns by position."""
    schema = schema or transaction_schema(spark, path)
    raw = spark.read.options(**_RAW_OPTS).schema(schema).csv(path)
    return resolved(spark, numbered(_with_file(raw, schema)))


def stream_transactions(spark: SparkSession, path: str, schema: T.StructType,
                        max_files_per_trigger: int = 1) -> DataFrame:
    """Unbounded transaction source: the file stream of a folder; ``maxFilesPerTrigger``
    is the back-pressure (bounded work per micro-batch). Headers are among its rows; see
    ``resolved``."""
    raw = (spark.readStream.options(**_RAW_OPTS)
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .schema(schema).csv(path))
    return _with_file(raw, schema)


def write_customer_master_csv(df: DataFrame, path: str) -> None:
    """Write customer master records in the source layout (index column first)."""
    inv = {v[0]: k for k, v in CUSTOMER_FIELDS.items()}
    cols = [F.monotonically_increasing_id().cast("string").alias("_c0")] + [
        F.col(c).cast("string").alias(inv[c]) for c in inv if c in df.columns]
    df.select(*cols).write.mode("overwrite").option("header", "true").csv(path)


def write_product_master_csv(df: DataFrame, path: str) -> None:
    inv = {v[0]: k for k, v in PRODUCT_FIELDS.items()}
    cols = [F.monotonically_increasing_id().cast("string").alias("_c0")] + [
        F.col(c).cast("string").alias(inv[c]) for c in inv if c in df.columns]
    df.select(*cols).write.mode("overwrite").option("header", "true").csv(path)


def write_transactions_csv(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite",
                           by: Sequence[str] = ()) -> None:
    """Transaction files in the source layout, gzipped (a file is read by one task); rows are dealt
    to ``files`` files in turn, or by the columns ``by``, which sorts nothing. Without ``files``
    each of the rows' tasks writes its own."""
    inv = {v: k for k, v in TRANSACTION_FIELDS.items()}
    cols = [F.col(c).alias(inv.get(c, c)) for c in df.columns]
    dealt = df if files is None else df.repartition(files, *by)
    dealt.select(*cols).write.mode(mode).option("header", "true").option("compression", "gzip").csv(path)
