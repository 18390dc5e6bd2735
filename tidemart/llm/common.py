"""Helpers shared by the training-data operators: scans, scratch tables, byte arrays of texts.

Conventions for every operator here: a null text counts as empty, null ids are ordinary
values, repeated rows are separate rows, and only the columns an operator names are read,
so extra columns (whatever their names) never reach its plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.session import scratch_path

#: Bytes of text that a Python worker turns into arrays at a time.
SLAB_BYTES = 1 << 20


#: Bytes of an Arrow batch that goes to a Python worker, and the setting for it.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Small Arrow batches for this session, unless its configuration sizes them: the
    default of 64 MiB is held several times over by the JVM and by each Python worker."""
    if not spark.sparkContext.getConf().contains(BATCH_SETTING):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: lineage ends there, and
    no executor's loss makes it be computed again."""
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_crc(column: str, modulus: int, remainder: int):
    """Whether crc32 of the id's decimal text leaves ``remainder`` (null id: no)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus
                      == remainder, F.lit(False))


def text_slabs(texts: pa.Array, limit: int = SLAB_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: (first row, end row, the bytes as
    uint8, offsets of the rows within them). Null: empty. A longer text is a slab itself."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(wide):
        return
    buffers = wide.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(wide):
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), len(wide))
        yield start, end, data[offsets[start]:offsets[end]], offsets[start:end + 1] - offsets[start]
        start = end


def token_hashes(data: np.ndarray, marks: np.ndarray, klass: np.ndarray,
                 heads: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Runs of bytes of one class (0: between runs) that don't cross a text's border.

    Returns start, end and a 64-bit polynomial hash of each run, and for each n in ``heads``
    the hash of its first n bytes (a shorter run: of all). ``marks``: offsets of the texts;
    ``klass``: a class for each of the 256 bytes."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, *[none.astype(np.uint64)] * (1 + len(heads))
    kind = klass[data]
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    inner = marks[(marks > 0) & (marks < len(data))]
    edge[inner] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(data))
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    upto = [ends, *(np.minimum(starts + n, ends) for n in heads)]
    return starts, ends, *(mixed((sums[e] - sums[starts]) * down[starts]) for e in upto)


_POWERS: list[np.ndarray] = []
_BASE = 0x9E3779B97F4A7C15


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)]))
                      for x in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit (uint64 to uint64)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of integer ``values`` by ascending row number."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    cuts = np.searchsorted(rows, np.arange(n + 1))
    return total[cuts[1:]] - total[cuts[:-1]]


def added_fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields if ddl else []


def map_batches(df: DataFrame, fn, added: str = "") -> DataFrame:
    """``mapInArrow`` over all columns of ``df`` plus those that ``fn`` adds, whatever the
    columns are called (an added name replaces an old one)."""
    new = added_fields(added)
    taken = {f.name.lower() for f in new}
    old = [f for f in df.schema.fields if f.name.lower() not in taken]
    plain = df.select([df[f"`{f.name}`"].alias(f"c{i}") for i, f in enumerate(old)])
    fields = [T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate([*old, *new])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            yield pa.RecordBatch.from_arrays(list(out.columns if isinstance(out, pa.RecordBatch) else out),
                                             [f"c{i}" for i in range(len(fields))])

    return plain.mapInArrow(run, T.StructType(fields)).toDF(*[f.name for f in [*old, *new]])


def position(df: DataFrame, name: str, added: str = "") -> int:
    """Where ``map_batches`` puts column ``name``."""
    taken = {f.name.lower() for f in added_fields(added)}
    return [c for c in df.columns if c.lower() not in taken].index(name)
