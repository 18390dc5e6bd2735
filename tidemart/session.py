"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "tidemart") -> SparkSession:
    """Session for tests and the benchmark (local mode, UI off, AQE on)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cpus
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TIDEMART_DRIVER_MEMORY", "8g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Where nothing is configured, a session in local mode (one
    machine, as in tests) gets a private folder; on a cluster that would scatter files over
    its machines, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidemart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder (never machine-local
    on a cluster). Used for tables that a job writes and reads back."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidemart-work/{tag}-{uuid.uuid4().hex[:12]}"


def sized_conf(input_bytes: int, executor_cores_total: int,
               target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan settings sized from the data volume (apply to the session at
    submit time). Shuffle partitions aim at ``target_partition_bytes`` per task before AQE
    coalesces small ones; never fewer than two waves of the cluster's cores."""
    shuffle = max(2 * executor_cores_total, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 << 20)),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }


#: Rows of one task of an exchange, about.
TASK_ROWS = 1_000_000


@contextmanager
def sized_exchanges(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Within it, the session's exchanges have a task per ``TASK_ROWS`` of ``rows`` where its shuffle
    partitions would get more each (and sort more than fits in memory). Adaptive execution still
    coalesces and splits them, which a fixed ``repartition`` would prevent."""
    name = "spark.sql.shuffle.partitions"
    before, tasks = spark.conf.get(name), -(-(rows or 0) // TASK_ROWS)
    if tasks <= int(before):
        yield
        return
    spark.conf.set(name, str(tasks))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path`` in ``schema``; without rows if nothing was written."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def stored(spark: SparkSession, df: DataFrame, tag: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: a join then has a plain exchange
    on this side, which lets adaptive execution split a skewed key."""
    path = scratch_path(spark, tag)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch_path`` named (nothing else is ever removed)."""
    if "/tidemart-work/" not in path:
        raise ValueError(f"not a work folder: {path}")
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder (none if there is no such folder)."""
    files, hpath = _hadoop(spark, path)
    return [s.getPath().getName() for s in files.listStatus(hpath)] if files.exists(hpath) else []


def delete_below(spark: SparkSession, root: str, name: str) -> None:
    """Remove a folder of a warehouse, named by its path below ``root``."""
    if not name.strip("/") or ".." in name:
        raise ValueError(f"not a folder of the warehouse: {name}")
    files, hpath = _hadoop(spark, f"{root.rstrip('/')}/{name}")
    files.delete(hpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its (Hadoop) file system. A Spark Connect session has no
    file system of its own to ask: there the answer is yes, and reading tells."""
    jvm = getattr(getattr(spark, "sparkContext", None), "_jvm", None)
    if jvm is None:
        return True
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))
