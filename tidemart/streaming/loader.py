"""Near-real-time load: transaction files -> Structured Streaming -> star schema.

``readStream`` (file source, ``maxFilesPerTrigger`` as back-pressure) feeds a
``foreachBatch`` sink that runs the same batch loader as the offline job for every
micro-batch: classify + stage, new dimension members, facts, quarantine and the
quarterly pre-aggregate, written as an attempt and published in one step. A micro-batch is
written once to the shared folder, where it is read from as often as needed; files that the
warehouse's ledger knows are left out, so a restarted query, a new checkpoint, another
grouping into micro-batches or a batch load of the same folder never load a file twice.
Master data is re-read for every micro-batch, so new members are seen.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import load
from ..sources import masters

MasterFn = Callable[[], DataFrame]


def warehouse_batch(spark: SparkSession, root: str, customers: MasterFn, products: MasterFn,
                    suppliers: MasterFn | None = None, schema: T.StructType | None = None,
                    source: str = "stream", distincts: bool = False) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: one micro-batch -> one warehouse batch of its files that
    are not loaded yet (none if all are). Rows that carry no file are known by the number
    of the micro-batch alone."""

    def process(batch: DataFrame, batch_id: int) -> None:
        offset = str(batch_id)
        if "_path" in batch.columns:
            batch, offset = masters.resolved(spark, masters.numbered(batch)), None
        load.load_batch(spark, batch, customers(), products(), root,
                        suppliers=suppliers() if suppliers else None, micro_batch=True,
                        source=source, offset=offset, distincts=distincts)

    return process


def start(spark: SparkSession, source_dir: str, schema: T.StructType, root: str,
          checkpoint: str, customers: MasterFn, products: MasterFn,
          suppliers: MasterFn | None = None, max_files_per_trigger: int = 1,
          available_now: bool = True, processing_time: str | None = None, distincts: bool = False):
    """Start the streaming load; ``available_now`` drains what is there and stops,
    otherwise the query keeps running on a ``processing_time`` trigger."""
    stream = masters.stream_transactions(spark, source_dir, schema, max_files_per_trigger)
    # run counters, reported per micro-batch in StreamingQueryProgress.observedMetrics
    stream = stream.observe("transactions_in",
                            F.count(F.when(~F.col("_head"), 1)).alias("rows"),
                            F.count("_corrupt_record").alias("corrupt_rows"))
    writer = (stream.writeStream
              .foreachBatch(warehouse_batch(spark, root, customers, products, suppliers,
                                            schema, f"files:{source_dir.rstrip('/')}", distincts))
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
