"""tidemart: retail star-schema ETL and OLAP reports, expressed as Spark DataFrame plans.

Layout:
  functions/   column expressions (calendar, money, growth, casts)
  operators/   reusable DataFrame operators (top-k, period growth, spikes, basket pairs,
               rollup, half-year pivot, slice & dice, surrogate keys, dimension members,
               SCD2, quarantine, enrichment, data-quality checks)
  sources/     CSV master readers, transaction stream reader, test-table mapping, warehouse I/O
  plans/       the star abstraction, the twenty reports and the batch load
  streaming/   micro-batch loader (foreachBatch) and the maintained quarterly pre-aggregate
"""

__version__ = "0.1.0"
