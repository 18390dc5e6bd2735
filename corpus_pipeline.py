"""The corpus pipeline: importance resampling, language identification, SimHash near-dedup
and multi-length packing, each stage on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as
Parquet and read again as the next one's ``docs``. All but the last keep the columns of
``documents``; each stage's docstring says which rows it drops.

Defined results: null and empty texts carry no n-gram, so the first stage judges them by
their weight 0, and the second one rejects them (no letter). Rows of one id are kept or dropped
together by the first stage; the third keeps one row of each component, whatever the ids (a
null id is the last choice); a null id is an id like any other to the first two. Without labels the first stage keeps all, without languages
the second one keeps what has a letter. Columns beyond those of ``documents`` travel along,
whatever their names. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import langid, packing, resampling, simhash
from tidemart.llm.common import bounded_batches, by_crc, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that importance resampling toward good ones doesn't draw. A filter
    should keep clean documents, so the temperature is five times that of the operator, which
    leaves chance only to documents near the cut."""
    return resampling.keep_sampled(docs, table(spark, sf_dir, "labels"), temperature=50.0)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language the calibrated model rejects. It learns from the
    stage's own rows, without those held out by id."""
    bounded_batches(spark)
    return langid.keep_identified(docs, langid.fit(docs.filter(~by_crc("doc_id", 4, 2))))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops all rows of a near-duplicate component but one with the smallest id."""
    bounded_batches(spark)
    return simhash.keep_one(docs, shingle=4, distance=4)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of several context sizes."""
    bounded_batches(spark)
    return packing.packed(docs)


STAGES = [("quality_classifier", quality), ("language_id", language), ("simhash_near_dedup", near_dedup),
          ("packing", pack)]

#: Trained models and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
