"""Importance resampling of documents toward a target text (hashed n-gram models).

Two bag-of-n-grams models are compared: one of the *target* (labelled good documents), one
of the *raw* collection (every document). A document's log importance weight is the mean
over its n-grams of ``log p_target - log p_raw``, times ``temperature``; adding
independent Gumbel noise and keeping the k largest sums draws k documents without
replacement in proportion to their weights (Gumbel top-k).

* n-grams: runs of letters, of digits and of punctuation (case kept) and their pairs,
  hashed to ``BUCKETS`` counts. The raw counts cover all documents; the target model is fit
  on a bounded sample of the labelled documents (``sample_rows`` of each label, the
  smallest hashes of their ids).
* k: how many documents score above the cut that best parts the good from the bad rows of
  the sample's other half (a lost good document weighs ``good_cost`` bad ones). Without
  labelled good rows all documents are kept; without bad ones the cut lies below all good.
* temperature: a mean of log ratios hardly depends on a text's length, so it is scaled. The higher
  the temperature, the nearer the draw is to a threshold, and the fewer documents carry the
  weights. 10 leaves an effective sample size ((sum of weights)^2 / sum of squares) of 7,867 of
  the 10,000 documents of sf0.1 (20: 5,026; 50: 12), while the median bad document there
  weighs e^-16 of the median good one.
* the noise is a function of the document's id, weights are fixed-point sums, so a task
  that runs again draws the same.

Defined results: a null or empty text has no n-gram and weight 0; repeated rows draw the
same noise and are kept or rejected together (so are documents with equal keys at the
cut); a null id is an id like any other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import map_batches, mixed, position, row_sums, table, text_slabs, token_hashes, written

BUCKETS = 1 << 16
FIXED = 1 << 16
KEY_FIXED = 1 << 20
KEY_RANGE = 1 << 31

_CLASS = np.zeros(256, np.uint8)
for _b in range(256):
    if _b >= 128 or chr(_b).isalpha():
        _CLASS[_b] = 1
    elif chr(_b).isdigit():
        _CLASS[_b] = 2
    elif 32 < _b < 127:
        _CLASS[_b] = 3


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row (ascending) and bucket of each n-gram of a slab of texts."""
    start, _, value = token_hashes(data, offsets, _CLASS)
    row = np.searchsorted(offsets, start, "right") - 1
    if len(row) < 2:
        return row, (value % np.uint64(BUCKETS)).astype(np.int64)
    same = row[1:] == row[:-1]
    pair = mixed(value[:-1] * np.uint64(3) + value[1:])[same]
    rows = np.concatenate([row, row[:-1][same]])
    buckets = (np.concatenate([value, pair]) % np.uint64(BUCKETS)).astype(np.int64)
    order = np.argsort(rows, kind="stable")
    return rows[order], buckets[order]


def bucket_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, n): counts of the hashed n-grams of all ``docs``, one vector a task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slabs(batch.column(0)):
                total += np.bincount(ngrams(data, offsets)[1], minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    return (docs.select(text).mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gumbel(ids: np.ndarray, seed: int) -> np.ndarray:
    """A standard Gumbel variable for each id, always the same."""
    bits = mixed(ids.astype(np.int64).view(np.uint64) * np.uint64(2) + np.uint64(2 * seed + 1))
    uniform = ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    return -np.log(-np.log(uniform))


@dataclass(frozen=True)
class Resampler:
    """What scoring needs: fixed-point log ratios by bucket, temperature, seed, cut."""
    ratios: np.ndarray
    temperature: float
    seed: int
    cut: float

    def means(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for a, z, data, offsets in text_slabs(texts):
            rows, buckets = ngrams(data, offsets)
            n = np.bincount(rows, minlength=z - a)
            out[a:z] = row_sums(self.ratios[buckets], rows, z - a) / FIXED / np.maximum(n, 1)
        return out

    def keys(self, ids: pa.Array, means: np.ndarray) -> np.ndarray:
        """Weight plus noise, as a fixed-point number from 0 to 2**32 - 1."""
        noise = gumbel(ids.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False), self.seed)
        raw = np.rint((means * self.temperature + noise) * KEY_FIXED)
        return np.clip(raw, -KEY_RANGE, KEY_RANGE - 1).astype(np.int64) + KEY_RANGE


def fit(docs: DataFrame, labels: DataFrame, temperature: float = 10.0, seed: int = 11,
        sample_rows: int = 8000, good_cost: float = 20.0, smoothing: float = 1.0) -> Resampler:
    """Both models and the cut. ``docs``: doc_id, text; ``labels``: doc_id, quality 0 or 1."""
    def sample(quality: int) -> DataFrame:
        ids = labels.filter(F.col("quality") == quality).select("doc_id").distinct()
        return ids.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample_rows)

    chosen = sample(1).withColumn("good", F.lit(1)).unionByName(sample(0).withColumn("good", F.lit(0)))
    # at most 2 * sample_rows ids: small by its parameter
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .withColumn("fits", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(2)) == 0))
    rows = written(docs.sparkSession, rows, "resample-fit")
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for counts, frame in ((raw, docs), (target, rows.filter("good = 1 AND fits"))):
        for bucket, n in bucket_counts(frame).collect():  # BUCKETS rows at most
            counts[bucket] = n
    if not target.sum():
        return Resampler(np.zeros(BUCKETS, np.int64), temperature, seed, -np.inf)
    log = [np.log((c + smoothing) / (c.sum() + smoothing * BUCKETS)) for c in (target, raw)]
    model = Resampler(np.rint((log[0] - log[1]) * FIXED).astype(np.int64), temperature, seed, 0.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(model.means(batch.column(0)))],
                                             ["good", "mean"])

    held = (rows.filter("NOT fits").select("text", "good")
            .mapInArrow(score, "good int, mean double").limit(4 * sample_rows).toPandas())
    return Resampler(model.ratios, temperature, seed,
                     best_cut(held["mean"].to_numpy(), held["good"].to_numpy(), good_cost))


def best_cut(means: np.ndarray, good: np.ndarray, good_cost: float) -> float:
    """The cut with the least cost of good rows below and bad rows above; ties: the
    lowest. Without good rows nothing is cut; without bad ones it lies below all."""
    if not (good == 1).any():
        return -np.inf
    if not (good == 0).any():
        return float(means.min() - 1.0)
    order = np.argsort(means, kind="stable")
    m, g = means[order], good[order]
    cost = np.concatenate([[0.0], np.cumsum(np.where(g == 1, good_cost, -1.0))])
    at = int(np.argmin(cost))
    if at == 0:
        return float(m[0] - 1.0)
    return float(m[-1] + 1.0 if at == len(m) else (m[at - 1] + m[at]) / 2)


def scored(docs: DataFrame, model: Resampler) -> DataFrame:
    """doc_id, n_features, log_weight, above (the cut), gumbel_key of every row."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            means = model.means(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(means * model.temperature), pa.array(means >= model.cut),
                 pa.array(model.keys(batch.column(0), means))],
                ["doc_id", "log_weight", "above", "gumbel_key"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        score, "doc_id long, log_weight double, above boolean, gumbel_key long")


def kth_largest(keys: DataFrame, k: int, column: str = "gumbel_key") -> int:
    """The k-th largest of a column of integers below 2**32, by counting its upper and
    then its lower 16 bits: 65,536 counts a pass reach the driver, never rows."""
    prefix, left = 0, k
    for shift in (16, 0):
        part = keys if shift else keys.filter(F.shiftright(column, 16) == prefix)
        counts = dict(part.groupBy((F.shiftright(column, shift) % 65536).alias("digit"))
                      .count().collect())
        for digit in sorted(counts, reverse=True):
            if counts[digit] >= left:
                break
            left -= counts[digit]
        prefix = (prefix << 16) | digit
    return prefix


def threshold(weights: DataFrame) -> int:
    """The least key that Gumbel top-k keeps, k being the rows above the cut."""
    k = weights.filter("above").count()
    return kth_largest(weights, k) if k else KEY_RANGE * 2


def resample(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """Weight, key and verdict of every document: doc_id, log_weight, gumbel_key, kept."""
    model = fit(docs, labels, **params)
    weights = written(docs.sparkSession, scored(docs, model), "resample-weights")
    return (weights.withColumn("kept", F.col("gumbel_key") >= threshold(weights)).drop("above"))


def effective_size(weights: DataFrame) -> float:
    """How many equally weighted rows are worth as much as the rows with these log weights."""
    top = weights.agg(F.max("log_weight")).first()[0]
    if top is None:
        return 0.0
    w = F.exp(F.col("log_weight") - top)
    total, squares = weights.agg(F.sum(w), F.sum(w * w)).first()
    return total * total / squares


def keep_sampled(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """``docs`` without the rejected rows, all columns as they are. Texts are scored again
    in the last pass rather than shuffled to join the verdicts."""
    model = fit(docs, labels, **params)
    least = threshold(written(docs.sparkSession, scored(docs, model).select("above", "gumbel_key"),
                              "resample-weights"))
    ids, texts = position(docs, "doc_id"), position(docs, "text")

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(model.keys(batch.column(ids), model.means(batch.column(texts))) >= least))

    return map_batches(docs, keep)


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
