"""Toxicity by a factorization machine over hashed terms.

Terms of a text: its words (lower-cased runs of letters) and their first 4, 5, 6 and 7 bytes,
which stand for stems; presence counts, not frequency, so an insult weighs as much in a
long text as in a short one. Terms are hashed to ``BUCKETS``; those whose presence depends
on the label (by the G statistic on the training rows, ``least_g`` at least, the
``max_terms`` strongest) enter the machine: a bias, a weight per term, and the inner product
of two terms' factors for each pair of terms present, so a pair can mean what neither term
means alone. It is trained in numpy (AdaGrad on the logistic loss) on a bounded sample of
labelled rows: the ``sample_rows`` toxic ones and ``clean_ratio`` times as many clean ones with
the smallest hashes of their ids, whole texts of any length. Tasks turn the sampled texts into
terms and count them; the driver gets the chosen terms and which rows have them, no text.
Scoring reads whole texts, never labels, lang, source or ids.

Defined results: a null or empty text (and one without a known term) scores the bias;
without labelled rows of both kinds every score is the share of toxic ones (0 if none is
labelled); repeated rows are scored each; null ids stay; conflicting labels of one id are
used as they stand; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import by_crc, map_batches, position, table, text_slabs, token_hashes, written

BUCKETS = 1 << 22
HEADS = (4, 5, 6, 7)
#: Counts that a task hands on at a time.
COUNTS = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, np.uint8)
_LETTER[[*range(97, 123), *range(128, 256)]] = 1


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each term of a slab; a head of n bytes counts for longer words only."""
    start, end, word, *heads = token_hashes(_LOWER[data], offsets, _LETTER, HEADS)
    row = np.searchsorted(offsets, start, "right") - 1
    rows, values = [row], [word]
    for n, head in zip(HEADS, heads):
        longer = end - start > n
        rows.append(row[longer])
        values.append(head[longer] + np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64)))
    return np.concatenate(rows), (np.concatenate(values) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass(frozen=True)
class Machine:
    buckets: np.ndarray   # of the chosen terms, ascending
    bias: float
    weights: np.ndarray
    factors: np.ndarray   # terms x width

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        if not len(self.buckets):
            return 1 / (1 + np.exp(-out))
        place = np.full(BUCKETS, -1, np.int32)
        place[self.buckets] = np.arange(len(self.buckets))
        for a, z, data, offsets in text_slabs(texts):
            rows, buckets = terms(data, offsets)
            known = place[buckets]
            hit = known >= 0
            pairs = np.unique(rows[hit] * len(self.buckets) + known[hit])
            rows, at = np.divmod(pairs, len(self.buckets))
            n = z - a
            total = np.zeros(n)
            total += np.bincount(rows, self.weights[at], n)
            for f in self.factors.T:
                total += (np.bincount(rows, f[at], n) ** 2 - np.bincount(rows, f[at] ** 2, n)) / 2
            out[a:z] += total
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def g_statistic(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """G of each term's presence against the label, from its document counts."""
    n = n_toxic + n_clean
    g = np.zeros(len(toxic))
    for seen, of in ((toxic, n_toxic), (clean, n_clean)):
        for x, share in ((seen, (toxic + clean) / n), (of - seen, 1 - (toxic + clean) / n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                g += np.where(x > 0, 2 * x * np.log(x / (of * share)), 0)
    return g


def row_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row (ascending) and bucket of each term of a column of texts, repeats within a row once."""
    rows, buckets = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for a, _, data, offsets in text_slabs(texts):
        r, b = terms(data, offsets)
        pairs = np.unique((r + a) * BUCKETS + b)
        rows.append((pairs // BUCKETS).astype(np.int32))
        buckets.append((pairs % BUCKETS).astype(np.int32))
    return np.concatenate(rows), np.concatenate(buckets)


LEAST_G, MAX_TERMS = 10.0, 2048


def train(texts: pa.Array, toxic: np.ndarray, least_g: float = LEAST_G, max_terms: int = MAX_TERMS, **params) -> Machine:
    row, bucket = row_terms(texts)
    counts = [np.bincount(bucket[toxic[row] == k], minlength=BUCKETS) for k in (1, 0)]
    seen = np.flatnonzero(counts[0] + counts[1])
    g = g_statistic(counts[0][seen], counts[1][seen], int(toxic.sum()), int(len(toxic) - toxic.sum()))
    best = np.argsort(-g, kind="stable")[:max_terms]
    chosen = np.sort(seen[best[g[best] >= least_g]])
    known = np.isin(bucket, chosen)
    return learn(chosen, row[known], bucket[known], toxic, **params)


def learn(chosen: np.ndarray, row: np.ndarray, bucket: np.ndarray, toxic: np.ndarray, width: int = 4,
          epochs: int = 60, rate: float = 0.3, decay: float = 1e-5, batch: int = 256, seed: int = 3) -> Machine:
    """The machine of the terms ``chosen`` (ascending); ``row`` (ascending) and ``bucket`` tell
    which rows of ``toxic`` have which of them."""
    n, none = len(toxic), np.zeros(0)
    share = (toxic.sum() if n else 0) / max(1, n)
    if not 0 < share < 1:
        return Machine(none.astype(np.int64), 30.0 if share else -30.0, none, np.zeros((0, width)))
    at = np.searchsorted(chosen, bucket)
    cuts = np.searchsorted(row, np.arange(n + 1))
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(chosen)), rng.normal(0, 0.01, (len(chosen), width))
    b = float(np.log(share / (1 - share)))
    sums = [np.full_like(w, 1e-3), np.full_like(v, 1e-3), 1e-3]
    for _ in range(epochs):
        order = rng.permutation(n)
        for start in range(0, n, batch):
            some = order[start:start + batch]
            x = np.zeros((len(some), len(chosen)))
            for i, doc in enumerate(some):
                x[i, at[cuts[doc]:cuts[doc + 1]]] = 1
            s = x @ v
            z = b + x @ w + (s ** 2 - x @ v ** 2).sum(axis=1) / 2
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic[some]) / len(some)
            back = x.T @ e
            for value, gradient, held in ((w, back + decay * w, 0),
                                          (v, x.T @ (e[:, None] * s) - v * back[:, None] + decay * v, 1)):
                sums[held] += gradient ** 2
                value -= rate * gradient / np.sqrt(sums[held])
            sums[2] += e.sum() ** 2
            b -= rate * e.sum() / np.sqrt(sums[2])
    return Machine(chosen, b, w, v)


def sampled_terms(docs: DataFrame, labels: DataFrame, sample_rows: int, clean_ratio: int, seed: int) -> DataFrame:
    """doc_id, toxic, mark (a hash of the text) and terms (buckets, ascending) of the sample."""
    def sample(toxic: int, rows: int) -> DataFrame:
        ids = labels.filter(F.col("toxic") == toxic).select("doc_id").distinct()
        return (ids.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(rows)
                .withColumn("toxic", F.lit(toxic)))

    # at most sample_rows * (1 + clean_ratio) ids: small by its parameters
    chosen = sample(1, sample_rows).unionByName(sample(0, sample_rows * clean_ratio))
    rows = docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    rows = rows.select("doc_id", "toxic", F.xxhash64("text").alias("mark"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, bucket = row_terms(batch.column(3))
            cuts = np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(cuts, bucket)],
                                             ["doc_id", "toxic", "mark", "terms"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.sparkSession, rows.mapInArrow(run, f"doc_id {kind}, toxic int, mark long, terms array<int>"),
                   "toxicity-terms")


def term_counts(rows: DataFrame) -> DataFrame:
    """bucket, n_toxic, n_clean: how many of the ``rows`` have the term, one vector a task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            toxic, lists = batch.column(0).to_numpy(), batch.column(1)
            bucket = lists.flatten().to_numpy()
            of = np.repeat(toxic, pc.list_value_length(lists).to_numpy())
            for k in (0, 1):
                total[k] += np.bincount(bucket[of == k], minlength=BUCKETS).astype(np.int32)
        seen = np.flatnonzero(total[0] + total[1])
        for some in np.array_split(seen, len(seen) // COUNTS + 1):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[1][some].astype(np.int64)),
                                              pa.array(total[0][some].astype(np.int64))], ["bucket", "n_toxic", "n_clean"])

    return (rows.select("toxic", "terms").mapInArrow(count, "bucket int, n_toxic long, n_clean long")
            .groupBy("bucket").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean")))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 3000, clean_ratio: int = 5, seed: int = 7,
        least_g: float = LEAST_G, max_terms: int = MAX_TERMS, **params) -> Machine:
    """Train on the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) has."""
    rows = sampled_terms(docs, labels, sample_rows, clean_ratio, seed)
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}

    def strong(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = g_statistic(batch.column(1).to_numpy(), batch.column(2).to_numpy(), n[1], n[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(g)], ["bucket", "g"]).filter(pa.array(g >= least_g))

    chosen = np.zeros(0, np.int64)
    if len(n) == 2:
        best = term_counts(rows).mapInArrow(strong, "bucket int, g double").orderBy(F.desc("g"), "bucket").limit(max_terms)
        chosen = np.sort(np.array([r["bucket"] for r in best.collect()], np.int64))

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            row = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy())
            bucket = lists.flatten().to_numpy()
            hit = np.isin(bucket, chosen)
            cuts = np.searchsorted(row[hit], np.arange(len(batch) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(cuts, bucket[hit])],
                                             ["doc_id", "toxic", "mark", "terms"])

    # twice as many rows as sampled ids (an id may repeat) reach the driver at most, each with
    # its chosen terms only
    have = (rows.mapInArrow(known, rows.schema).limit(2 * sample_rows * (1 + clean_ratio)).toArrow()
            .sort_by([("doc_id", "ascending"), ("toxic", "ascending"), ("mark", "ascending")]))
    lists = have["terms"].combine_chunks()
    row = np.repeat(np.arange(len(have)), pc.list_value_length(lists).to_numpy())
    return learn(chosen, row, lists.flatten().to_numpy(), have["toxic"].to_numpy().astype(np.int64), **params)


ADDED = "score double, predicted int"


def scored(docs: DataFrame, machine: Machine, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """``docs`` with score and predicted; columns of these names are replaced."""
    at = position(docs, text, ADDED)

    def run(batch: pa.RecordBatch) -> list:
        score = machine.scores(batch.column(at))
        return [*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))]

    return map_batches(docs, run, ADDED)


def op5_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from rows whose crc32(doc_id) mod 3 isn't 1, applied to all."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = fit(docs, labels.filter(~by_crc("doc_id", 3, 1)))
    return scored(docs.select("doc_id", by_crc("doc_id", 3, 1).alias("held_out"), "text"), machine).drop("text")
