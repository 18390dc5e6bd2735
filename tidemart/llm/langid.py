"""Language identification: averaged hashed subword embeddings, linear softmax, SGD.

A text's subwords are the byte n-grams (``SIZES``) within its words, the word's borders
included, of the lower-cased text; digits, punctuation and white space separate words. Each
is hashed to one of ``BUCKETS`` rows of an embedding; the mean row times a matrix gives the
logits of the languages. Embedding and matrix are trained together by stochastic gradient
descent in numpy. It starts on a bounded sample, balanced over the languages (about ``sample_rows``
of each, drawn by a hash of id and text, and fewer where they would hold over ``sample_bytes`` of
text in all): tasks count the n-grams of its whole texts, and only those counts reach the driver.
From there it goes on over *every* training row: rows are dealt by their hash to replicas of about
``replica_rows``, each descends from the common start in a task of its own, and their weights are
averaged, an n-gram's row over the replicas that met it (sums of integers, so the order in which
replicas end doesn't matter). Every language that a row has is learned, from all of its rows.

Scoring covers every byte of every text. Since the mean is linear, embedding times matrix
is stored as one fixed-point score per bucket and language, so a score doesn't depend on
how texts are batched. A text is *rejected* when it has no letter, when its calibrated
probability is below ``least``, or when too small a share of its n-grams (``least_known``) is
known, that is, at least one in ``KNOWN_OF`` of some language's texts has it (counted over all rows
that SGD sees, told by ``WIDE`` hashes). Temperature and limits come from all labelled rows that
SGD hasn't seen, which is every fifth by its hash, scored in tasks. Both limits are the quantile
``reject_share`` of the rightly predicted ones, the second is at least halfway from the median share
of these texts to that of the same texts with their letters shuffled (by the tasks, too), so no single
odd text sets it. In a short text the share counts as if ``PRIOR`` more n-grams were as usual. When
the limits stand, SGD goes over the held-out fifth, too.

Defined results: null or letterless text: ``und``, score 0, rejected; a text with letters
but no n-gram of a trained bucket gets the languages' prior and is rejected unless it is very
short; no training rows: ``und`` for all; repeated rows and null ids are scored like any row; a tie goes to the first language
in alphabetical order; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import by_crc, map_batches, mixed, position, row_sums, table, text_slabs, written

BUCKETS = 1 << 16
#: Hashes of n-grams that tell what was seen in training; a bucket is the low bits of one.
WIDE = 1 << 20
#: n-grams of the usual share of known ones that are added to each text's own.
PRIOR = 20
SIZES = (2, 3, 4)
#: Of a language's texts one in so many must have an n-gram for it to be known.
KNOWN_OF = 1200
#: Buckets, or hashes, of one row of what a replica hands on.
BLOCK, WIDE_BLOCK = 1 << 10, 1 << 14
#: Where the rows of n-gram counts begin, and the row of matrix and bias.
COUNTS, REST = 1 << 10, 1 << 9
#: Digits of shares and probabilities whose quantiles tasks count.
DIGITS = 5
FIXED = 1 << 20
UNKNOWN = "und"
#: Steps that one n-gram of a text counts as in training, at most.
STEPS = np.float32(4)
#: Texts that SGD starts on, those of a small sample again and again.
FIRST_STEPS = 4000
#: Bytes of text turned into n-grams at a time.
SLAB = 1 << 19

_LETTER = regex.compile(r"\p{L}")
# letters and bytes of longer UTF-8 characters stay, everything else separates words
_WORD = np.full(256, 32, np.uint8)
_WORD[97:123] = np.arange(97, 123)
_WORD[65:91] = np.arange(97, 123)
_WORD[128:] = np.arange(128, 256)
#: A fixed odd multiplier for each place within an n-gram.
_PLACE = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                 0xD6E8FEB86659FD93)]


def subwords_by_size(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row (ascending) and hash below WIDE of each subword of a slab, one n-gram size at a time."""
    # a separator after each text, and one before the first: no n-gram spans two texts
    clean = np.full(len(data) + len(offsets), 32, np.uint8)
    # a text's n-grams start at the separator before it or within it
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) + 1)
    if not len(row_of):
        return
    clean[np.arange(len(data)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) + 1] = _WORD[data]
    wide = clean.astype(np.uint64) + np.uint64(1)
    gap = clean == 32
    for size in SIZES:
        count = len(clean) - size + 1
        if count <= 0:
            continue
        within = ~(gap[:count] & gap[size - 1:size - 1 + count])
        for i in range(1, size - 1):
            within &= ~gap[i:i + count]
        at = np.flatnonzero(within)
        value = np.full(len(at), np.uint64(size))
        for i in range(size):
            value += wide[at + i] * _PLACE[i]
        yield row_of[at], (mixed(value) & np.uint64(WIDE - 1)).astype(np.int64)


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row (ascending within each n-gram size) and hash below WIDE of each subword of a slab."""
    found = list(subwords_by_size(data, offsets))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, hashes = zip(*found)
    return np.concatenate(rows), np.concatenate(hashes)


#: The distinct hashes of a text's n-grams, and how often it has each.
Bag = tuple[np.ndarray, np.ndarray]


def bags_of(texts: pa.Array) -> Iterator[Bag]:
    """The bag of each whole text; null: an empty one."""
    for a, z, data, offsets in text_slabs(texts, SLAB):
        rows, hashes = subwords(data, offsets)
        both, times = np.unique(rows * WIDE + hashes, return_counts=True)
        cuts, hashes = np.searchsorted(both, np.arange(z - a + 1) * WIDE), both & (WIDE - 1)
        for i in range(z - a):
            yield hashes[cuts[i]:cuts[i + 1]], times[cuts[i]:cuts[i + 1]]


@dataclass(frozen=True)
class Weights:
    embed: np.ndarray        # BUCKETS x width
    out: np.ndarray          # width x languages
    bias: np.ndarray

    def copy(self) -> Weights:
        return Weights(self.embed.copy(), self.out.copy(), self.bias.copy())

    def step(self, seen: np.ndarray, share: np.ndarray, label: int, eta: np.float32) -> None:
        """One text of SGD, in place: the buckets of its n-grams, their shares, its language."""
        rows = self.embed[seen]
        hidden = share @ rows
        p = softmax((hidden @ self.out + self.bias)[None, :])[0].astype(np.float32)
        p[label] -= 1
        back = self.out @ p
        self.out[:] -= eta * np.outer(hidden, p)
        self.bias[:] -= eta * np.float32(0.05) * p
        # a row's share of the mean is small: its gradient is scaled by the number of
        # rows, as if each n-gram were one step, but no n-gram counts as over STEPS
        self.embed[seen] = rows - (eta * np.minimum(len(seen) * share, STEPS))[:, None] * back[None, :]

    def scores(self) -> np.ndarray:
        return np.rint(np.clip(self.embed @ self.out, -2000, 2000).astype(np.float64) * FIXED).astype(np.int32)


def shares_of(bag: Bag) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's n-grams, and the share that each has of them."""
    grams, times = bag
    seen, place = np.unique(grams & (BUCKETS - 1), return_inverse=True)
    return seen, (np.bincount(place, times, len(seen)) / max(1, times.sum())).astype(np.float32)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    scores: np.ndarray       # BUCKETS x languages, fixed point
    bias: np.ndarray
    temperature: float
    least: float
    seen: np.ndarray | None = None   # WIDE: whether training had an n-gram of the hash
    usual: float = 1.0               # share of known n-grams in a usual text
    least_known: float = 0.0
    weights: Weights | None = None   # that the scores come from

    def logits_and_hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits before the temperature, known n-grams and n-grams of each text."""
        out = np.zeros((len(texts), self.scores.shape[1]))
        hits, counts = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        columns = np.ascontiguousarray(self.scores.T)
        for a, z, data, offsets in text_slabs(texts, SLAB):
            sums = np.zeros((z - a, len(columns)), np.int64)
            for rows, hashes in subwords_by_size(data, offsets):
                buckets = hashes & (BUCKETS - 1)
                counts[a:z] += np.bincount(rows, minlength=z - a)
                for k, column in enumerate(columns):
                    sums[:, k] += row_sums(column[buckets], rows, z - a)
                if self.seen is not None:
                    hits[a:z] += np.bincount(rows[self.seen[hashes]], minlength=z - a)
            out[a:z] = sums / FIXED / np.maximum(counts[a:z], 1)[:, None]
        return out + self.bias, counts if self.seen is None else hits, counts

    def logits_and_known(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Logits before the temperature, and the share of known n-grams of each text."""
        logits, hits, counts = self.logits_and_hits(texts)
        return logits, (hits + PRIOR * self.usual) / (counts + PRIOR)

    def of_bags(self, bags: list[Bag]) -> tuple[np.ndarray, np.ndarray]:
        """The same of texts whose n-grams are counted already."""
        out, known = np.zeros((len(bags), self.scores.shape[1])), np.zeros(len(bags))
        for i, (grams, times) in enumerate(bags):
            n = int(times.sum())
            out[i] = times @ self.scores[grams & (BUCKETS - 1)].astype(np.int64) / FIXED / max(1, n)
            hit = n if self.seen is None else int(times[self.seen[grams]].sum())
            known[i] = (hit + PRIOR * self.usual) / (n + PRIOR)
        return out + self.bias, known

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        return softmax(self.logits_and_known(texts)[0] / self.temperature)

    def judged(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities, and whether a text is like none that the model was made for."""
        logits, known = self.logits_and_known(texts)
        p = softmax(logits / self.temperature)
        return p, (p.max(axis=1) < self.least) | (known < self.least_known)


def softmax(logits: np.ndarray) -> np.ndarray:
    up = np.exp(logits - logits.max(axis=1, keepdims=True))
    return up / up.sum(axis=1, keepdims=True)


SAMPLED = ("mark long, lang string, held boolean, grams array<int>, times array<int>, "
           "noise_grams array<int>, noise_times array<int>")


def sampled(rows: DataFrame) -> DataFrame:
    """Every row (doc_id, text, lang) as a bag of its whole text. A fifth of the rows, told by
    their hash, is held out and also gives the bag of its letters in any order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            marks = batch.column(2).to_numpy()
            held = marks % 5 == 4
            texts = batch.column(0)
            noise = pa.array([shuffled(texts[i].as_py(), np.random.default_rng(int(marks[i]) & (2**63 - 1))) if held[i] else None
                              for i in range(len(batch))], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(1), pa.array(held), *lists(bags_of(texts)), *lists(bags_of(noise))],
                ["mark", "lang", "held", "grams", "times", "noise_grams", "noise_times"])

    return rows.select("text", "lang", F.xxhash64("doc_id", "text").alias("mark")).mapInArrow(run, SAMPLED)


def lists(bags: Iterator[Bag]) -> tuple[pa.Array, pa.Array]:
    """Bags as two columns of lists."""
    grams, times = zip(*bags)
    cuts = np.concatenate([[0], np.cumsum([len(x) for x in grams])]).astype(np.int32)
    return tuple(pa.ListArray.from_arrays(cuts, np.concatenate(x).astype(np.int32)) for x in (grams, times))


def fit(docs: DataFrame, sample_rows: int = 1500, sample_bytes: int = 32 << 20, width: int = 16,
        epochs: int = 4, rate: float = 0.25, reject_share: float = 0.0005, sample_total: int = 160_000,
        seed: int = 5, replica_rows: int = 4000) -> LanguageModel:
    """Train on all ``docs`` (doc_id, text, lang) with a text and a language. SGD starts on, of every
    language, the rows whose hash falls below the share that gives ``sample_rows`` of them, or fewer
    where all languages would give over ``sample_total`` rows or the language its part of
    ``sample_bytes``, and at least its smallest hash; at most twice as many in all. It goes on over
    every row but each fifth; all of those calibrate, and are then learned, too."""
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 30))
    rows = docs.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL").withColumn("draw", draw)
    held = F.pmod(F.xxhash64("doc_id", "text"), F.lit(5)) == 4  # as ``sampled`` tells
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)), F.min("draw"), F.sum(F.octet_length("text")),
                                      F.count_if(~held)).collect()  # a row a language
    if not counts:
        return LanguageModel((), np.zeros((BUCKETS, 0), np.int32), np.zeros(0), 1.0, 1.0)
    each = min(sample_rows, max(1, sample_total // len(counts)))
    cuts = [(lang, max(int(min(each / n, sample_bytes / len(counts) / max(1, size)) * (1 << 30)), first) + 1)
            for lang, n, first, size, _ in counts]
    # one row a language: small
    some = rows.join(F.broadcast(docs.sparkSession.createDataFrame(cuts, "lang string, cut long")), "lang")
    drawn = some.filter("draw < cut").dropDuplicates(["lang", "doc_id", "draw"]).limit(2 * each * len(cuts))
    sample = sampled(drawn).toArrow().sort_by([("mark", "ascending"), ("lang", "ascending")])
    langs = sorted(x[0] for x in counts)
    label = np.array([langs.index(x) for x in sample["lang"].to_pylist()])
    out = sample["held"].to_numpy()
    bags, noise = unpacked(sample["grams"], sample["times"]), unpacked(sample["noise_grams"], sample["noise_times"])
    passes = max(epochs, FIRST_STEPS // len(bags))
    model, own = trained(bags, label, out, [x for x, h in zip(noise, out) if h], tuple(langs), width, passes, rate, seed)
    n, taught = sum(x[1] for x in counts), [next(x[4] for x in counts if x[0] == lang) for lang in langs]
    if not sum(taught) or sum(taught) == n:  # few rows, all of one kind: the sample has them all
        return calibrated(model, own, None, reject_share)
    model = descended(rows.filter(~held), model, taught, rate / 2, replica_rows)
    others = scored(rows.filter(held), model)
    model, others = expecting(model, others)
    model = calibrated(model, None, others, reject_share)
    # the last rows change weights, not what is known or where the limits are
    return replace(descended(rows.filter(held), model, [x[1] - x[4] for x in sorted(counts)], rate / 8, replica_rows),
                   seen=model.seen, weights=None)


PARTS = "block int, lang int, places array<int>, numbers array<int>"


def descended(rows: DataFrame, model: LanguageModel, taught: list[int], rate: float, replica_rows: int) -> LanguageModel:
    """``model`` after one pass over all ``rows`` (doc_id, text, lang), ``taught`` of each language.
    A replica is a partition of the rows by their hash, in its order; repeats of a row count once."""
    spark, start = rows.sparkSession, model.weights
    place = {x: i for i, x in enumerate(model.languages)}
    n = -(-sum(taught) // replica_rows)
    per = max(1, sum(taught) // n)
    width = start.embed.shape[1]

    def replica(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, met, done, last = start.copy(), np.zeros(BUCKETS, bool), 0, None
        tally, heap, size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
        for batch in batches:
            labels, marks = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for bag, lang, mark in zip(bags_of(batch.column(0)), labels, marks):
                if (mark, lang) == last:
                    continue
                last, label = (mark, lang), place[lang]
                eta, done = np.float32(rate * max(0.05, 1 - done / per)), done + 1
                if not len(bag[0]):
                    continue
                seen, share = shares_of(bag)
                now.step(seen, share, label, eta)
                met[seen] = True
                heap.append(bag[0] + label * WIDE)
                size += len(bag[0])
                if size > WIDE:
                    tally, heap, size = added([tally, *((x, 1) for x in heap)]), [], 0
        if not done:
            return
        moved = [fixed(now.embed - start.embed), fixed(now.out - start.out), fixed(now.bias - start.bias)]
        yield part(REST, -1, [0], np.concatenate([moved[1].ravel(), moved[2]]))
        for first in range(0, BUCKETS, BLOCK):
            at = first + np.flatnonzero(met[first:first + BLOCK])
            if len(at):
                yield part(first // BLOCK, -1, at, moved[0][at].ravel())
        keys, times = added([tally, *((x, 1) for x in heap)])
        borders = np.flatnonzero(np.diff(keys // WIDE_BLOCK, prepend=-1))
        for a, z in zip(borders, [*borders[1:], len(keys)]):
            yield part(COUNTS + int(keys[a]) % WIDE // WIDE_BLOCK, int(keys[a]) // WIDE, keys[a:z] % WIDE, times[a:z])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row a block: what replicas moved and how many did, or the known hashes."""
        now, held = None, {}
        for block, lang, at, numbers in parts_of(batches):
            if block != now:
                yield from ended(now, held)
                now, held = block, {}
            if block >= COUNTS:
                held.setdefault(lang, np.zeros(WIDE_BLOCK, np.int64))[at % WIDE_BLOCK] += numbers
            else:
                if not held:
                    size = BLOCK if block < REST else 1
                    held[0], held[1] = np.zeros((size, len(numbers) // len(at)), np.int64), np.zeros(size, np.int64)
                held[0][at % BLOCK] += numbers.reshape(len(at), -1)
                held[1][at % BLOCK] += 1
        yield from ended(now, held)

    def ended(block: int | None, held: dict) -> Iterator[pa.RecordBatch]:
        if block is None:
            return
        if block < COUNTS:
            mean = np.rint(held[0] / np.maximum(1, held[1])[:, None]).astype(np.int64)
            yield part(block, -1, np.flatnonzero(held[1]), mean[held[1] > 0].ravel())
            return
        known = np.zeros(WIDE_BLOCK, bool)
        for lang, times in held.items():
            known |= (times > 0) & (times * KNOWN_OF >= taught[lang])
        yield part(block, -1, np.flatnonzero(known), np.zeros(0, np.int64))

    marked = rows.select("text", "lang", F.xxhash64("doc_id", "text").alias("mark"))
    moved = marked.repartition(n, "mark").sortWithinPartitions("mark", "lang").mapInArrow(replica, PARTS)
    found = moved.repartition("block").sortWithinPartitions("block").mapInArrow(together, PARTS)
    weights, seen = start.copy(), np.zeros(WIDE, bool)
    for block, _, at, numbers in parts_of(found.toArrow().to_batches()):  # the size of the model
        if block >= COUNTS:
            seen[(block - COUNTS) * WIDE_BLOCK + at] = True
        elif block == REST:
            change = (numbers / FIXED).astype(np.float32)
            weights.out[:] += change[:weights.out.size].reshape(weights.out.shape)
            weights.bias[:] += change[weights.out.size:]
        else:
            weights.embed[block * BLOCK + at] += (numbers / FIXED).astype(np.float32).reshape(-1, width)
    return replace(model, scores=weights.scores(), bias=weights.bias.astype(np.float64), seen=seen, weights=weights)


def fixed(x: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(x, -2000, 2000).astype(np.float64) * FIXED).astype(np.int64)


def added(tallies: list) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, and the sums of their numbers."""
    keys, place = np.unique(np.concatenate([k for k, _ in tallies]), return_inverse=True)
    numbers = np.concatenate([np.broadcast_to(v, len(k)) for k, v in tallies])
    return keys, np.bincount(place, numbers, len(keys)).astype(np.int64)


def part(block: int, lang: int, places: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
    listed = [pa.ListArray.from_arrays(np.array([0, len(x)], np.int32), pa.array(np.asarray(x, np.int32))) for x in (places, numbers)]
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([lang], pa.int32()), *listed],
                                      ["block", "lang", "places", "numbers"])


def parts_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for block, lang, places, numbers in zip(*(batch.column(i) for i in range(4))):
            yield block.as_py(), lang.as_py(), places.values.to_numpy(), numbers.values.to_numpy()


def unpacked(grams: pa.ChunkedArray, times: pa.ChunkedArray) -> list[Bag]:
    return [(g.values.to_numpy(), t.values.to_numpy()) for g, t in zip(grams, times)]


#: Temperatures to choose from.
HEATS = np.geomspace(0.05, 20, 60)


@dataclass(frozen=True)
class Scored:
    """Texts that SGD hasn't seen: logits, labels and shares of known n-grams."""
    logits: np.ndarray
    truth: np.ndarray
    known: np.ndarray

    def losses(self) -> np.ndarray:
        """Negative log likelihood of the labels at each of HEATS."""
        at = np.arange(len(self.truth))
        return np.array([-np.log(np.maximum(softmax(self.logits / t)[at, self.truth], 1e-12)).sum() for t in HEATS])

    def right(self, heat: float) -> tuple[np.ndarray, np.ndarray]:
        """Probability and share of known n-grams of the rightly predicted."""
        p = softmax(self.logits / heat)
        hit = p.argmax(axis=1) == self.truth
        return p.max(axis=1)[hit], self.known[hit]


def scored(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """truth, logits, known n-grams (hits) and n-grams of all ``rows`` (doc_id, text, lang), and the
    latter two of their letters in any order; repeats of a row count once."""
    place = {x: i for i, x in enumerate(model.languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = batch.column(0), batch.column(2).to_pylist()
            logits, hits, grams = model.logits_and_hits(texts)
            noise = pa.array([shuffled(x.as_py(), np.random.default_rng(m & (2**63 - 1))) for x, m in zip(texts, marks)], pa.string())
            _, noise_hits, noise_grams = model.logits_and_hits(noise)
            truth = pa.array([place[x] for x in batch.column(1).to_pylist()], pa.int32())
            cuts = np.arange(len(batch) + 1, dtype=np.int32) * logits.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), truth, pa.ListArray.from_arrays(cuts, logits.ravel()),
                 *map(pa.array, (hits, grams, noise_hits, noise_grams))],
                ["mark", "truth", "logits", "hits", "grams", "noise_hits", "noise_grams"])

    out = rows.select("text", "lang", F.xxhash64("doc_id", "text").alias("mark")).mapInArrow(
        run, "mark long, truth int, logits array<double>, hits long, grams long, noise_hits long, noise_grams long")
    return written(rows.sparkSession, out.dropDuplicates(["mark"]), "langid-calibration")


def expecting(model: LanguageModel, others: DataFrame) -> tuple[LanguageModel, DataFrame]:
    """``model`` with the usual share of known n-grams and its least limit, and the ``scored`` rows
    with their shares."""
    def share(hits: str, grams: str, usual: float) -> Column:
        return (F.col(hits) + F.lit(PRIOR * usual)) / (F.col(grams) + PRIOR)

    usual = quantile(others, share("hits", "grams", 1.0), 0.5)
    random = quantile(others, share("noise_hits", "noise_grams", usual), 0.5)
    return (replace(model, usual=usual, least_known=(usual + random) / 2),
            others.select("truth", "logits", share("hits", "grams", usual).alias("known")))


def quantile(rows: DataFrame, value: Column, at: float) -> float | None:
    """Of all rows, to DIGITS digits: the aggregate holds each value once."""
    return rows.agg(F.percentile(F.round(value, DIGITS), F.lit(at))).first()[0]


def calibrated(model: LanguageModel, own: Scored | None, others: DataFrame | None, reject_share: float,
               limit: int = 10_000) -> LanguageModel:
    """``model`` with the temperature and limits that ``own`` and ``others`` (truth, logits, known)
    give. Of the others only sums and quantiles reach the driver; ``own`` texts are at most
    ``limit`` where there are others."""
    def part(batch: pa.RecordBatch) -> Scored:
        logits = batch.column(1).flatten().to_numpy().reshape(len(batch), -1)
        return Scored(logits, batch.column(0).to_numpy(), batch.column(2).to_numpy())

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([pa.array(range(len(HEATS)), pa.int32()), pa.array(part(batch).losses())],
                                                 ["heat", "loss"])

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in part(batch).right(heat)], ["p", "known"])

    if others is not None:
        others = others.select("truth", "logits", "known")
        if own is not None:
            rows = [(int(t), x.tolist(), float(k)) for x, t, k in zip(own.logits[:limit], own.truth, own.known)]
            others = others.unionByName(others.sparkSession.createDataFrame(rows, others.schema))
        total = np.zeros(len(HEATS))
        for i, loss in others.mapInArrow(losses, "heat int, loss double").groupBy("heat").agg(F.sum("loss")).collect():
            total[i] = loss
        heat = float(HEATS[total.argmin()])
        good = others.mapInArrow(right, "p double, known double")
        least, least_known = (quantile(good, F.col(x), reject_share) for x in ("p", "known"))
        if least is None:
            return replace(model, temperature=heat)
    else:
        heat = float(HEATS[own.losses().argmin()])
        p, known = own.right(heat)
        if not len(p):
            return replace(model, temperature=heat)
        least, least_known = float(np.quantile(p, reject_share)), float(np.quantile(known, reject_share))
    # a model without texts held out has no least_known: nothing tells what new texts look like
    return replace(model, temperature=heat, least=least, least_known=max(least_known, model.least_known) if model.least_known else 0.0)


def shuffled(text: str | None, rng: np.random.Generator) -> str:
    """Words of the same lengths of the same letters, in any order."""
    letters = [x for x in text or "" if x.isalpha()]
    order = iter(rng.permutation(len(letters)).tolist())
    return "".join(letters[next(order)] if x.isalpha() else x for x in text or "")


def trained(bags: list[Bag], label: np.ndarray, held: np.ndarray, noise: list[Bag], langs: tuple[str, ...],
            width: int, epochs: int, rate: float, seed: int) -> tuple[LanguageModel, Scored]:
    """SGD over single texts, those ``held`` out left for the calibration; ``noise``: what is no
    language, the held out ones shuffled."""
    rng = np.random.default_rng(seed)
    use = np.flatnonzero(~held) if not held.all() else np.arange(len(bags))
    marks = np.zeros(WIDE, bool)
    shares = {}
    for i in use:
        marks[bags[i][0]] = True
        shares[i] = shares_of(bags[i])
    weights = Weights((rng.random((BUCKETS, width), np.float32) - 0.5) / width,
                      np.zeros((width, len(langs)), np.float32), np.zeros(len(langs), np.float32))
    steps, step = max(1, epochs * len(use)), 0
    for _ in range(epochs):
        for i in rng.permutation(use):
            seen, share = shares[i]
            eta = np.float32(rate * (1 - step / steps))
            step += 1
            if len(seen):
                weights.step(seen, share, label[i], eta)
    model = LanguageModel(langs, weights.scores(), weights.bias.astype(np.float64), 1.0, 0.0, marks, weights=weights)
    at = np.flatnonzero(held) if held.any() and not held.all() else use
    own = [bags[i] for i in at]
    logits, known = model.of_bags(own)
    if len(at) and len(at) < len(bags):
        usual = float(np.median(known))
        model = replace(model, usual=usual)
        logits, known = model.of_bags(own)
        model = replace(model, least_known=(usual + float(np.median(model.of_bags(noise)[1]))) / 2)
    return model, Scored(logits, label[at], known)


ADDED = "lang_pred string, score double, rejected boolean"


def predicted(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected; columns of these names are replaced."""
    at = position(docs, text, ADDED)
    names = np.array([*model.languages, UNKNOWN], dtype=object)

    def predict(batch: pa.RecordBatch) -> list:
        texts = batch.column(at)
        blank = np.array([x is None or not _LETTER.search(x) for x in texts.to_pylist()], bool)
        blank |= not model.languages
        best, score = np.full(len(blank), len(model.languages)), np.zeros(len(blank))
        strange = np.zeros(len(blank), bool)
        if model.languages:
            p, strange = model.judged(texts)
            best, score = p.argmax(axis=1), p.max(axis=1)
            best[blank], score[blank] = len(model.languages), 0.0
        return [*batch.columns, pa.array(names[best], pa.string()), pa.array(score),
                pa.array(blank | strange)]

    return map_batches(docs, predict, ADDED)


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` without the rejected rows, all columns as they are."""
    at = position(docs, "text")

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at)
        stays = np.array([x is not None and bool(_LETTER.search(x)) for x in texts.to_pylist()], bool)
        if model.languages:
            stays &= ~model.judged(texts)[1]
        return batch.filter(pa.array(stays, pa.bool_()))

    return map_batches(docs, keep)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on rows whose crc32(doc_id) mod 4 isn't 2, applied to all."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~by_crc("doc_id", 4, 2)))
    return predicted(docs.select("doc_id", by_crc("doc_id", 4, 2).alias("held_out"), "text"), model).drop("text")
