"""Near-duplicates by Jaccard similarity of word shingles, found with SetSketch registers.

Set of a text: lower-case A-Z, words ``[^\\x20\\x09-\\x0D]+``, distinct shingles of ``shingle`` words
(fewer words: the whole sequence as one; none: the empty set). Texts link when
100 * |A and B| >= percent * |A or B|; an empty set links with nothing. A component's id is the
smallest doc_id that links reach.

Sketch: each of ``REGISTERS`` registers gives every shingle an exponential value of rate
``RATE``, keeps the least of them and stores its place on an exponential scale,
floor(1 - log_b(least)), cut off at 0 and at 2**16 - 1. Such registers merge by maximum, and
two sets agree on one with a probability that is their similarity but for about b - 1.

Plan: equal sets become one class, so copies, however many, are one row from here on. Four
registers make a band and a 64-bit key; classes of one key are a bucket. First each class is
compared with one leader: that of its buckets' most central members it meets most often.
What these links join needs no further search. Then, in each bucket that still holds
several components, members of different ones are compared by their registers alone: the
counts of larger, smaller and equal registers and the sizes of both sets give a joint
likelihood, and a pair goes on unless it rules out the wanted similarity (likelihood ratio
above exp(25)). A bucket is dealt into chunks, and each pair of chunks is a group of its own;
a component that holds most of a bucket is never compared with itself. All links are
confirmed on full sets of 64-bit shingle hashes, which are made for classes with a partner
only: those with a leader in cells of bounded size, the others within their pair of chunks,
which yields a forest of its links and never its pairs.

Recall: 32 bands of 4 miss a pair at the limit of 0.85 with probability 5e-11, the likelihood
test with about as much; equal sets are never missed. A bucket whose members all lie just
below the limit costs comparisons of registers in the square of its classes: the answer
asks for each.

Defined results: null text: empty set. Repeated rows yield a row each. A null doc_id takes
part in links, but is a component's id only if no reachable id is non-null; ``kept`` is then
true for it. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import map_batches, mixed, position, table, text_slabs, token_hashes, written
from tidemart.llm.components import connected

REGISTERS = 128
BAND = 4
BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 1
#: Twice the logarithm of the likelihood ratio from which a similarity counts as ruled out.
RULED_OUT = 50.0
#: Bytes of sets on one side of a cell in which pairs are confirmed.
CELL_BYTES = 16 << 20

_RNG = np.random.default_rng(20240611)
_SEEDS = _RNG.integers(0, 1 << 64, REGISTERS, dtype=np.uint64)
_FACTORS = _RNG.integers(0, 1 << 64, REGISTERS, dtype=np.uint64) | np.uint64(1)
_PLACES = _RNG.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, np.uint8)
_WORD[[32, *range(9, 14)]] = 0


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and the texts' places in them."""
    rows = len(offsets) - 1
    starts, _, words = token_hashes(_LOWER[data], offsets, _WORD)
    row = np.searchsorted(offsets, starts, "right") - 1
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    n = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
    owner = np.repeat(np.arange(rows), n)
    begin = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    left = np.repeat(first + count, n) - begin  # words up to the text's end
    sums = np.minimum(left, shingle).astype(np.uint64)
    for j in range(shingle):
        there = j < left
        sums[there] += words[begin[there] + j] * _PLACES[j]
    hashes = mixed(sums)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(rows + 1))


def registers(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The registers (uint16) of each set; those of an empty set are 0."""
    full = np.flatnonzero(np.diff(places))
    out = np.zeros((len(places) - 1, REGISTERS), np.uint16)
    if not len(full):
        return out
    least = np.empty((len(full), REGISTERS), np.uint64)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat((hashes ^ _SEEDS[i]) * _FACTORS[i], places[:-1][full])
    # the least uniform value is that of the least exponential one
    value = -np.log1p(-(least.astype(np.float64) + 0.5) * 2.0 ** -64 * (1 - 2.0 ** -52)) / RATE
    out[full] = np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, TOP).astype(np.uint16)
    return out


def with_sketches(docs: DataFrame, shingle: int = 5, text: str = "text") -> DataFrame:
    """``docs`` with n (size of the set), cls (128-bit digest of the set, null if empty) and
    keys (the registers, a band in each number)."""
    added = "n long, cls binary, keys array<bigint>"
    at = position(docs, text, added)

    def sketch(batch: pa.RecordBatch) -> list:
        sizes, digests, keys = [], [], []
        for _, _, data, offsets in text_slabs(batch.column(at)):
            hashes, places = shingle_sets(data, offsets, shingle)
            cuts = places.tolist()
            whole = hashes.tobytes()
            sizes.append(np.diff(places))
            digests += [xxhash.xxh128_digest(whole[8 * a:8 * z]) if z > a else None
                        for a, z in zip(cuts[:-1], cuts[1:])]
            keys.append(registers(hashes, places).view(np.int64))
        flat = np.concatenate(keys) if keys else np.zeros((0, REGISTERS // BAND), np.int64)
        ends = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
        return [*batch.columns, pa.array(np.concatenate(sizes) if sizes else [], pa.int64()),
                pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))]

    return map_batches(docs, sketch, added)


def ruled_out(more: np.ndarray, less: np.ndarray, nu: np.ndarray, nv: np.ndarray, limit: float) -> np.ndarray:
    """Whether similarities of ``limit`` and above are ruled out by the joint likelihood of the
    numbers of registers that are larger in u, and larger in v, given both sets' sizes."""
    step = (BASE - 1) / BASE
    share = lambda x: -np.log1p(-np.maximum(x, 1e-15) * step) / np.log(BASE)
    u = nu / (nu + nv)
    top = np.minimum(limit, np.minimum(u, 1 - u) / np.maximum(u, 1 - u))

    def likelihood(j: np.ndarray, at) -> np.ndarray:
        p, q = share(u[at] - (1 - u[at]) * j), share(1 - u[at] - u[at] * j)
        return more[at] * np.log(p) + less[at] * np.log(q) + (REGISTERS - more - less)[at] * np.log(np.maximum(1 - p - q, 1e-15))

    every = slice(None)
    at_limit = likelihood(top, every)
    # the share of equal registers is nearly the best value: as likely a one settles most pairs
    out = 2 * (likelihood(np.minimum(1 - (more + less) / REGISTERS, top), every) - at_limit) > RULED_OUT
    # no value is likelier than the counts' own shares
    counts = np.stack([more, less, REGISTERS - more - less]).astype(float)
    most = (counts * np.log(np.maximum(counts, 1) / REGISTERS)).sum(axis=0)
    open_ = np.flatnonzero(~out & (2 * (most - at_limit) > RULED_OUT))
    # concave in j: the bracket of the best value shrinks
    low, high = np.zeros(len(open_)), top[open_]
    for _ in range(40 if len(open_) else 0):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        up = likelihood(a, open_) < likelihood(b, open_)
        low, high = np.where(up, a, low), np.where(up, high, b)
    out[open_] = 2 * (likelihood((low + high) / 2, open_) - at_limit[open_]) > RULED_OUT
    return out


def cross_pairs(left: np.ndarray, right: np.ndarray, roots: np.ndarray, regs: np.ndarray, sizes: np.ndarray,
                band: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places) of ``left`` and ``right`` members of different roots that may be similar
    enough and meet in no lower band. With the same places on both sides each pair once."""
    out = [np.zeros((0, 2), np.int64)]
    same = left is right
    for start in range(0, len(left), 64):
        some = left[start:start + 64]
        others = right[start + 1:] if same else right
        if not len(others):
            break
        apart = roots[some][:, None] != roots[others][None, :]
        a, b = sizes[some][:, None], sizes[others][None, :]
        apart &= np.minimum(a, b) * 100 >= percent * np.maximum(a, b)
        if same:
            apart &= np.arange(start + 1, len(right))[None, :] > np.arange(start, start + len(some))[:, None]
        x, y = np.nonzero(apart)
        for at in range(0, len(x), 1 << 16):
            p, q = some[x[at:at + (1 << 16)]], others[y[at:at + (1 << 16)]]
            more = (regs[p] > regs[q]).sum(axis=1)
            less = (regs[p] < regs[q]).sum(axis=1)
            near = ~ruled_out(more, less, sizes[p].astype(float), sizes[q].astype(float), percent / 100)
            p, q = p[near], q[near]
            # a pair is searched for in the first band that it agrees on
            agree = (regs[p] == regs[q]).reshape(len(p), REGISTERS // BAND, BAND).all(axis=2)
            here = agree.argmax(axis=1) == band
            out.append(np.stack([p[here], q[here]], axis=1))
    both = np.concatenate(out)
    return both[:, 0], both[:, 1]


def leaders(bands: DataFrame, buckets: DataFrame) -> DataFrame:
    """(x, y): each class with the leader it meets in the most buckets. A bucket's leader is
    its most central member: that whose buckets are the largest in sum."""
    spark = bands.sparkSession
    central = bands.join(buckets, ["band", "key"]).groupBy("c").agg(F.sum("members").alias("weight"))
    weighed = written(spark, bands.join(central, "c"), "setsketch-weighed")
    mark = F.struct("weight", F.xxhash64("c").alias("h"), "c")
    lead = weighed.join(buckets.select("band", "key"), ["band", "key"]).groupBy("band", "key") \
        .agg(F.max(mark).alias("lead")).select("band", "key", F.col("lead.c").alias("y"))
    lead = written(spark, lead, "setsketch-leaders")
    met = bands.join(lead, ["band", "key"]).filter("c <> y").groupBy("c", "y").agg(F.count(F.lit(1)).alias("times"))
    best = met.groupBy("c").agg(F.max(F.struct("times", "y")).alias("best"))
    return best.select(F.least("c", "best.y").alias("x"), F.greatest("c", "best.y").alias("y")).distinct()


def dealt(bands: DataFrame, roots: DataFrame, block: int) -> DataFrame:
    """The members (c, n, root) of buckets that hold several ``roots`` (c, root), dealt to pairs
    (i, j) of chunks of at most about ``block`` members and CELL_BYTES of sets."""
    spark = bands.sparkSession
    named = bands.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    named = written(spark, named, "setsketch-named")
    sizes = named.groupBy("band", "key", "root").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("size"))
    open_ = sizes.groupBy("band", "key").agg(F.max(F.struct("k", "size", "root")).alias("big"), F.sum("k").alias("k"),
                                             F.sum("size").alias("size"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    chunks = lambda k, size: F.ceil(F.greatest(k / block, size * 8 / CELL_BYTES)).cast("int")
    open_ = written(spark, open_.select(
        "band", "key", F.col("big.root").alias("big"),
        chunks(F.col("k") - F.col("big.k"), F.col("size") - F.col("big.size")).alias("small_chunks"),
        chunks(F.col("big.k"), F.col("big.size")).alias("big_chunks")), "setsketch-open")
    # chunks of the largest component are numbered -1, -2, ...; they never meet each other
    deal = F.xxhash64("c", "band")
    own = F.when(F.col("root") == F.col("big"), -1 - F.pmod(deal, F.col("big_chunks"))) \
        .otherwise(F.pmod(deal, F.col("small_chunks"))).cast("int")
    small = F.sequence(F.lit(0), F.col("small_chunks") - 1)
    big = F.transform(F.sequence(F.lit(1), F.col("big_chunks")), lambda i: -i)
    others = F.when(F.col("root") == F.col("big"), small).otherwise(F.concat(small, big))
    return (named.join(open_, ["band", "key"]).withColumn("own", own).withColumn("with", F.explode(others))
            .select("c", "n", "root", "band", "key", "own", F.greatest("own", "with").alias("i"),
                    F.least("own", "with").alias("j")))


def members_of(key: tuple, rows: pa.Table, percent: int) -> tuple:
    """c, root and the pairs of places that ``cross_pairs`` finds in a pair of chunks."""
    band, _, i, j = (k.as_py() for k in key)
    c, root, size = (rows[x].to_numpy() for x in ("c", "root", "n"))
    regs = rows["keys"].combine_chunks().flatten().to_numpy().reshape(len(c), -1).view(np.uint16)
    side = rows["own"].to_numpy()
    left = np.flatnonzero(side == i)
    right = left if i == j else np.flatnonzero(side == j)
    return c, root, *cross_pairs(left, right, root, regs, size, band, percent)


def joining(x: np.ndarray, y: np.ndarray, root: np.ndarray, flat: np.ndarray, places: np.ndarray,
            percent: int) -> list[tuple[int, int]]:
    """Those confirmed pairs of ``x`` and ``y`` (places) that join roots which no earlier one of
    them joined. The sets lie in ``flat``, from place to place."""
    above: dict[int, int] = {}

    def top(r: int) -> int:
        while r in above:
            r = above[r]
        return r

    out, sizes = [], np.diff(places)
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    cuts = np.flatnonzero(np.diff(x)) + 1
    for mine, others in zip(np.split(x, cuts), np.split(y, cuts)) if len(x) else ():
        p = int(mine[0])
        a = flat[places[p]:places[p + 1]]
        ahead = np.array([top(r) for r in root[others].tolist()])
        others = others[ahead != top(int(root[p]))]
        upto = np.cumsum(sizes[others])
        start = 0
        while start < len(others):  # sets of a bounded number of items at a time
            end = max(start + 1, int(np.searchsorted(upto, upto[start] - sizes[others[start]] + (1 << 20), "right")))
            some = others[start:end]
            items = np.concatenate([flat[places[q]:places[q + 1]] for q in some.tolist()])
            at = np.minimum(np.searchsorted(a, items), len(a) - 1)
            both = np.add.reduceat(a[at] == items, np.cumsum(sizes[some]) - sizes[some], dtype=np.int64)
            for q in some[100 * both >= percent * (len(a) + sizes[some] - both)].tolist():
                r, s = top(int(root[p])), top(int(root[q]))
                if r != s:
                    above[r] = s
                    out.append((p, q))
            start = end
    return out


def remaining(bands: DataFrame, roots: DataFrame, near: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """(x, y): links that join different ``roots`` in a bucket, as many as join all that any
    link in the same pair of chunks joins. Registers (``near``: c, keys) tell which members may
    have a partner at all; only those bring their ``sets`` (c, items)."""
    spark = bands.sparkSession
    near = near.select("c", "keys")

    def hopeful(key: tuple, rows: pa.Table) -> pa.Table:
        _, _, x, y = members_of(key, rows, percent)
        return rows.drop_columns(["keys"]).take(np.unique(np.concatenate([x, y])))

    def settle(key: tuple, rows: pa.Table) -> pa.Table:
        c, root, x, y = members_of(key, rows, percent)
        items = rows["items"].combine_chunks()
        places = np.frombuffer(items.buffers()[1], np.int32)[items.offset:items.offset + len(items) + 1].astype(np.int64)
        flat = np.frombuffer(items.buffers()[2], np.uint8)[places[0]:places[-1]].view(np.uint64)
        pairs = joining(x, y, root, flat, (places - places[0]) // 8, percent)
        xs, ys = zip(*pairs) if pairs else ((), ())
        ends = c[np.array(xs, np.int64)], c[np.array(ys, np.int64)]
        return pa.table({"x": np.minimum(*ends), "y": np.maximum(*ends)})

    keys = ["band", "key", "i", "j"]
    some = dealt(bands, roots, block).join(near, "c").groupBy(*keys).applyInArrow(
        hopeful, "c long, n long, root long, band int, key long, own int, i int, j int")
    some = written(spark, some, "setsketch-hopeful")
    return some.join(near, "c").join(sets.select("c", "items"), "c").groupBy(*keys).applyInArrow(settle, "x long, y long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (x, y) whose full sets (``sets``: c, n, items) are similar enough.
    Sets are dealt into blocks, and a cell holds the pairs of two blocks."""
    size = sets.agg(F.sum("n")).first()[0] or 0
    blocks = max(8, -(-8 * size // CELL_BYTES))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    pairs = pairs.withColumn("i", place("x")).withColumn("j", place("y"))
    wanted = pairs.select(F.col("i").alias("own_i"), F.col("j").alias("own_j"), F.explode(F.array("x", "y")).alias("c")) \
        .distinct().join(sets, "c")

    def check(some: pa.Table, members: pa.Table) -> pa.Table:
        items = {c: np.frombuffer(raw, np.uint64) for c, raw in
                 zip(members["c"].to_pylist(), (v.as_buffer() for v in members["items"].combine_chunks()))}
        keep = []
        for x, y in zip(some["x"].to_pylist(), some["y"].to_pylist()):
            a, b = items[x], items[y]
            if len(a) > len(b):
                a, b = b, a
            if 100 * len(a) < percent * len(b):
                continue
            both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            if 100 * both >= percent * (len(a) + len(b) - both):
                keep.append((x, y))
        xs, ys = zip(*keep) if keep else ((), ())
        return pa.table({"x": pa.array(xs, pa.int64()), "y": pa.array(ys, pa.int64())})

    return pairs.groupBy("i", "j").cogroup(wanted.groupBy("own_i", "own_j")).applyInArrow(check, "x long, y long")


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """c, n, items: the set of each class in ``wanted`` (c, mark), from one text of that mark."""
    texts = docs.select(F.sha2("text", 256).alias("mark"), "text").join(wanted, "mark") \
        .groupBy("c").agg(F.first("text").alias("text"))
    at = position(texts, "text", "n long, items binary")

    def make(batch: pa.RecordBatch) -> list:
        sizes, items = [], []
        for _, _, data, offsets in text_slabs(batch.column(at)):
            hashes, places = shingle_sets(data, offsets, shingle)
            whole, cuts = hashes.tobytes(), places.tolist()
            sizes += [z - a for a, z in zip(cuts[:-1], cuts[1:])]
            items += [whole[8 * a:8 * z] for a, z in zip(cuts[:-1], cuts[1:])]
        return [*batch.columns, pa.array(sizes, pa.int64()), pa.array(items, pa.binary())]

    return map_batches(texts, make, "n long, items binary").drop("text")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 85, block: int = 2048) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    marked = docs.withColumn("row", F.monotonically_increasing_id()).withColumn("mark", F.sha2("text", 256))
    marked = written(spark, with_sketches(marked, shingle).drop("text"), "setsketch-marked")
    classes = marked.filter("n > 0").groupBy("cls").agg(F.min("row").alias("c"), F.min("doc_id").alias("least"))
    classes = written(spark, classes, "setsketch-classes")
    sketches = marked.join(classes.select(F.col("c").alias("row")), "row").select(F.col("row").alias("c"), "n", "mark", "keys")
    bands = written(spark, sketches.select("c", "n", F.posexplode("keys").alias("band", "key")), "setsketch-bands")
    buckets = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    buckets = written(spark, buckets, "setsketch-buckets")
    # from here on only classes that share a bucket
    bands = written(spark, bands.join(buckets.select("band", "key"), ["band", "key"]), "setsketch-shared")
    near = written(spark, sketches.join(bands.select("c").distinct(), "c"), "setsketch-near")
    sets = written(spark, full_sets(docs, near.select("c", "mark"), shingle), "setsketch-sets")
    first = written(spark, confirmed(leaders(bands, buckets), sets, percent), "setsketch-links")
    roots = connected(first, "x", "y").withColumnRenamed("node", "c")
    rest = written(spark, remaining(bands, roots, near, sets, percent, block), "setsketch-rest")
    roots = connected(first.unionByName(rest), "x", "y").withColumnRenamed("node", "c")
    named = classes.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    lowest = written(spark, named.groupBy("root").agg(F.min("least").alias("component_id")), "setsketch-lowest")
    final = written(spark, named.join(lowest, "root").select("cls", "component_id"), "setsketch-final")
    alone = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (marked.join(final, "cls", "left").withColumn("component_id", alone)
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def op11_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=5, percent=85)
