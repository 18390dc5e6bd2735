"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprint: lower-case A-Z, words ``[^\\x20\\x09-\\x0D]+``, shingles of ``shingle`` words joined
by a space (repeats included; fewer words: the whole sequence; none: fingerprint zero),
XXH64 of each with seed 42; a bit is 1 if it is set in over half of the hashes. Texts link
when their fingerprints differ in at most ``distance`` bits; a component's id is the
smallest doc_id that links reach.

Plan: fingerprints are computed where the texts lie, and only (doc_id, fingerprint) rows go
on. Equal fingerprints become one row, so copies, however many, never meet as pairs. The 64
bits are cut into ``distance + 1`` bands; two linked fingerprints agree on one band at
least, so each band in turn is rotated to the front and its value is the top node of the
index (all its bits shared, no differences yet). Below it, the members are sorted by Gray
rank and runs of them are factored into nodes: a node holds the bits its members share and
that its parent doesn't hold yet. A search goes down level by level, adds up the
differences on these masked patterns and drops a node with all its members as soon as the
sum exceeds the distance. A band value with more than ``block`` members is dealt into
chunks by hash, and every pair of chunks is a task of its own, so no group, however large,
meets in one task. Each searched group yields a spanning forest of its links, never its
pairs; components then are contracted with joins (``components.py``).

Defined results: a null text has no words, thus fingerprint zero, linked like any other;
repeated rows yield a row each; a null doc_id takes part in links but is never a component's
id (null only if all reachable ids are); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import map_batches, position, table, text_slabs, written
from tidemart.llm.components import connected

SEED = 42
FANOUT = 16
#: Nodes that a search looks at at a time.
FRONTIER = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def fingerprints(texts: pa.Array, shingle: int) -> np.ndarray:
    """64-bit fingerprint of each text (uint64)."""
    out = np.zeros(len(texts), np.uint64)
    for a, z, data, offsets in text_slabs(texts, 1 << 20):
        space = _SPACE[data]
        after = np.ones(len(data), bool)  # whether a space or a text's border lies before
        after[1:] = space[:-1]
        after[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(after & ~space)
        if not len(starts):
            continue
        last = np.ones(len(data), bool)
        last[:-1] = space[1:]
        last[offsets[1:][np.diff(offsets) > 0] - 1] = True
        ends = np.flatnonzero(last & ~space) + 1
        # the words with one space after each: a shingle is a slice of this
        lengths = ends - starts + 1
        place = np.cumsum(lengths) - lengths
        flat = np.full(int(lengths.sum()), 32, np.uint8)
        kept = ~space
        flat[np.arange(int(kept.sum())) + np.repeat(np.arange(len(starts)), lengths - 1)] = _LOWER[data[kept]]
        row = np.searchsorted(offsets, starts, "right") - 1
        words = np.bincount(row, minlength=z - a)
        first = np.cumsum(words) - words
        n = np.where(words > 0, np.maximum(words - shingle + 1, 1), 0)
        begin = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        finish = np.minimum(begin + shingle, np.repeat(first + words, n)) - 1
        whole, digest = flat.tobytes(), xxhash.xxh64_intdigest
        hashes = np.array([digest(whole[x:y], SEED) for x, y in
                           zip(place[begin].tolist(), (place[finish] + lengths[finish] - 1).tolist())],
                          np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        full = np.flatnonzero(n)
        counts = np.add.reduceat(bits, (np.cumsum(n) - n)[full], axis=0, dtype=np.int64)
        more = np.packbits(counts * 2 > n[full][:, None], axis=1, bitorder="little")
        out[a + full] = more.view(np.uint64)[:, 0]
    return out


def with_fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text") -> DataFrame:
    """``docs`` with a column ``simhash`` (the 64 bits as a signed number)."""
    at = position(docs, text, "simhash long")
    return map_batches(docs, lambda batch: [*batch.columns, pa.array(fingerprints(batch.column(at), shingle).view(np.int64))],
                       "simhash long")


def bands(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each band: ``distance + 1`` of nearly equal widths."""
    edges = [round(64 * i / (distance + 1)) for i in range(distance + 2)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:])]


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Where each code stands in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Codes in Gray order under levels of masked patterns, FANOUT to one, top level first."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        ones, zeros = [self.codes], [~self.codes]
        while len(ones[-1]) > FANOUT:
            at = np.arange(0, len(ones[-1]), FANOUT)
            ones.append(np.bitwise_and.reduceat(ones[-1], at))
            zeros.append(np.bitwise_and.reduceat(zeros[-1], at))
        self.levels = []
        held = None
        for one, zero in zip(ones[::-1], zeros[::-1]):
            shared = one | zero
            own = shared if held is None else shared & ~np.repeat(held, FANOUT)[:len(shared)]
            self.levels.append((one, own))
            held = shared

    def links(self, queries: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, place in ``codes``) of all codes within ``distance``, in portions."""
        top = len(self.levels[0][0])
        step = max(1, FRONTIER // top)
        for start in range(0, len(queries), step):
            some = queries[start:start + step]
            q = np.repeat(np.arange(len(some), dtype=np.int32), top)
            work = [(0, q, np.tile(np.arange(top, dtype=np.int32), len(some)), np.zeros(len(q), np.uint8))]
            while work:
                level, q, node, sofar = work.pop()
                pattern, own = self.levels[level]
                sofar = sofar + np.bitwise_count((some[q] ^ pattern[node]) & own[node])
                near = sofar <= distance
                q, node, sofar = q[near], node[near], sofar[near]
                if level + 1 == len(self.levels):
                    if len(q):
                        yield q + start, node
                    continue
                # children are laid out for FRONTIER nodes at a time, however dense the group
                below = len(self.levels[level + 1][0])
                for at in range(0, len(q), FRONTIER // FANOUT):
                    part = slice(at, at + FRONTIER // FANOUT)
                    child = (node[part, None] * FANOUT + np.arange(FANOUT, dtype=np.int32)).ravel()
                    there = child < below
                    work.append((level + 1, np.repeat(q[part], FANOUT)[there], child[there],
                                 np.repeat(sofar[part], FANOUT)[there]))


def forest(left: np.ndarray, right: np.ndarray | None, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (code, smallest code of its component) that join just what the links within
    ``left`` (or between ``left`` and ``right``) join."""
    both = left if right is None else np.concatenate([left, right])
    codes = np.unique(both)
    parent = np.arange(len(codes))
    index = GrayIndex(np.unique(left if right is None else right))
    other = np.searchsorted(codes, index.codes)
    asked = np.unique(left)
    own = np.searchsorted(codes, asked)
    for q, node in index.links(asked, distance):
        parent = merged(parent, own[q], other[node])
    root = flat(parent)
    moved = np.flatnonzero(root != np.arange(len(codes)))
    return codes[moved], codes[root[moved]]


def flat(parent: np.ndarray) -> np.ndarray:
    while True:
        above = parent[parent]
        if (above == parent).all():
            return parent
        parent = above


def merged(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The forest of ``parent`` with the links x-y added; a root is its tree's smallest."""
    while True:
        parent = flat(parent)
        a, b = parent[x], parent[y]
        apart = a != b
        if not apart.any():
            return parent
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        parent = parent.copy()
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def edges(codes: DataFrame, distance: int = 4, block: int = 2048) -> DataFrame:
    """(a, b) between distinct fingerprints of ``codes`` (column ``simhash``): a spanning
    forest of the links of each searched group."""
    spark = codes.sparkSession
    cut = [F.struct(F.lit(i).alias("band"),
                    F.shiftrightunsigned("simhash", low).bitwiseAND(F.lit((1 << width) - 1).cast("long")).alias("value"))
           for i, (low, width) in enumerate(bands(distance))]
    banded = codes.select("simhash", F.explode(F.array(*cut)).alias("at")).select("simhash", "at.band", "at.value")
    counts = banded.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = written(spark, counts.withColumn("chunks", F.ceil(F.col("n") / block).cast("int")), "simhash-groups")
    # alone in its group: no partner there. The group sizes are joined as a plain table, so
    # Spark may broadcast it, or split a skewed side.
    sized = banded.join(groups.drop("n"), ["band", "value"])
    chunk = F.pmod(F.xxhash64("simhash", "band"), F.col("chunks")).cast("int")
    dealt = (sized.withColumn("own", chunk)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("simhash", "band", "value", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"),
                     F.col("own").alias("own")))

    def search(key: tuple, rows: pa.Table) -> pa.Table:
        band, value, i, j = (k.as_py() for k in key)
        # the band's own bits are the top node: all share them; they go to the front
        low = np.uint64(bands(distance)[band][0] + bands(distance)[band][1])
        turn = lambda x: x if low % np.uint64(64) == 0 else (x << (np.uint64(64) - low)) | (x >> low)
        back = lambda x: x if low % np.uint64(64) == 0 else (x >> (np.uint64(64) - low)) | (x << low)
        code = turn(rows["simhash"].to_numpy().view(np.uint64))
        own = rows["own"].to_numpy()
        a, b = forest(code, None, distance) if i == j else forest(code[own == i], code[own == j], distance)
        return pa.table({"a": back(a).view(np.int64), "b": back(b).view(np.int64)})

    return dealt.groupBy("band", "value", "i", "j").applyInArrow(search, "a long, b long").distinct()


def least_of_component(marked: DataFrame, value: Column, distance: int, block: int) -> DataFrame:
    """simhash, least: each fingerprint of ``marked`` with the smallest ``value`` of its component."""
    spark = marked.sparkSession
    codes = marked.groupBy("simhash").agg(F.min(value).alias("least"))
    codes = written(spark, codes, "simhash-distinct")
    linked = connected(written(spark, edges(codes, distance, block), "simhash-edges"))
    named = codes.join(linked.withColumnRenamed("node", "simhash"), "simhash", "left")
    named = named.withColumn("root", F.coalesce("root", "simhash"))
    least = named.groupBy("root").agg(F.min("least").alias("least"))
    # one row per fingerprint, written first: what joins it has plain exchanges on both
    # sides, so a fingerprint that very many documents share is split
    return written(spark, named.select("simhash", "root").join(least, "root").drop("root"), "simhash-named")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, block: int = 2048) -> DataFrame:
    """doc_id, fingerprint, simhash, component_id of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    marked = written(spark, with_fingerprints(docs.select("doc_id", "text"), shingle).drop("text"), "simhash-codes")
    final = least_of_component(marked, F.col("doc_id"), distance, block).withColumnRenamed("least", "component_id")
    return (marked.join(final, "simhash", "left")
            .withColumn("fingerprint", F.lower(F.lpad(F.hex("simhash"), 16, "0"))))


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4, block: int = 2048) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest doc_id (null: the
    last), of several rows of that id any one. The rows are written first, with a key of
    their own, as ids may repeat or be null."""
    spark = docs.sparkSession
    keyed = docs.select([docs[f"`{name}`"].alias(f"c{i}") for i, name in enumerate(docs.columns)])
    stored = written(spark, keyed.withColumn("row", F.monotonically_increasing_id()), "simhash-rows")
    doc_id, text = (f"c{docs.columns.index(name)}" for name in ("doc_id", "text"))
    texts = stored.select(F.col(doc_id).alias("doc_id"), "row", F.col(text).alias("text"))
    marked = written(spark, with_fingerprints(texts, shingle).drop("text"), "simhash-codes")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    final = least_of_component(marked, first, distance, block)
    gone = marked.join(final, "simhash").filter("row <> least.row").select("row")
    gone = written(spark, gone, "simhash-gone")
    return stored.join(gone, "row", "left_anti").drop("row").toDF(*docs.columns)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", "fingerprint", "component_id")
