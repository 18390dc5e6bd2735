"""Hierarchical packing of token sequences into several context sizes.

A document's ids (with an end id) are cut into full windows of the longest context first;
what remains is routed to the shortest tier that holds it. Tiers are packed from long to
short: a sequence starts with the longest piece of its tier, its gap takes the longest
shorter pieces that fit, and the last gap is closed by cutting the shortest piece that
doesn't; the rest of that piece goes on as a piece of its own. So every sequence is full,
but for one at the end of a task. Sequences of a tier are dealt to step groups of equal
token counts, dearest (by the sum of squared piece lengths, which is what attention costs)
first, to and fro, so that groups cost alike.

The work runs where the texts lie: no shuffle, a window of ``WINDOW`` ids at a time in
memory, the open remainder carried on to the next window. Ids of sequences and groups
hold the task's number in their upper bits; the same input split gives the same packing
when a task runs again.

Defined results: a null or empty text is the end id alone; repeated rows are packed each;
a null doc_id stays null; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import tokens
from tidemart.llm.common import table

TIERS = (256, 512, 1024, 2048)
END_ID = 1
#: Ids that a task packs at a time.
WINDOW = 2_000_000
#: Open pieces at which a window ends early.
PIECES = 20_000
#: Tokens of a step group.
STEP_TOKENS = 65_536
TEXTS = 256

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, tier int, step_group long")


@dataclass(frozen=True)
class Document:
    doc_id: int | None
    ids: np.ndarray


#: A piece: (length, running number, document's key, start within the document).
Piece = tuple[int, int, int, int]


def routed(length: int, tiers: tuple[int, ...]) -> tuple[list[tuple[int, int]], tuple[int, int]]:
    """(start, length) of the full windows of the longest tier and of the remainder
    (length 0: none)."""
    top = tiers[-1]
    full = [(s, top) for s in range(0, length - top + 1, top)]
    return full, (len(full) * top, length - len(full) * top)


class Packer:
    """Packs a task's pieces; ``pool`` holds those that no sequence has taken yet."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = tiers
        self.pool: list[Piece] = []
        self.full: list[tuple[int, list[Piece]]] = []
        self.made = 0

    def add(self, key: int, length: int) -> None:
        full, (start, rest) = routed(length, self.tiers)
        for at, size in full:
            self.made += 1
            self.full.append((self.tiers[-1], [(size, self.made, key, at)]))
        if rest:
            self.put(rest, key, start)

    def put(self, length: int, key: int, start: int) -> None:
        self.made += 1
        insort(self.pool, (length, self.made, key, start))

    def drain(self, last: bool = False) -> list[tuple[int, list[Piece]]]:
        """(tier, pieces) of the full sequences that the pool yields, long tiers first. An
        unfinished one goes back to the pool, or comes out as it is if ``last``."""
        out, self.full = self.full, []
        while self.pool:
            sequence = [self.pool.pop()]
            size = sequence[0][0]
            tier = next(t for t in self.tiers if t >= size)
            while size < tier and self.pool:
                at = bisect_right(self.pool, (tier - size, self.made + 1))
                if at:  # the longest that fits
                    piece = self.pool.pop(at - 1)
                else:   # the shortest that doesn't is cut
                    length, number, key, start = self.pool.pop(0)
                    piece = (tier - size, number, key, start)
                    self.put(length - piece[0], key, start + piece[0])
                sequence.append(piece)
                size += piece[0]
            if size < tier and not last:
                for length, _, key, start in sequence:
                    self.put(length, key, start)
                break
            out.append((tier, sequence))
        return out


def step_groups(sequences: list[tuple[int, list[Piece]]], step_tokens: int) -> list[int]:
    """A group number for each sequence: groups are of one tier, of equal size, and of
    about equal cost."""
    out, used = [0] * len(sequences), 0
    for tier in sorted({t for t, _ in sequences}):
        mine = [i for i, (t, _) in enumerate(sequences) if t == tier]
        groups = -(-len(mine) * tier // step_tokens)
        dear = sorted(mine, key=lambda i: (-sum(p[0] ** 2 for p in sequences[i][1]), i))
        for n, i in enumerate(dear):
            lap, place = divmod(n, groups)
            out[i] = used + (place if lap % 2 == 0 else groups - 1 - place)
        used += groups
    return out


def packed(docs: DataFrame, path: str | None = None, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID,
           step_tokens: int = STEP_TOKENS, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """A row per piece of ``docs`` (doc_id, text): SCHEMA, and ``ids`` (array of int) if
    ``with_ids``. ``path``: the tokenizer's file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        packer, held, keys, sequences, groups, waiting = Packer(tiers), {}, 0, number, number, 0

        def flush(last: bool) -> pa.RecordBatch | None:
            nonlocal sequences, groups, held
            done = packer.drain(last)
            rows: dict[str, list] = {name: [] for name in names}
            for (tier, pieces), group in zip(done, step_groups(done, step_tokens)):
                place = 0
                for length, _, key, start in pieces:
                    doc = held[key]
                    ids = doc.ids[start:start + length]
                    values = (doc.doc_id, start, length, zlib.crc32(ids.tobytes()), len(doc.ids), sequences, place,
                              tier, groups + group) + ((ids.astype(np.int32),) if with_ids else ())
                    for name, value in zip(names, values):
                        rows[name].append(value)
                    place += length
                sequences += 1
            groups = max(rows["step_group"], default=groups - 1) + 1
            open_keys = {p[2] for p in packer.pool}
            held = {k: d for k, d in held.items() if k in open_keys}
            return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            for at in range(0, len(batch), TEXTS):
                some = batch.slice(at, TEXTS)
                for doc_id, ids in zip(some.column(0).to_pylist(), tokens.encode(some.column(1).to_pylist(), path, end_id)):
                    held[keys] = Document(doc_id, ids)
                    packer.add(keys, len(ids))
                    keys, waiting = keys + 1, waiting + len(ids)
                    if waiting >= window or len(packer.pool) >= PIECES:
                        yield flush(False)
                        waiting = 0
        yield flush(True)

    spec = [x.split(" ") for x in SCHEMA.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32()}
    arrow = pa.schema([pa.field(n, types[t]) for n, t in spec] + ([pa.field("ids", pa.list_(pa.int32()))] if with_ids else []))
    names = arrow.names
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        pack, SCHEMA + (", ids array<int>" if with_ids else ""))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
