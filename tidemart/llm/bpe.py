"""Byte-level BPE encoding and decoding by merge replay over a corpus of distinct words.

A worker collects the distinct words (matches of the pattern) of a slab of documents and
encodes them all at once: every symbol of every word is a position in flat arrays, and an
inverted index leads from a pair (named by the rank of the token it makes) to the positions
where it stands. The merges are applied in rank order; each is one array operation on all
its positions, and only the pairs with the touched neighbours are looked up anew and enter
the index. A document's ids are its words' ids in a row. Words are independent, so replaying
a slab's corpus gives each word the ids that replaying the whole collection's would; no
word or text is shuffled, and memory is bounded by the slab and ``REMEMBERED`` words.

Merging all positions of a pair at once equals merging them one by one unless a merge makes
a pair of the same or a lower rank. Words where that happens are encoded one by one.

Defined results: null text: empty, no ids (the digests are those of no bytes); repeated rows
yield a row each; null doc_ids stay; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tidemart.llm.common import map_batches, position, table, text_slabs

NONE = np.int32(2**31 - 1)
#: Encoded words that a worker keeps between slabs; beyond, it starts anew.
REMEMBERED = 400_000
#: Characters of a word that is kept, at most.
LONGEST = 64
SLAB = 8 << 20


class Merges:
    """Ranks of a vocabulary: ``tokens`` by id, and the rank of the token each pair makes."""

    def __init__(self, tokens: dict[bytes, int]):
        self.tokens = {i: t for t, i in tokens.items()}
        self.byte = np.array([tokens[bytes([b])] for b in range(256)], np.int32)
        keys, ranks = [], []
        for token, rank in tokens.items():
            for cut in range(1, len(token)):
                left, right = tokens.get(token[:cut]), tokens.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ranks.append(rank)
        order = np.argsort(np.array(keys, np.int64)) if keys else np.zeros(0, np.int64)
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = np.array(ranks, np.int32)[order]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes; NONE where there is none."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    with open(path, "rb") as lines:
        return Merges({base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())})


def replay(words: list[bytes], m: Merges) -> list[bytes]:
    """The ids of each word, as little-endian unsigned 32-bit integers."""
    if not words:
        return []
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    n = len(data)
    symbol = np.append(m.byte[data], np.int32(-1))
    following = np.arange(1, n + 2)
    following[ends[ends > 0] - 1] = n
    before = np.arange(-1, n)
    before[0] = n
    starts = np.concatenate([[0], ends[:-1]])
    before[starts[starts < n]] = n
    alive = np.ones(n, bool)
    pair = np.full(n + 1, NONE)  # rank of the pair that begins at a position
    inner = np.flatnonzero(following[:n] < n)
    pair[inner] = m.rank(symbol[inner], symbol[following[inner]])
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []
    odd: list[np.ndarray] = []

    def enter(at: np.ndarray, least: int) -> None:
        rank = pair[at]
        at, rank = at[rank != NONE], rank[rank != NONE]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.concatenate([[0], np.flatnonzero(rank[1:] != rank[:-1]) + 1, [len(rank)]])
        if rank[0] <= least:
            odd.append(at[rank <= least])
        for a, z, r in zip(cuts[:-1].tolist(), cuts[1:].tolist(), rank[cuts[:-1]].tolist()):
            if r not in index:
                index[r] = []
                heapq.heappush(heap, r)
            index[r].append(at[a:z])

    enter(inner, -1)
    while heap:
        rank = heapq.heappop(heap)
        entries = index.pop(rank)
        at = np.unique(entries[0] if len(entries) == 1 else np.concatenate(entries))
        at = at[pair[at] == rank]  # entries whose pair has changed since are dropped
        if not len(at):
            continue
        chained = following[at[:-1]] == at[1:]
        if chained.any():  # in a run such as a a a, every other one from the left
            first = np.concatenate([[True], ~chained])
            place = np.arange(len(at))
            place -= np.maximum.accumulate(np.where(first, place, 0))
            at = at[place % 2 == 0]
        right = following[at]
        after = following[right]
        beside = np.flatnonzero(after[:-1] == at[1:])
        if len(beside):  # one by one, the left merge would show this pair before the right one
            between = m.rank(np.full(len(beside), rank), symbol[at[beside + 1]])
            if between.min() <= rank:
                odd.append(at[beside[between <= rank]])
        symbol[at] = rank
        following[at] = after
        before[after] = at
        alive[right] = False
        pair[right] = NONE
        ahead = before[at]
        ahead = ahead[ahead < n]
        pair[at] = NONE
        touched = np.concatenate([at[after < n], ahead])
        pair[touched] = m.rank(symbol[touched], symbol[following[touched]])
        enter(touched, rank)
    ids = symbol[:n][alive].astype("<u4")
    cuts = np.concatenate([[0], np.cumsum(alive)])[np.concatenate([[0], ends])] * 4
    flat = ids.tobytes()
    out = [flat[a:z] for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    if odd:
        for w in np.unique(np.searchsorted(ends, np.concatenate(odd), "right")):
            out[w] = one_by_one(words[w], m)
    return out


def one_by_one(word: bytes, m: Merges) -> bytes:
    """The ids of a word, merging the leftmost pair of the lowest rank at a time."""
    symbols = m.byte[np.frombuffer(word, np.uint8)]
    while len(symbols) > 1:
        rank = m.rank(symbols[:-1], symbols[1:])
        at = int(np.argmin(rank))
        if rank[at] == NONE:
            break
        symbols = np.concatenate([symbols[:at], rank[at:at + 1], symbols[at + 2:]])
    return symbols.astype("<u4").tobytes()


_known: dict[tuple[str, str], dict[str, bytes]] = {}


def encode(texts: Iterable[str | None], path: str, pattern: str) -> list[bytes]:
    """The ids of each text, as little-endian unsigned 32-bit integers."""
    known, split = _known.setdefault((path, pattern), {}), regex.compile(pattern).findall
    words = [split(t) if t else [] for t in texts]
    found = [list(map(known.get, row)) for row in words]
    fresh = list({w for row, ids in zip(words, found) if None in ids for w, i in zip(row, ids) if i is None})
    new = dict(zip(fresh, replay([w.encode() for w in fresh], merges(path))))
    if len(known) + len(new) > REMEMBERED:
        known.clear()
    known.update((w, i) for w, i in new.items() if len(w) <= LONGEST)
    return [b"".join([new[w] if i is None else i for w, i in zip(row, ids)] if None in ids else ids)
            for row, ids in zip(words, found)]


def decode(ids: bytes, path: str) -> bytes:
    return b"".join(map(merges(path).tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


ADDED = "n_tokens long, ids array<int>, decoded binary"


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids and decoded (the bytes that the ids stand for)."""
    at = position(docs, text, ADDED)

    def run(batch: pa.RecordBatch) -> list:
        ids = all_ids(batch.column(at), path, pattern)
        return [*batch.columns, pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())),
                pa.array([decode(x, path) for x in ids], pa.binary())]

    return map_batches(docs, run, ADDED)


def all_ids(texts: pa.Array, path: str, pattern: str) -> list[bytes]:
    out: list[bytes] = []
    for a, z, _, _ in text_slabs(texts, SLAB):
        out += encode(texts.slice(a, z - a).to_pylist(), path, pattern)
    return out


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and the hex SHA-256 of the ids and of the decoded bytes; ids and
    bytes themselves stay in the task."""
    at = position(docs, text, DIGESTS)

    def run(batch: pa.RecordBatch) -> list:
        columns: tuple[list, list, list] = ([], [], [])
        texts = batch.column(at)
        for a, z, _, _ in text_slabs(texts, SLAB):
            for x in encode(texts.slice(a, z - a).to_pylist(), path, pattern):
                for column, value in zip(columns, (len(x) // 4, hashlib.sha256(x).hexdigest(),
                                                   hashlib.sha256(decode(x, path)).hexdigest())):
                    column.append(value)
        return [*batch.columns, pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                pa.array(columns[2], pa.string())]

    return map_batches(docs, run, DIGESTS)


def op4_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).drop("text")
