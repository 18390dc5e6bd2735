import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from fixtures import TEXTS, documents, empty

from tidemart.llm import simhash
from tidemart.llm.components import connected


def brute_fingerprint(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, distance):
    """The smallest place that links reach, for each code."""
    parent = list(range(len(codes)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if bin(int(codes[i]) ^ int(codes[j])).count("1") <= distance:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(codes))]


def test_fingerprints_against_brute_force():
    rng = random.Random(1)
    texts = TEXTS[:-4] + TEXTS[-3:] + ["".join(rng.choice("ab \t\nÉZ") for _ in range(rng.randrange(80))) for _ in range(200)]
    found = simhash.fingerprints(pa.array(texts, pa.string()), 4)
    assert found.tolist() == [brute_fingerprint(t) for t in texts]


def near(rng, n, centers, flips):
    codes = []
    for _ in range(n):
        code = centers[rng.integers(len(centers))]
        for b in rng.choice(64, rng.integers(0, flips + 1), replace=False):
            code ^= np.uint64(1 << int(b))
        codes.append(code)
    return np.unique(np.array(codes, np.uint64))


def test_gray_index_finds_all_links():
    rng = np.random.default_rng(2)
    centers = rng.integers(0, 1 << 63, 30, dtype=np.uint64) * np.uint64(2)
    codes = np.concatenate([near(rng, 700, centers, 5), rng.integers(0, 1 << 63, 300, dtype=np.uint64)])
    index = simhash.GrayIndex(np.unique(codes))
    rank = simhash.gray_rank(index.codes)
    assert (np.diff(rank.astype(object)) > 0).all()
    found = {(q, n) for a, b in index.links(codes, 4) for q, n in zip(a.tolist(), b.tolist())}
    want = {(q, int(n)) for q, c in enumerate(codes) for n in np.flatnonzero(np.bitwise_count(index.codes ^ c) <= 4)}
    assert found == want


def test_components_with_hot_groups(spark):
    """Dense groups far over the block, so that pairs of chunks meet in tasks of their own."""
    rng = np.random.default_rng(3)
    centers = rng.integers(0, 1 << 62, 12, dtype=np.uint64)
    codes = np.concatenate([near(rng, 500, centers[:1], 6), near(rng, 200, centers, 4),
                            rng.integers(0, 1 << 62, 50, dtype=np.uint64), np.zeros(1, np.uint64)])
    codes = np.unique(codes)
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "simhash long")
    links = simhash.edges(df, 4, block=64)
    roots = {r.node: r.root for r in connected(links).collect()}
    want = brute_components(codes, 4)
    label = [roots.get(int(c), int(c)) for c in codes.view(np.int64)]
    groups = {}
    for got, expected in zip(label, want):
        assert groups.setdefault(expected, got) == got
    assert len(set(groups.values())) == len(groups)


def test_connected_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (7, 7), (2000, 2000)]
    edges += [(3, 2), (2, 3), (None, 4), (61, 1050)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == 1
    assert len({got[i] for i in [*range(1000, 1100), 61]}) == 1
    assert got[0] != got[1000] and got[2000] == 2000
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_awkward_rows(spark):
    docs = documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    text = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(i for i in text if i is not None)
    codes = [brute_fingerprint(text[i]) for i in ids]
    want = dict(zip(ids, [ids[p] for p in brute_components(codes, 4)]))
    for r in rows:
        assert r.fingerprint == f"{brute_fingerprint(text[r.doc_id]):016x}"
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
    assert {r.component_id for r in rows if r.doc_id in (2, 3, 4)} == {2}


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark)
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    stays = [r.doc_id for r in kept.collect()]
    assert {i for i in stays if i is not None} == {i for i, c in found.items() if i == c and i is not None}
    assert simhash.keep_one(empty(spark)).count() == 0
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_bands_cover_all_bits():
    for distance in (0, 2, 4, 7):
        assert [b for low, width in simhash.bands(distance) for b in range(low, low + width)] == list(range(64))


def test_one_row_stays_where_ids_repeat_or_are_null(spark):
    rng = random.Random(5)
    a, b, c, d = (" ".join(rng.choice(["ka", "lo", "mi", "tun", "ver", "os"]) + str(rng.randrange(99)) for _ in range(60))
                  for _ in range(4))
    rows = [(1, a)] * 4 + [(2, a)]            # one id many times, the smallest of its component
    rows += [(None, b)] * 3                   # copies without an id
    rows += [(5, a), (5, c)]                  # an id with two texts, one of them a copy
    rows += [(None, d), (9, d), (9, d)]       # a row with an id is preferred
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, a), (None, b), (5, c), (9, d)], key=str)
