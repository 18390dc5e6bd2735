import random
import re

import numpy as np
from fixtures import documents, empty
from pyspark.sql import functions as F

from tidemart.llm import setsketch
from tidemart.llm.common import table


def brute_set(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """{row: (n, component)} by place, every pair compared."""
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    out = []
    for i, (id_, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if find(k) == find(i) and rows[k][0] is not None]
        root = id_ if not sets[i] else min(ids, default=None)
        out.append((id_, len(sets[i]), root, id_ == root))
    return out


def found(df, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in
                   setsketch.near_duplicates(df, **options).collect()), key=str)


def variants(rng, n, words, edits):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"x{rng.randrange(5000)}"
        out.append(" ".join(copy))
    return out


def test_awkward_rows_against_brute_force(spark):
    docs = documents(spark)
    assert found(docs) == sorted(brute([(r.doc_id, r.text) for r in docs.collect()]), key=str)
    assert found(empty(spark)) == []
    nothing = spark.createDataFrame([(1, None), (2, ""), (None, " ")], "doc_id long, text string")
    assert found(nothing) == sorted([(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)], key=str)


def test_dense_groups_against_brute_force(spark):
    """Groups around the limit, over chunks far smaller than they are, ids in any order."""
    rng = random.Random(11)
    texts = variants(rng, 150, 150, 9) + variants(rng, 60, 400, 30) + variants(rng, 40, 30, 2)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"q{rng.randrange(9999)}" for _ in range(40)) for _ in range(60)]
    texts += [texts[3]] * 40 + [texts[3].upper(), "a b", "A  B", "a b c", None, ""]
    ids = rng.sample(range(10_000), len(texts) - 1) + [None]
    rows = list(zip(ids, texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = sorted(brute(rows), key=str)
    assert len({w[2] for w in want}) < len(rows) - 100
    for block in (16, 2048):
        assert found(df, block=block) == want


def test_the_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    df = setsketch.op11_setsketch(spark, sf)
    assert df.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def sketches(sets):
    places = np.cumsum([0] + [len(s) for s in sets])
    return setsketch.registers(np.concatenate([np.sort(s) for s in sets]), places)


def test_registers_merge_and_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(7)
    agree, wanted = [], []
    for shared, own in ((50, 50), (200, 30), (300, 5), (0, 100)):
        for _ in range(60):
            h = rng.integers(0, 1 << 64, shared + 2 * own, dtype=np.uint64)
            a, b = h[:shared + own], np.concatenate([h[:shared], h[shared + own:]])
            x, y, union = sketches([a, b, h])
            assert (np.maximum(x, y) == union).all()
            agree.append((x == y).mean())
            wanted.append(shared / (shared + 2 * own))
    error = np.array(agree) - np.array(wanted)
    assert abs(error.mean()) < 0.005 and np.abs(error).max() < 0.2


def test_the_likelihood_rules_out_what_is_far_and_nothing_near():
    rng = np.random.default_rng(8)
    size = np.full(4000, 500.0)
    for similarity, share in ((0.85, 0.0), (0.9, 0.0), (0.3, 1.0)):
        differ = rng.binomial(setsketch.REGISTERS, 1 - similarity, 4000)
        more = rng.binomial(differ, 0.5)
        assert setsketch.ruled_out(more, differ - more, size, size, 0.85).mean() == share
    # a contained set: no register of the smaller one can be the larger
    less = rng.binomial(setsketch.REGISTERS, 0.15, 4000)
    assert not setsketch.ruled_out(np.zeros(4000), less, size * 0.85, size, 0.85).any()


def test_other_columns_do_not_matter(spark):
    df = documents(spark).withColumn("n", F.lit("x")).withColumn("cls", F.lit(1)).withColumn("row", F.lit(2))
    assert found(df) == found(documents(spark, extra=False))
