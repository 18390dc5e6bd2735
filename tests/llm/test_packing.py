import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from fixtures import TEXTS, documents, empty
from tokenizers import Tokenizer

from tidemart.llm import packing, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def library(texts):
    t = Tokenizer.from_file(PATH)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_ids_equal_the_library():
    rng = random.Random(4)
    letters = "aAbB éßÄ́.,!%&'ts1İΣ \t\n\x1c你\U0001f600"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    special = ["<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "a", "É", "\u0301", "!", " ", "\n", "12"]
    texts += ["".join(rng.choice(special) for _ in range(rng.randrange(12))) for _ in range(300)]
    assert library(["hello <|endoftext|> world."]) == [[3306, 49407, 1002, 269]]
    assert [x.tolist() for x in tokens.encode(texts, PATH)] == library(texts)


def check(rows, want):
    """``want``: ids (end included) of each row by (doc_id, number of tokens)."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id, r.doc_tokens].append(r)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 2048
    assert sum(r.length for r in rows) == sum(map(len, want))
    crcs = sorted(zlib.crc32(np.array(x, "<u4").tobytes()) for x in want if len(x) <= 60)
    whole = sorted(r.ids_crc32 for r in rows if r.length == r.doc_tokens and r.length <= 60)
    assert [c for c in whole if c in crcs] == whole
    return sequences


def test_pieces_cover_every_id(spark):
    docs = documents(spark)
    want = [x + [1] for x in library([r.text for r in docs.collect()])]
    rows = packing.packed(docs.coalesce(1), with_ids=True).collect()
    check(rows, want)
    by_doc = defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        if r.doc_id not in (0, None):
            by_doc[r.doc_id].append(r)
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        assert [x for p in pieces for x in p.ids] == want[i]
        assert [p.start for p in pieces] == np.cumsum([0, *[p.length for p in pieces[:-1]]]).tolist()


def test_tiers_fill_and_steps_balance(spark):
    rng = random.Random(7)
    docs = spark.createDataFrame([(i, "word " * rng.choice([3, 90, 200, 400, 900, 1500, 3000])) for i in range(600)],
                                 "doc_id long, text string").coalesce(1)
    rows = packing.packed(docs, step_tokens=8192, window=100_000).collect()
    total, groups, tier = defaultdict(int), defaultdict(set), {}
    for r in rows:
        total[r.sequence_id] += r.length
        groups[r.step_group].add(r.sequence_id)
        tier[r.sequence_id] = r.tier
    assert sum(total[s] != tier[s] for s in total) <= 1
    assert len(set(tier.values())) >= 3
    for members in groups.values():
        assert len({tier[s] for s in members}) == 1
        assert sum(tier[s] for s in members) <= 8192


def test_step_groups_cost_alike():
    sequences = [(2048, [(2048, 0, 0, 0)])] * 4 + [(2048, [(64, 0, 0, 0)] * 32)] * 4
    groups = packing.step_groups(sequences, 4 * 2048)
    cost = defaultdict(int)
    for (_, pieces), g in zip(sequences, groups):
        cost[g] += sum(p[0] ** 2 for p in pieces)
    assert len(cost) == 2 and len(set(cost.values())) == 1


def test_empty(spark):
    assert packing.packed(empty(spark)).count() == 0


def test_the_query(spark):
    """op2 as it is registered, against the untouched library over the whole table."""
    got = packing.op2_packing(spark, "/root/testdata/sf0.001")
    types = dict(got.dtypes)
    for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"):
        assert types[name] == "bigint", name
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: ids + [1] for r, ids in zip(docs, library([r.text for r in docs]))}
    assert len(want) == len(docs)
    pieces = defaultdict(list)
    rows = got.collect()
    check(rows, list(want.values()))
    for r in rows:
        pieces[r.doc_id].append(r)
    assert pieces.keys() == want.keys()
    for i, some in pieces.items():
        at = 0
        for r in sorted(some, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want[i])
            assert r.ids_crc32 == zlib.crc32(np.array(want[i][at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want[i])
