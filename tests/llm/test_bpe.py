import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken
from fixtures import TEXTS, documents, empty

from tidemart.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_tiktoken_and_decode_to_the_text():
    rng = random.Random(3)
    letters = "aaabcdeéß 012\n\t\r\x1c\x85\xa0 ​你\U0001f600\U0001f1e9'.,!%&tsrevmlld́"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(800)]
    texts += ["a" * 20001, "ab" * 3000, "\n" * 77, " an" + "an" * 9, "anananand anananan"]
    encoding = reference()
    for text, ids in zip(texts, bpe.encode(texts, PATH, PATTERN)):
        assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(text or "")
        assert bpe.decode(ids, PATH) == (text or "").encode()


def test_replay_equals_one_by_one_for_any_ranks():
    """Vocabularies in which merges don't come in rank order, too."""
    rng = random.Random(5)
    for trial in range(60):
        vocabulary = {bytes([b]): b for b in range(256)}
        made = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(25)}
        for token in made:
            vocabulary.setdefault(token, len(vocabulary))
        m = bpe.Merges(vocabulary)
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 25))) for _ in range(40)] + [b"", b"aaaa"]
        assert bpe.replay(words, m) == [bpe.one_by_one(w, m) for w in words], trial


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    bpe._known.clear()
    encoding = reference()
    for start in range(0, 400, 40):
        texts = [f"word{i} other{i * 7}" for i in range(start, start + 40)]
        for text, ids in zip(texts, bpe.encode(texts, PATH, PATTERN)):
            assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(text)
    assert len(bpe._known[PATH, PATTERN]) <= 200
    bpe._known.clear()


def test_digests_of_awkward_rows(spark):
    encoding = reference()
    docs = documents(spark)
    rows = bpe.digests(docs, PATH, PATTERN).collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = encoding.encode_ordinary(r.text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.digests(empty(spark), PATH, PATTERN).count() == 0


def test_encoded_returns_ids_and_bytes(spark):
    docs = documents(spark, ["ab cd", None, "é"], extra=False)
    encoding = reference()
    for r in bpe.encoded(docs, PATH, PATTERN).collect():
        assert r.ids == encoding.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode() and r.n_tokens == len(r.ids)
