import gzip
import hashlib
import io
import os
import random

from pyspark.sql import functions as F

from tidemart.llm import warc

PAGES = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES).withColumn("payload", F.lit(1)).withColumn("digest", F.lit("x"))


ROWS = [(5, "http://a/", "é" * 60), (3, "http://b/", "é" * 60), (9, None, "é" * 60), (3, "http://b/", "é" * 60),
        (1, "http://c/\r\nX: y", "small"), (2, "", "small"), (4, "u", None), (6, "u", ""), (7, "u", "x" * 300000),
        (None, "n", "é" * 60), (None, "n", "z" * 200), (None, "n", "z" * 200), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20)]


def brute(rows):
    out, first = [], {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 100 and page is not None:
            first[payload] = min(page, first.get(payload, page))
    for page, _, html in rows:
        payload = (html or "").encode()
        target = first.get(payload)
        refers = target if target is not None and target != page else None
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(),
                    "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_round_trip(spark):
    manifest = warc.write_archives(pages(spark, ROWS).repartition(3))
    back = warc.read_archives(manifest, split_bytes=700).collect()
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back]
    assert sorted(found, key=str) == brute(ROWS)
    assert all(r.digest_ok for r in back)
    for r in back:
        if r.record_type == "response":
            assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest
    assert {r.url for r in back if r.page_id == 1} == {"http://c/ X: y"}


def test_archives_are_plain_warc(spark):
    manifest = warc.write_archives(pages(spark, ROWS).coalesce(1)).collect()
    assert sum(m.records for m in manifest) == len(ROWS)
    path = manifest[0].path.removeprefix("file://").removeprefix("file:")
    assert os.path.getsize(path) == manifest[0].bytes
    whole = gzip.open(path).read()
    assert whole.count(b"WARC-Record-ID: <urn:page:") == len(ROWS)


def test_archives_of_other_attempts_are_not_read(spark):
    """What a lost attempt left in the folder is in no manifest."""
    manifest = warc.write_archives(pages(spark, ROWS[:4]).coalesce(1))
    path = manifest.first().path.removeprefix("file://").removeprefix("file:")
    with open(os.path.join(os.path.dirname(path), "0" * 32 + ".warc.gz"), "wb") as left:
        left.write(warc.record(77, "u", b"left over", hashlib.sha256(b"left over").hexdigest(), None))
    assert 77 not in {r.page_id for r in warc.read_archives(manifest).collect()}


def test_every_split_size_gives_every_record_once():
    rng = random.Random(3)
    data, starts = io.BytesIO(), []
    for i in range(40):
        starts.append(data.tell())
        payload = bytes(rng.randrange(256) for _ in range(rng.randrange(400))) + warc.MAGIC * rng.randrange(3)
        digest = hashlib.sha256(payload).hexdigest()
        data.write(warc.record(i, "u", payload, digest, None))
    size = data.tell()
    for split in (1, 7, 64, 500, 1000, size, 3 * size):
        found = [at for s in range(0, size, split) for at, _ in warc.members(data, s, s + split)]
        assert found == starts


def test_false_magic_and_cut_members_are_passed_over():
    good = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    other = gzip.compress(b"no record")
    data = io.BytesIO(warc.MAGIC + b"\x00junk" + other + warc.MAGIC + good + good[:-9])
    assert [c[:8] for _, c in warc.members(data, 0, 1 << 20)] == [b"WARC/1.1"]


def test_empty(spark):
    manifest = warc.write_archives(spark.createDataFrame([], PAGES))
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0
