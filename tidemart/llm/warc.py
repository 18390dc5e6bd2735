"""WARC archives of pages: a writer that stores equal payloads once, a splittable reader.

Writer: every record is a gzip member of its own. Among records with equal payloads of at
least ``least_bytes`` bytes the one with the smallest page_id is a response, the others are
revisits that refer to it and hold no payload. Digests are computed where the pages lie;
only digests that occur again are kept as a table, which the pages are joined with. It is
written first, so the join has a plain exchange on either side and Spark can split a digest
that very many pages share. Each writing task puts one archive into the shared folder under
a name no other attempt uses, and reports it in a manifest that Spark commits: an archive
of a lost or repeated attempt is in no manifest and is never read.

Reader: a task gets byte ranges of archives, scans them for the gzip magic, takes a
candidate for a record only if its member decodes to a WARC header, and owns the records
that start inside its range, whose last may end beyond. A member is inflated as a stream.

Defined results: null html is an empty payload; a null or odd url is written as it is without
line breaks (null: no such line); rows that repeat the smallest page_id of a payload are all
responses; a null page_id is larger than any other and is written as ``none`` (a payload
that only such pages have is a response in all of them); an empty table gives no archive
and an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import table, written
from tidemart.session import scratch_path

MAGIC = b"\x1f\x8b\x08"
NAMESPACE = "urn:page:"
LEAST_BYTES = 100
#: Bytes of an archive that a reading task scans at a time.
SPLIT_BYTES = 8 << 20
CHUNK = 1 << 18
STEP = 1 << 14


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A gzip member with one record."""
    kind = "response" if refers_to is None else "revisit"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block += f"Content-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        block += payload
    named = "none" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{NAMESPACE}{named}>",
            "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{NAMESPACE}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + packer.flush()


def marked(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null: a response) of ``pages`` (page_id,
    url, html)."""
    spark = pages.sparkSession
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    shared = (rows.filter(F.octet_length("payload") >= least_bytes).groupBy(F.col("digest").alias("twin"))
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    shared = written(spark, shared, "warc-shared")
    joined = rows.join(shared, rows["digest"] == shared["twin"], "left")
    return joined.select("page_id", "url", "payload", "digest",
                         F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, least_bytes: int = LEAST_BYTES, folder: str | None = None) -> DataFrame:
    """Writes the records of ``pages`` below ``folder`` (by default a new folder of the
    cluster's shared one) and returns the manifest: path, bytes, records."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, records, path = None, 0, 0, f"{folder}/{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(5))):
                if out is None:
                    store, place = located(path)
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(place, compression=None)
                member = record(*(x.as_py() for x in row))
                out.write(member)
                size, records = size + len(member), records + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [records]})

    return written(spark, marked(pages, least_bytes).mapInArrow(write, "path string, bytes long, records long"),
                   "warc-manifest")


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path or URI, and the path within it."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def members(source, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member of a file that begins in [start, end) and
    holds a WARC record. Bytes that look like the magic but don't decode to a record's
    header are passed over."""
    source.seek(start)
    window, base, at = b"", start, start
    while True:
        found = window.find(MAGIC, at - base)
        if found < 0:  # a magic may straddle the window's end
            at = max(at, base + len(window) - len(MAGIC) + 1)
            window, base = window[at - base:], at
            more = source.read(CHUNK) if at < end else b""
            if not more:
                return
            window += more
            continue
        at = base + found
        if at >= end:
            return
        if found > CHUNK:
            window, base, found = window[found:], at, 0
        content, after, window = inflated(source, window, found)
        if content is None:
            at += 1
        else:
            yield at, content
            at = base + after


def inflated(source, window: bytes, begin: int) -> tuple[bytes | None, int, bytes]:
    """The member at ``begin`` of the window, its end there, and the window with what had to
    be read; None if it isn't a WARC record."""
    unpack, content, at = zlib.decompressobj(31), bytearray(), begin
    while not unpack.eof:
        if at >= len(window):
            more = source.read(CHUNK)
            if not more:
                return None, begin, window
            window += more
        piece = window[at:at + STEP]
        try:
            content += unpack.decompress(piece)
        except zlib.error:
            return None, begin, window
        at += len(piece)
        if not content.startswith(b"WARC/"[:len(content)]):
            return None, begin, window
    record_ = bytes(content)
    whole = record_.startswith(b"WARC/") and b"\r\n\r\n" in record_
    return (record_ if whole else None), at - len(unpack.unused_data), window


def parsed(content: bytes) -> tuple[dict[str, str], bytes]:
    """Header lines (names in lower case) and payload of a record with an HTTP response."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    header = {name.strip().lower(): value.strip() for name, _, value in lines}
    block = rest[:int(header.get("content-length", len(rest)))]
    http, _, payload = block.partition(b"\r\n\r\n")
    for line in http.decode("latin-1").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        header["http:" + name.strip().lower()] = value.strip()
    return header, payload


READ = ("path string, start long, page_id long, url string, record_type string, refers_to long, "
        "payload_bytes long, payload_digest string, payload binary, digest_ok boolean")


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True,
                  most_tasks: int = 100_000) -> DataFrame:
    """The records of the archives in ``manifest`` (path, bytes): READ. The payload of a
    revisit is null; its length and digest are those the record states."""
    ranges = manifest.select("path", F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)),
                                                          F.lit(split_bytes))).alias("start"))
    columns = [x.split(" ")[0] for x in READ.split(", ")]
    arrow = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    kinds = [arrow[x.split(" ")[1]] for x in READ.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, place = located(path)
                with store.open_input_file(place) as source:
                    rows, held = [], 0
                    for at, content in members(source, start, start + split_bytes):
                        rows.append((path, at, *described(content, payloads)))
                        held += len(content)
                        if held >= split_bytes:
                            yield batch_of(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], columns)

    # a range is a light row but much work: dealt out one by one, not merged by size
    return ranges.repartition(max(1, min(ranges.count(), most_tasks))).mapInArrow(read, READ)


def described(content: bytes, payloads: bool) -> tuple:
    header, payload = parsed(content)
    page = lambda name: int(x) if (x := header.get(name, "").strip("<>").removeprefix(NAMESPACE)).lstrip("-").isdigit() else None
    stated = header.get("warc-payload-digest", "").removeprefix("sha256:")
    revisit = header.get("warc-type") == "revisit"
    digest = stated if revisit else hashlib.sha256(payload).hexdigest()
    size = int(header.get("http:content-length", 0)) if revisit else len(payload)
    return (page("warc-record-id"), header.get("warc-target-uri"), header.get("warc-type"), page("warc-refers-to"),
            size, digest, payload if payloads and not revisit else None, digest == stated)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_archives(write_archives(table(spark, sf_dir, "pages")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The same in DuckDB's SQL.
OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
  CASE WHEN f.first IS NULL OR f.first = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first <> d.page_id THEN f.first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""
