"""WARC archives, index first.

Writing. Every page becomes one record, its own gzip member, appended to the
archive of its task; payloads that were stored already become revisit records.
While it writes, a task lists each record's offset, length, URL and digest.
That list is the index, a table beside the archives, and the only thing that a
reader needs to plan its reads. An attempt writes files under a name of its own and
the index names only files of attempts that ended well, so a lost executor
leaves no half-written archive in the index.

Reading. The selected index rows are dealt out by file and stretch of the file,
sorted by offset, and neighbouring byte ranges are merged into one read (up to
READ_BYTES, bridging gaps of at most GAP_BYTES). Each record is unpacked and
parsed from its own bytes and its digest is checked.

Archives go to the shared checkpoint folder through the file system its path
names. Payload hashes decide duplicates: SHA-256 groups them, SHA-1 is the
digest the standard asks for.

Defined cases: NULL html is an empty payload; a NULL URL is left out of the
record; of records with equal payloads of at least MINIMUM bytes those with the
greatest page_id are responses (more than one only if rows repeat that id) and
the others revisit it; a NULL page_id is less than any other. An empty table gives an empty
index. Only page_id, url and html are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdcast.llm.common import prepare, stash
from holdcast.session import checkpoint_dir

MINIMUM = 1000
FILE_BYTES = 256 << 20      # an archive is closed beyond this
READ_BYTES = 4 << 20        # of one merged read
GAP_BYTES = 64 << 10        # unread bytes that a merged read may bridge
STRETCH = 8 << 20           # of a file that one task reads
MOST_TASKS = 20_000         # beyond these, a task reads several stretches, one after another
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
INDEX = ("file string, offset bigint, length bigint, url string, digest string, "
         "page_id bigint, record_type string, refers_to bigint")


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'page {page_id}'.encode()).hexdigest())}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[bytes, str]:
    """One record as a gzip member, and its payload digest; a revisit leaves the payload out."""
    digest = hashlib.sha1(payload).digest()
    block = HTTP if refers_to is not None else HTTP + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Date": DATE,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(digest).decode(),
        "X-Payload-Length": str(len(payload)),
    }
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="".join(map(chr, range(0x21, 0x7F))))
    if page_id is not None:
        head["X-Page-Id"] = str(page_id)
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _record_id(refers_to), "X-Refers-To-Page-Id": str(refers_to)}
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    pack = zlib.compressobj(level=3, wbits=31)
    return pack.compress(lines.encode() + block + b"\r\n\r\n") + pack.flush(), digest.hex()


def parse_record(data: bytes) -> dict:
    """Headers and payload of one gzip member; checks lengths and, of responses, the digest."""
    raw = zlib.decompress(data, wbits=31)
    top, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = top.decode().split("\r\n")
    head = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(head["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    payload = block.partition(b"\r\n\r\n")[2]
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:"))
    if head["WARC-Type"] == "response" and hashlib.sha1(payload).digest() != digest:
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
    number = lambda key: int(head[key]) if key in head else None
    return {"page_id": number("X-Page-Id"), "url": head.get("WARC-Target-URI"), "record_type": head["WARC-Type"],
            "payload": payload, "payload_bytes": number("X-Payload-Length"), "payload_digest": digest.hex(),
            "refers_to": number("X-Refers-To-Page-Id")}


def with_references(pages: DataFrame, minimum: int = MINIMUM) -> DataFrame:
    """page_id, url, payload, refers_to: NULL for what is stored in full."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("payload"), F.when(F.octet_length(html) >= minimum, F.unhex(F.sha2(html, 256))).alias("key"))
    # Written first, so that the join deals both sides and may split a frequent payload.
    several = stash(rows.filter("key is not null").groupBy(F.col("key").alias("__key")).agg(
        F.count("*").alias("n"), F.max("page_id").alias("stored")).filter("n > 1").select("__key", "stored"), "warc-several")
    return rows.join(several, F.col("key") == F.col("__key"), "left").select(
        "page_id", "url", "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("stored")), F.col("stored")).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write page_id, url, payload, refers_to to archives below ``folder``; returns the stored index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _place(folder)
        system.create_dir(root, recursive=True)
        out, name, offset = None, "", 0
        for batch in batches:
            index: list[tuple] = []
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is not None and offset >= FILE_BYTES:
                    out.close()
                    out = None
                if out is None:
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                data, digest = record_bytes(page_id, url, payload.encode(), refers_to)
                out.write(data)
                index.append((name, offset, len(data), url, digest, page_id,
                              "response" if refers_to is None else "revisit", refers_to))
                offset += len(data)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*index)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=[c.split()[0] for c in INDEX.split(", ")])
        if out is not None:
            out.close()

    return stash(rows.select("page_id", "url", "payload", "refers_to").mapInArrow(run, INDEX), "warc-index")


def merged_reads(places: list[tuple[str, int, int]], most: int = READ_BYTES,
                 gap: int = GAP_BYTES) -> Iterator[tuple[str, int, int, list[int]]]:
    """(file, begin, end, places) of sorted byte ranges merged into reads."""
    run: tuple[str, int, int, list[int]] | None = None
    for k, (file, offset, length) in enumerate(places):
        if run and run[0] == file and offset - run[2] <= gap and offset + length - run[1] <= most:
            run = (file, run[1], max(run[2], offset + length), [*run[3], k])
        else:
            if run:
                yield run
            run = (file, offset, offset + length, [k])
    if run:
        yield run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload of the selected index rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _place(folder)
        kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(),
                 "payload_digest": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
        name, source = None, None
        for batch in batches:
            places = list(zip(*(c.to_pylist() for c in batch.columns)))
            for file, begin, end, members in merged_reads(places):
                if file != name:
                    name, source = file, system.open_input_file(f"{root}/{file}")
                source.seek(begin)
                data = source.read(end - begin)
                found = [parse_record(data[o - begin:o - begin + n]) for _, o, n in (places[k] for k in members)]
                yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], k) for c, k in kinds.items()],
                                                 names=list(kinds))

    # Tasks are counted by the bytes to be read: the index is small, whatever the archives hold.
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = min(MOST_TASKS, max(1, -(-total // STRETCH)))
    stretch = F.floor(F.col("offset") / STRETCH)
    return (index.select("file", "offset", "length").repartition(tasks, F.col("file"), stretch)
            .sortWithinPartitions("file", "offset").mapInArrow(
                run, "page_id bigint, url string, record_type string, payload_bytes bigint, "
                     "payload_digest string, refers_to bigint, payload binary"))


def op2_warc(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, as read back from the archives."""
    spark = prepare(pages.sparkSession)
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    index = write_archives(with_references(pages), folder)
    return read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS stored FROM pages)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN strlen(body) >= 1000 AND page_id <> stored THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(body) >= 1000 AND page_id <> stored THEN stored END AS refers_to
FROM p"""
