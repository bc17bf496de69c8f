"""WARC archives: writing, a normaliser for monolithic gzip files, and reading through the offset index.

An archive is a row (archive_id, content): the bytes of one file of bounded size, so any store that Spark writes will
do; ``export`` puts them into files. ``write`` compresses a whole archive as one gzip stream. ``normalise`` inflates
that stream once from front to back, writes every record as a gzip member of its own, and makes the sidecar index (a
line per record: page_id, type, offset, length of the member). ``read`` opens members by the index alone.

Payloads are told apart by SHA-256 and length. Of equal payloads of at least ``least`` bytes the row with the largest
page_id is the response, the others are revisit records that carry its id, the payload's digest and length. Null html
is an empty payload. Rows without page_id revisit the group's response; where no row of a group has an id, and among
repeated rows of the largest id, all are responses. Empty tables give no archive. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.scratch import table

#: Bytes of records in an archive, before compression.
ARCHIVE = 8 << 20
#: Of deflate: the first level with lazy matching, much smaller than level 1 for little time.
LEVEL = 4
_STEP = 1 << 20


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url: str, payload: bytes, refers_to) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join((url or '').split())}", "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{_digest(payload)}", f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(record: bytes, end: int) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in record[:end].decode("utf-8", "replace").split("\r\n")[1:])}


def _archives(size: int):
    def run(batches):
        task, made, packer, parts, raw = TaskContext.get().partitionId(), 0, None, [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                if packer is None:
                    packer, parts, raw = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), [], 0
                record = _record(row[0], row[1], (row[2] or "").encode(), row[3])
                parts.append(packer.compress(record))
                raw += len(record)
                if raw >= size:
                    parts.append(packer.flush())
                    yield pa.RecordBatch.from_pydict({"archive_id": [f"{task:06d}-{made:06d}"], "content": pa.array([b"".join(parts)], pa.binary())})
                    made, packer = made + 1, None
        if packer is not None:
            parts.append(packer.flush())
            yield pa.RecordBatch.from_pydict({"archive_id": [f"{task:06d}-{made:06d}"], "content": pa.array([b"".join(parts)], pa.binary())})

    return run


def write(pages: DataFrame, least: int = 0, size: int = ARCHIVE) -> DataFrame:
    """Archives (archive_id, content), each one gzip stream."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    url = F.col("url") if "url" in pages.columns else F.lit("")
    base = pages.select("page_id", url.alias("url"), "html", F.unhex(F.sha2(payload.cast("binary"), 256)).alias("key"), F.octet_length(payload).alias("bytes"))
    light = base.select("page_id", "key", "bytes")
    last = light.where(F.col("bytes") >= least).groupBy("key", "bytes").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null")
    again = light.join(last, ["key", "bytes"]).where(~F.col("page_id").eqNullSafe(F.col("last"))).select(F.col("page_id").alias("again"), "key", F.col("last").alias("refers_to")).distinct()
    rows = base.join(again, (base.key == again.key) & base.page_id.eqNullSafe(again.again), "left").select("page_id", "url", "html", "refers_to")
    return rows.mapInArrow(_archives(size), "archive_id string, content binary")


def _records(content: bytes):
    """The records of a gzip stream (of any number of members), inflated once in steps."""
    inflate, held, data = zlib.decompressobj(31), bytearray(), content
    at = 0
    while True:
        end = held.find(b"\r\n\r\n")
        if end >= 0:
            size = end + 4 + int(_headers(bytes(held[:end]), end)["content-length"]) + 4
            if len(held) >= size:
                yield bytes(held[:size])
                del held[:size]
                continue
        if inflate.eof:
            data, at = inflate.unused_data + data[at:], 0
            if not data:
                return
            inflate = zlib.decompressobj(31)
        if at >= len(data):
            if held or not inflate.eof:
                raise ValueError("the archive ends inside a record")
            return
        held += inflate.decompress(data[at : at + _STEP])
        at += _STEP


def _normalise(batches):
    for batch in batches:
        for archive_id, content in zip(batch.column("archive_id").to_pylist(), batch.column("content").to_pylist(), strict=True):
            parts, index, at = [], [], 0
            for record in _records(content):
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(record) + packer.flush()
                head = _headers(record, record.index(b"\r\n\r\n"))
                index.append(f"{head['warc-record-id'][10:-1] or '-'} {head['warc-type']} {at} {len(member)}")
                parts.append(member)
                at += len(member)
            yield pa.RecordBatch.from_pydict({"archive_id": [archive_id], "content": pa.array([b"".join(parts)], pa.binary()), "index": ["\n".join(index)]})


def normalise(archives: DataFrame) -> DataFrame:
    """(archive_id, content, index): every record its own gzip member, and the sidecar index."""
    return archives.select("archive_id", "content").mapInArrow(_normalise, "archive_id string, content binary, index string")


def _read(batches):
    for batch in batches:
        for content, index in zip(batch.column("content").to_pylist(), batch.column("index").to_pylist(), strict=True):
            out = []
            for line in index.splitlines():
                _, kind, at, size = line.split(" ")
                record = zlib.decompress(content[int(at) : int(at) + int(size)], 31)
                end = record.index(b"\r\n\r\n")
                head = _headers(record, end)
                digest = head["warc-payload-digest"].partition(":")[2]
                payload = None
                if kind == "response":
                    body = record.index(b"\r\n\r\n", end + 4) + 4
                    payload = record[body:-4]
                    if _digest(payload) != digest or len(payload) != int(head["x-payload-length"]):
                        raise ValueError(f"damaged record {head['warc-record-id']}")
                own, ref = head["warc-record-id"][10:-1], head.get("warc-refers-to", "<urn:page:>")[10:-1]
                out.append({"page_id": int(own) if own else None, "payload_bytes": int(head["x-payload-length"]), "payload_digest": digest, "record_type": kind, "refers_to": int(ref) if ref else None, "payload": payload})
            yield pa.RecordBatch.from_pylist(out, schema=_READ)


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read(normal: DataFrame) -> DataFrame:
    """A row per record; ``payload`` is null for revisits."""
    return normal.select("content", "index").mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def export(normal: DataFrame, path: str) -> None:
    """Put archives and indexes into files of a folder that all executors mount."""

    def put(rows):
        os.makedirs(path, exist_ok=True)
        for r in rows:
            for name, data in ((f"{r.archive_id}.warc.gz", bytes(r.content)), (f"{r.archive_id}.idx", r["index"].encode())):
                with open(f"{path}/.{name}", "wb") as f:
                    f.write(data)
                os.replace(f"{path}/.{name}", f"{path}/{name}")

    normal.foreachPartition(put)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = table(write(spark.read.parquet(f"{sf_dir}/pages.parquet")), "monolithic")
    return read(table(normalise(archives), "normal")).drop("payload")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS last FROM p GROUP BY 1)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(list_transform(range(0, 5), lambda j: CAST(substr(CAST(CAST(unhex(sha1(h)) AS BIT) AS VARCHAR), CAST(5 * i + j + 1 AS BIGINT), 1) AS INT) * (16 >> j))) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM p JOIN g USING (h)
"""
