"""WARC archives through a chunked record table: no record of an archive is longer than a chunk.

A payload is written as rows of (record, chunk number, bytes, digest of the payload so far); a payload of more than
one chunk becomes a segmented record (a response and continuations, as the format has them). Reading streams the
rows of a record in order and carries the digest on, so neither side holds a whole record besides its own cell.

Files are plain WARC text of Spark's text sink, compressed: a record ends in two line breaks, which are the sink's
line separator, and the next begins with the version line. Payload bytes never hold the version line whole, as
chunks also end in the middle of it; so the reader splits at records and nowhere else.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstats.llm.common import map_rows

CHUNK = 1 << 16
#: Rows are handed back to Spark when they hold so many bytes.
FLUSH = 4 << 20
DATE = "2024-01-01T00:00:00Z"

_END = b"\r\n\r\n"
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BLANK = re.compile(r"[\x00-\x20\x7f]")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunks(payload: bytes, size: int) -> Iterator[tuple[int, int]]:
    """Places of the chunks: at most ``size`` bytes, none with the version line in it; one for an empty payload."""
    at = 0
    while True:
        end = min(at + size, len(payload))
        found = payload.find(_VERSION, at, end)
        if found >= 0:
            end = found + 4
        yield at, end
        if end >= len(payload):
            return
        at = end


def _record(kind: str, block: bytes, **headers: str | int | None) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in headers.items() if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + _END + block


def _records(row: dict, size: int) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response and its continuations."""
    data = row["data"] or b""
    whole = hashlib.sha1()
    for a, b in chunks(data, size):
        whole.update(memoryview(data)[a:b])
    name = f"<urn:uuid:{uuid.UUID(int=row['record'])}>"
    common = {
        "WARC_Record_ID": name, "X_Page_ID": row["page"], "X_Payload_Length": len(data),
        "WARC_Target_URI": _BLANK.sub(lambda m: f"%{ord(m[0]):02X}", row["url"] or "") or None,
        "WARC_Payload_Digest": f"sha1:{base32(whole.digest())}"}
    if not row["response"]:
        yield _record("revisit", b"", **common, WARC_Profile=_PROFILE, X_Refers_To_Page=row["refers"],
                      WARC_Refers_To=f"<urn:uuid:{uuid.UUID(int=row['original'])}>")
        return
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(data)}\r\n\r\n".encode()
    so_far = hashlib.sha1()
    for number, (a, b) in enumerate(chunks(data, size), 1):
        part = data[a:b]
        so_far.update(part)
        state = {"X_Digest_So_Far": base32(so_far.digest())}
        if b < len(data) or number > 1:
            state["WARC_Segment_Number"] = number
        if b == len(data) and number > 1:
            state["WARC_Segment_Total_Length"] = len(http) + len(data)
        if number == 1:
            yield _record("response", http + part, **common, **state)
        else:
            yield _record("continuation", part, WARC_Record_ID=f"<urn:uuid:{uuid.uuid5(uuid.UUID(int=row['record']), str(number))}>",
                          WARC_Segment_Origin_ID=name, **state)


def write(pages: DataFrame, path: str, *, key: str = "page_id", url: str = "url", html: str = "html",
          chunk: int = CHUNK, least: int = 0) -> None:
    """Write one record for each row of ``pages`` to gzip files in ``path``.

    Of equal payloads of ``least`` bytes or more, the one with the largest key is a response and the others revisit
    it; rows that share that key and payload are all responses. A null payload is empty; a null url or key is left
    out of the header. Other columns are not read.
    """
    data = F.coalesce(F.col(html).cast("string").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(key).alias("page"), F.col(url).cast("string").alias("url"), data.alias("data"),
                        F.monotonically_increasing_id().alias("record")) \
        .withColumn("sha1", F.sha1("data")).withColumn("size", F.octet_length("data"))
    # Equal payloads are found by digest and length; a frequent payload is one row here.
    top = rows.where(F.col("size") >= least).groupBy("sha1", "size").agg(
        F.count("*").alias("n"), F.max(F.struct("page", "record")).alias("top")).where("n > 1").select("sha1", "size", "top")
    marked = rows.join(top, ["sha1", "size"], "left").select(
        F.col("page").cast("string").alias("page"), "url", "data", "record",
        (F.col("top").isNull() | F.col("page").eqNullSafe(F.col("top.page"))).alias("response"),
        F.col("top.page").cast("string").alias("refers"), F.col("top.record").alias("original"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            for n in range(batch.num_rows):
                for record in _records(batch.slice(n, 1).to_pylist()[0], chunk):
                    out.append(record)
                    size += len(record)
                    if size >= FLUSH:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                        out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    marked.mapInArrow(archive, "value binary").select(F.col("value").cast("string")) \
        .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, block) of a record as the reader cuts it."""
    head, _, rest = record.removeprefix(_VERSION + b"\r\n").partition(_END)
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode(errors="replace").split("\r\n"))}
    size = int(headers["content-length"])
    if rest[size:] not in (b"", _END) or len(rest) < size:
        raise ValueError(f"record {headers.get('warc-record-id')} is broken")
    return headers, rest[:size]


_CHUNKS = ("record string, number int, last boolean, type string, page string, refers string, size bigint, "
           "digest string, so_far string, data binary")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of an archive: a row for each record or segment, with the payload bytes it holds."""
    raw = spark.read.option("lineSep", "\r\n\r\nWARC/1.1\r\n").text(path).select(F.col("value").cast("binary").alias("value"))

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c.split()[0]: [] for c in _CHUNKS.split(", ")}
            for value in batch.column("value").to_pylist():
                headers, block = parse(value)
                kind = headers["warc-type"]
                data = block.partition(_END)[2] if kind == "response" else block
                digest, size = headers.get("warc-payload-digest"), headers.get("x-payload-length")
                segment = headers.get("warc-segment-number")
                for k, v in (("record", headers.get("warc-segment-origin-id", headers["warc-record-id"])), ("number", int(segment or 1)),
                             ("last", segment is None or "warc-segment-total-length" in headers), ("type", kind),
                             ("page", headers.get("x-page-id")), ("refers", headers.get("x-refers-to-page")),
                             ("size", int(size) if size else None), ("digest", digest and digest.removeprefix("sha1:")),
                             ("so_far", headers.get("x-digest-so-far")), ("data", data)):
                    out[k].append(v)
            return out

        return work

    return map_rows(raw, _CHUNKS, make)


def records(table: DataFrame, kind: str = "bigint") -> DataFrame:
    """One row for each record: page_id, payload_bytes, payload_digest, record_type, refers_to; digests are checked.

    Only segmented records are brought together, as rows in order: a task carries one digest on from row to row.
    A digest or length that does not agree with the bytes read, or a lost segment, is an error. An empty archive has
    no records.
    """
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, so_far, size, number = {}, hashlib.sha1(), 0, 0
        for batch in batches:
            done = []
            columns = [c for c in batch.schema.names if c != "data"]
            for row, data in zip(batch.select(columns).to_pylist(), batch.column("data"), strict=True):
                if row["number"] == 1:
                    first, so_far, size, number = row, hashlib.sha1(), 0, 0
                number += 1
                if row["type"] == "revisit":
                    done.append(row)
                    continue
                if row["record"] != first.get("record") or row["number"] != number:
                    raise ValueError(f"record {row['record']} lacks a segment")
                so_far.update(data.as_buffer())
                size += len(data.as_buffer())
                state = base32(so_far.digest())
                if state != row["so_far"] or row["last"] and (state, size) != (first["digest"], first["size"]):
                    raise ValueError(f"record {row['record']} does not have its digest")
                if row["last"]:
                    done.append(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[c] for x in done], t) for c, t in (("page", pa.string()), ("size", pa.int64()), ("digest", pa.string()),
                                                                ("type", pa.string()), ("refers", pa.string()))],
                names=["page", "payload_bytes", "payload_digest", "record_type", "refers"])

    schema = "page string, payload_bytes bigint, payload_digest string, record_type string, refers string"
    alone = table.where("number = 1 and last").mapInArrow(check, schema)
    segmented = table.where("number > 1 or not last").repartition("record").sortWithinPartitions("record", "number").mapInArrow(check, schema)
    return alone.unionByName(segmented).select(F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                               F.col("refers").cast(kind).alias("refers_to"))
