"""A content-addressed WARC archive.

Writing: every page becomes a WARC record. Its payload bytes go to the payload store, once per content, under a
SHA-256 digest; the exact header block goes to the record table. Of the records of one payload the one with the largest page_id is the
``response``, the others are ``revisit`` records that refer to it. Reading joins both tables, checks both digests
of every record against the bytes, parses the header block and gives back the original record.

Payloads are deflated before they move. The only shuffles are by digest; a payload that a third of all records
share is one row of the store, and AQE splits the records' side of the join.

Defined cases: a null or missing payload is an empty one. A null page_id sorts before all others, is written as no page
header, and is read back as null. Of repeated rows with the largest page_id one is the response. A null
url is written as no target. Line breaks in a url are percent-encoded, so a header stays one line. An empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.llm.common import discard, keep, ship
from marketspark.session import scratch

DATE = "2026-01-01T00:00:00Z"

_CAPTURE = "page_id long, url string, sha1 string, sha256 binary, size long, deflated binary"
_RECORD = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, record binary, intact boolean"


def _capture(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"sha1": [], "sha256": [], "size": [], "deflated": []}
        for html in batch["html"].to_pylist():
            payload = (html or "").encode()
            out["sha1"].append(base64.b32encode(hashlib.sha1(payload).digest()).decode())
            out["sha256"].append(hashlib.sha256(payload).digest())
            out["size"].append(len(payload))
            out["deflated"].append(zlib.compress(payload, 4))
        yield pa.RecordBatch.from_arrays([
            batch["page_id"], batch["url"], pa.array(out["sha1"], pa.string()), pa.array(out["sha256"], pa.binary()),
            pa.array(out["size"], pa.int64()), pa.array(out["deflated"], pa.binary()),
        ], ["page_id", "url", "sha1", "sha256", "size", "deflated"])


def header(page_id: int | None, url: str | None, sha1: str, size: int, number: int, kind: str,
           refers_to: int | None, refers_url: str | None, date: str = DATE) -> bytes:
    """The header block of one record, up to and with the empty line."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.UUID(int=number)}>", f"WARC-Date: {date}"]
    clean = lambda u: u.replace("\r", "%0D").replace("\n", "%0A")
    if url is not None:
        lines.append(f"WARC-Target-URI: {clean(url)}")
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    lines.append(f"WARC-Payload-Digest: sha1:{sha1}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            lines.append(f"Refers-To-Page: {refers_to}")
        if refers_url is not None:
            lines.append(f"WARC-Refers-To-Target-URI: {clean(refers_url)}")
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {size}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def parse(block: bytes) -> dict[str, str]:
    """Header fields by name; the first line under ``version``."""
    first, *lines = block.decode().removesuffix("\r\n\r\n").split("\r\n")
    return {"version": first} | dict(line.split(": ", 1) for line in lines)


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blocks = [header(*row.values()) for row in batch.drop_columns(["sha256"]).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["sha256"], pa.array(blocks, pa.binary())], ["sha256", "header"])


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record", pa.binary()), ("intact", pa.bool_()),
    ])
    for batch in batches:
        rows = []
        for block, deflated, sha256 in zip(*(batch[c].to_pylist() for c in ("header", "deflated", "sha256")), strict=True):
            payload, fields = zlib.decompress(deflated), parse(block)
            sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            number = lambda name: int(fields[name]) if name in fields else None  # noqa: E731, B023
            rows.append({
                "page_id": number("Page-ID"), "record_type": fields["WARC-Type"], "refers_to": number("Refers-To-Page"),
                "payload_bytes": len(payload), "payload_digest": sha1, "record": block + payload + b"\r\n\r\n",
                "intact": (f"sha1:{sha1}", str(len(payload)), hashlib.sha256(payload).digest())
                == (fields["WARC-Payload-Digest"], fields["Content-Length"], sha256),
            })
        yield pa.RecordBatch.from_pylist(rows, schema)


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write ``path/records`` and ``path/payloads`` from page_id, url and html.

    Records with a payload under ``min_bytes`` are all responses; their payloads are stored once all the same.
    """
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    captures = keep(rows.mapInArrow(_capture, _CAPTURE).withColumn("number", F.monotonically_increasing_id()), "captures")
    last = captures.groupBy("sha256").agg(
        F.max(F.struct("page_id", "number", "url")).alias("last")
    ).select("sha256", "last.*").toDF("sha256", "last_page", "last_number", "last_url")
    typed = captures.drop("deflated").join(last, "sha256").withColumn(
        "kind", F.expr(f"if(number = last_number or size < {int(min_bytes)}, 'response', 'revisit')"))
    typed.select(
        "sha256", "page_id", "url", "sha1", "size", "number", "kind", "last_page", "last_url",
    ).mapInArrow(_headers, "sha256 binary, header binary").write.option("compression", "zstd").parquet(f"{path}/records")
    # One record per content carries its payload into the store.
    captures.select("number", "sha256", "deflated").join(
        last.select(F.col("last_number").alias("number")), "number", "left_semi"
    ).drop("number").write.option("compression", "none").parquet(f"{path}/payloads")
    discard(captures)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record with its header fields, original bytes and whether both digests and the length fit them."""
    ship(spark)
    records = spark.read.schema("sha256 binary, header binary").parquet(f"{path}/records")
    payloads = spark.read.schema("sha256 binary, deflated binary").parquet(f"{path}/payloads")
    return records.join(payloads, "sha256").select("header", "deflated", "sha256").mapInArrow(_restore, _RECORD)


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages to a fresh archive in the shared folder, read it back, and describe each record."""
    path = scratch(spark, "archive")
    write_archive(pages, path)
    checked = read_archive(spark, path).withColumn(
        "payload_digest", F.expr("if(intact, payload_digest, raise_error('a payload does not fit its digest'))"))
    return checked.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
