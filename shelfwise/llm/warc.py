"""Web archives: records written by tasks, read back, and copies resolved into revisit records.

``resolve_revisits`` shuffles headers (id, digest, size), never payloads, to
find the original of each digest; ``write_archives`` writes one record per row
with fresh headers, each record its own gzip member; ``read_archives`` streams
the files back; ``originals_of`` joins revisit records to the responses they
stand for. A hot payload is one row after the partial aggregation; in the joins
both sides come straight from tables, so the adaptive skew join can split it.

Defined results: a null payload is empty; payloads below ``MIN_BYTES`` are
always responses; equal ids with equal payloads are all responses; a null id
stays null (and is nobody's original unless all copies have none).
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.shared import emit, open_fs, put_file, scratch_path, stored

MIN_BYTES = 100
FILE_BYTES = 64 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

WRITTEN = pa.schema([("path", pa.string()), ("records", pa.int64())])
READ = pa.schema([
    ("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
    ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.large_binary()),
])


def with_digest(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest) of each row."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    return (
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
        .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
        .withColumn("payload_digest", F.sha2("payload", 256)))


def resolve_revisits(records: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Add record_type and refers_to: of equal payloads the smallest id is the response."""
    copied = stored(
        records.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
        .agg(F.count("*").alias("n"), F.min("page_id").alias("first_id"))
        .where("n > 1").drop("n"), "warc-copied")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return (
        records.join(copied, "payload_digest", "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("first_id")))
        .drop("first_id"))


def _clean(value) -> str:
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in str(value))


def _record(page_id, url, payload, digest, kind, refers, date) -> bytes:
    """One record: fresh id, date, digests and lengths; a revisit keeps only the response's headers."""
    block = HTTP + (payload if kind == "response" else b"")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(SPACE, f'{page_id} {digest}')}>",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        lines.append(f"WARC-Page-ID: {_clean(page_id)}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(SPACE, f'{refers} {digest}')}>",
                  f"WARC-Refers-To-Page-ID: {_clean(refers)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str, date: str, level: int = 1) -> DataFrame:
    """Write the records below ``folder``; returns the stored list of files (path, records).

    Files have names by partition and are moved into place whole, so a repeated
    task replaces its own files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, buffer, count = TaskContext.get().partitionId(), 0, io.BytesIO(), 0

        def flush():
            nonlocal done, buffer, count
            path = f"{folder}/archive-{part:06d}-{done:04d}.warc.gz"
            put_file(path, buffer.getvalue())
            row = emit({"path": [path], "records": [count]}, WRITTEN)
            done, buffer, count = done + 1, io.BytesIO(), 0
            return row

        for batch in batches:
            # Row by row, so that one payload at a time is a Python object.
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "payload_digest", "record_type", "refers_to")]
            for i in range(batch.num_rows):
                record = _record(*(c[i].as_py() for c in columns), date)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                buffer.write(packer.compress(record) + packer.flush())
                count += 1
                if buffer.tell() >= FILE_BYTES:
                    yield flush()
        if count:
            yield flush()

    return stored(records.mapInArrow(write, "path string, records long"), "warc-files")


def _parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not an archive record: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        yield headers, stream.read(int(headers["content-length"]))


def read_archives(files: DataFrame) -> DataFrame:
    """All records of the listed files: ids as text, payload null for a revisit."""
    count = files.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                where, name = open_fs(path)
                rows, held = [], 0
                with where.open_input_stream(name, compression=None) as raw, gzip.GzipFile(fileobj=raw) as packed:
                    for headers, block in _parse(io.BufferedReader(packed, 1 << 20)):
                        kind = headers["warc-type"]
                        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                        rows.append((
                            headers.get("warc-page-id"), headers.get("warc-target-uri"), kind,
                            headers["warc-payload-digest"].removeprefix("sha256:"),
                            headers.get("warc-refers-to-page-id"), payload))
                        held += len(block)
                        if held > 8 << 20:
                            yield emit(dict(zip(READ.names, zip(*rows))), READ)
                            rows, held = [], 0
                if rows:
                    yield emit(dict(zip(READ.names, zip(*rows))), READ)

    return files.select("path").repartition(max(1, count)).mapInArrow(
        read, "page_id string, url string, record_type string, payload_digest string, refers_to string, payload binary")


def originals_of(headers: DataFrame) -> DataFrame:
    """Join revisit records to their original responses: page_id, payload_bytes, digest, type, refers_to.

    ``headers`` holds record_type, payload_digest, page_id, payload_bytes (null
    for revisits) and refers_to of all records; it is read twice.
    """
    responses = stored(
        headers.where("record_type = 'response'").groupBy("payload_digest")
        .agg(F.max("payload_bytes").alias("original_bytes"), F.min("page_id").alias("original_id")), "warc-originals")
    revisit = F.col("record_type") == "revisit"
    return headers.join(responses, "payload_digest", "left").select(
        "page_id", F.when(revisit, F.col("original_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        "payload_digest", "record_type", F.when(revisit, F.col("original_id")).alias("refers_to"))


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write the deduplicated archives of the pages, read them back and resolve the revisits."""
    spark = pages.sparkSession
    id_type = pages.schema[id_col].dataType
    records = resolve_revisits(with_digest(pages, id_col, url_col, payload_col))
    files = write_archives(records, scratch_path(spark, "warc"), date)
    read = read_archives(files)
    response = F.col("record_type") == "response"
    headers = stored(read.select(
        F.col("page_id").cast(id_type).alias("page_id"), "record_type",
        F.when(response, F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
    ), "warc-headers")
    return originals_of(headers)
