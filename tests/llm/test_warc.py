"""Exact round trips through archives, and revisits against a dictionary version."""

import gzip
import hashlib
import random

from shelfwise.llm import warc
from shelfwise.llm.shared import open_fs, scratch_path

SCHEMA = "page_id long, url string, html string"


def brute(pages):
    payloads = [(i, (h or "").encode()) for i, _, h in pages]
    first = {}
    for i, p in payloads:
        if len(p) >= 100:
            first[p] = min(first.get(p, i), i)
    return sorted((i, len(p), hashlib.sha256(p).hexdigest(), *(
        ("revisit", first[p]) if len(p) >= 100 and first[p] != i else ("response", None))) for i, p in payloads)


def pages():
    draw = random.Random(2)
    out = [(3, "u\r\nWARC-Type: x", "h" * 100), (1, None, "h" * 100), (2, "v", "h" * 100), (5, "v", "s"), (4, "v", "s"),
           (6, "v", None), (7, "v", "\r\n\r\nWARC/1.1\r\n" * 20), (8, "é", "é " * 60), (9, "v", "h" * 99)]
    texts = ["".join(draw.choice("ab\r\né<>") for _ in range(draw.randrange(300))) for _ in range(30)]
    out += [(100 + i, f"http://{i}", draw.choice(texts)) for i in range(200)]
    return out + [(1000 + i, "hot", "copy " * 50) for i in range(150)]


def test_pages_survive_the_archives(spark):
    rows = pages()
    out = warc.archive_pages(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = [tuple(r) for r in out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got) == brute(rows)


def test_files_hold_standard_records(spark):
    rows = pages()
    records = warc.resolve_revisits(warc.with_digest(spark.createDataFrame(rows, SCHEMA), "page_id", "url", "html"))
    files = warc.write_archives(records, scratch_path(spark, "archive"), "2024-01-01T00:00:00Z")
    back = {r["page_id"]: r for r in warc.read_archives(files).collect()}
    for i, _, html in rows:
        r = back[str(i)]
        assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]) == (html or "").encode()
    assert back["3"]["url"] == "u%0D%0AWARC-Type: x"
    where, name = open_fs(files.first()["path"])
    with where.open_input_stream(name, compression=None) as f:
        assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_large_files_are_cut(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    rows = pages()
    records = warc.resolve_revisits(warc.with_digest(spark.createDataFrame(rows, SCHEMA).coalesce(1), "page_id", "url", "html"))
    files = warc.write_archives(records, scratch_path(spark, "archive"), "2024-01-01T00:00:00Z")
    assert files.count() > 3 and warc.read_archives(files).count() == len(rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a", "x" * 200), (1, "a", "x" * 200), (None, "a", "x" * 200), (None, None, None)]
    got = warc.archive_pages(spark.createDataFrame([(*r, "z") for r in rows], SCHEMA + ", payload string")).collect()
    assert sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in got), key=str) == [
        (1, "response", None), (1, "response", None), (None, "response", None), (None, "revisit", 1)]
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0
