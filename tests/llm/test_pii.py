"""Spans against Python's matcher, on random and on hostile texts."""

import hashlib
import random
import re

import pytest

from shelfwise.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(x) <= 255 for x in match.split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def brute(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PLAIN.items())
             for m in re.finditer(p, text or "") if holds(kind, m.group())]
    joined = ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found))
    counts = [sum(f[3] == kind for f in found) for kind in PLAIN]
    return (*counts, hashlib.sha256(joined.encode()).hexdigest())


def texts():
    draw = random.Random(5)
    out = ["".join(draw.choice("a.@-+1 2(5)4%é€") for _ in range(draw.randint(0, 60))) for _ in range(800)]
    out += ["".join(draw.choice("0123456789 -") for _ in range(draw.randint(10, 40))) for _ in range(500)]
    out += ["a@b.co%x@y.com..z", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "é" * 5 + "a@b.c", "\U0001F600 a@b.cd",
            "x" * 60000 + "@a.b", "1.1.1.1 " * 300, "1 " * 5000, "a." * 5000 + "@b.c", "", None, None]
    return out


def test_base_spans_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"])
           for r in pii.pii_report(df).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_added_kinds_checksums_and_context(spark):
    data = [(1, "iban DE89 3704 0044 0532 0130 00 end"), (2, "iban DE89 3704 0044 0532 0130 01 end"),
            (3, "number 123-45-6789 here"), (4, "his ssn is 123-45-6789 here"), (5, "card 4111 1111 1111 1111")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.pii_report(df).collect()}
    assert "iban:5:32" in spans[1] and "iban" not in spans[2]
    assert "ssn" not in spans[3] and "ssn:11:22" in spans[4]
    scored = {r["id"]: r["spans"] for r in pii.find_pii(df, "doc_id", "text").collect()}
    assert scored[5][0]["score"] == pytest.approx(0.95)


def test_redact(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "mail a@b.cd or +1 (415) 555-0100 now"), (2, None), (3, "")], "doc_id long, text string")
    found = pii.find_pii(df, "doc_id", "text").join(df.withColumnRenamed("doc_id", "id"), "id")
    out = {r["id"]: r["x"] for r in found.select("id", pii.redact(F.coalesce("text", F.lit("")), F.col("spans")).alias("x")).collect()}
    assert out == {1: "mail [email] or [phone] now", 2: "", 3: ""}


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a@b.cd", "x", 3)], "doc_id long, text string, spans string, id long")
    assert pii.pii_report(df).first()["spans"] == "email:0:6"
    assert pii.pii_report(df.limit(0)).count() == 0


def test_no_python_on_the_path(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = pii.pii_report(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
