"""Periodic runs against the definition, word by word, on random, periodic and odd texts."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from shelfwise.llm import runs

KIND = "doc_id long, text string"


def brute_runs(words):
    """Every maximal stretch of smallest period q with at least max(6, 4 q) words."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            stretch = words[i:i + length]
            if length >= max(6, 4 * q) and not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    gone = {x for s, length, q in found for x in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(kept))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_code_rows_follow_the_definition(seed):
    draw = random.Random(seed)
    rows = []
    for _ in range(12):
        row = []
        while len(row) < draw.choice([0, 5, 6, 40, 90]):
            word = [draw.randrange(draw.choice([1, 2, 3, 30])) for _ in range(draw.choice([1, 2, 3, 6, 7, 16, 20]))]
            row += (word * draw.choice([1, 1, 3, 4, 5, 8]))[:draw.choice([6, 30, 90, 200])]
        rows.append(row)
    at = np.cumsum([0, *map(len, rows)])
    start, length, period = runs.runs_of(np.array([c for r in rows for c in r], np.int64), at)
    expected = [(int(at[i]) + s, n, q) for i, r in enumerate(rows) for s, n, q in brute_runs(r)]
    assert list(zip(start.tolist(), length.tolist(), period.tolist())) == expected


def texts():
    draw = random.Random(5)
    out = [None, "", " \t\n", "a", "a a a a a a", "a a a a a", "\x0b".join(["ä b", "c"] * 9), "x " * 300]
    out += [" ".join(f"w{i}" for i in range(45)) + "\n" + "the same line again\r\n" * 7 + "end"]
    out += [" ".join(" ".join(f"{k}{i}" for i in range(50)) for k in "aaaaabbbb")]
    for n in [3, 10, 50, 200, 600]:
        out += [" ".join(draw.choice("abcdefgh") * draw.choice([1, 1, 2]) for _ in range(n)) for _ in range(10)]
    return out


def test_report_follows_the_definition_on_all_kinds_of_texts(spark):
    rows = list(enumerate(texts() * 3)) + [(None, "a b " * 20), (7, "again"), (7, "again")]
    df = spark.createDataFrame(rows, KIND)
    got = [tuple(r) for r in runs.runs_report(df).select(*COLUMNS).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, str(r))
    assert sorted(got, key=key) == sorted((brute(*r) for r in rows), key=key)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 15
    assert sum(r[1] > 0 for r in got) > 15


def test_a_shorter_piece_of_work_changes_nothing(spark, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], KIND)
    want = sorted(runs.find_runs(df, "text", ["doc_id"]).collect())
    monkeypatch.setattr(runs, "pieces", lambda column: __import__("shelfwise.llm.texts", fromlist=["x"]).pieces(column, 50))
    assert sorted(runs.find_runs(df.repartition(3), "text", ["doc_id"]).collect()) == want


def test_names_of_very_many_grams_stay_distinct():
    part = np.array([0, 1 << 40, 1 << 40, 7], np.int64)
    order, names = runs._named([part, part, part])
    assert names.tolist() == [0, 1, 2, 2] and order.tolist() == [0, 3, 1, 2]


def test_very_long_text(spark):
    block = " ".join(f"w{i}" for i in range(40_000))
    df = spark.createDataFrame([(1, " ".join([block] * 5)), (2, "na " * 200_000)], KIND)
    got = {r.doc_id: r for r in runs.find_runs(df, "text", ["doc_id"]).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 200_000, 40_000)] and got[1].collapsed == block
    assert [tuple(x) for x in got[2].runs] == [(0, 200_000, 1)] and got[2].collapsed == "na"


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a " * 8, 5, "x", 3)], KIND + ", runs int, collapsed string, start int")
    assert [r.n_runs for r in runs.runs_report(df).collect()] == [1]
    assert runs.runs_report(spark.createDataFrame([], KIND)).collect() == []
