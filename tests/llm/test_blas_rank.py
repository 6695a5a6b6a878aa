"""Ranked search against plain whole-number arithmetic, ties and tiles included."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from shelfwise.llm import blas_rank
from shelfwise.llm.queries import QUERIES

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, k=20):
    counts = [(i, Counter(words(t))) for i, t in docs]
    n = sum(1 for _, c in counts if c)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            if not c:
                continue
            m = 100 - 25 + (25 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (
                (10 ** 9 * c[t]) // (1000 * c[t] + 12 * m)) for t in words(text) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=lambda r: (str(r[0]), r[1]))


def data(seed=1, n=400):
    draw = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Ärger", "ñu", "X9", "été"]
    docs = [(i, " ".join(draw.choices(vocab, range(1, 65), k=draw.choice([1, 3, 20, 200])))) for i in range(n)]
    docs += [(n + i, "w3 W4! w5") for i in range(40)] + [(5000, None), (5001, ""), (5002, "--!"), (None, "w3 w4 w5"), (1, "w3 w4 w5")]
    items = [(i, " ".join(draw.choices(vocab, k=draw.choice([1, 4, 30])))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "unheard of"), (103, "w3 w4 w5"), (104, "w1 " * 500)]
    return docs, items


def test_ranking_follows_the_definition(spark):
    docs, items = data()
    df = spark.createDataFrame(docs, DOCS).repartition(7)
    got = rows_of(blas_rank.rank_documents(df, spark.createDataFrame(items, ITEMS)))
    assert got == sorted(brute(docs, items), key=lambda r: (str(r[0]), r[1]))
    ties = [r for r in got if r[0] == 103]
    assert len({r[3] for r in ties}) < len(ties) == 20


def test_blocks_and_tiles_change_nothing(spark, monkeypatch):
    docs, items = data(2)
    df, asked = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    want = rows_of(blas_rank.rank_documents(df, asked))
    assert rows_of(blas_rank.rank_documents(df.repartition(3), asked, block_terms=60)) == want
    monkeypatch.setattr(blas_rank, "TILE_DOCS", 3)
    monkeypatch.setattr(blas_rank, "TILE_ITEMS", 4)
    weight = np.full(64, 2000)
    entries = np.arange(64) % 5, np.arange(64), np.full(64, 900)
    tiles = blas_rank.vocabulary_tiles(*entries, weight, most=7, exact=2000 * blas_rank.IMPACT * 1000)
    held = np.zeros((5, 64), int)
    for terms, item, at, n in tiles:
        assert len(terms) <= 7
        np.add.at(held, (item, terms[at]), n)
        assert np.bincount(item, n).max() * 2000 * blas_rank.IMPACT < 2000 * blas_rank.IMPACT * 1000
    want_held = np.zeros((5, 64), int)
    want_held[entries[0], entries[1]] = 900
    assert (held == want_held).all() and len(tiles) >= 13
    split = blas_rank.vocabulary_tiles(np.array([0]), np.array([0]), np.array([5000]), weight, exact=2000 * blas_rank.IMPACT * 1000)
    assert sum(t[3].sum() for t in split) == 5000 and max(t[3].max() for t in split) < 1000
    assert rows_of(blas_rank.rank_documents(df, asked)) == want


def test_sums_of_the_largest_entries_are_exact():
    weight = np.array([25_000] * 3000)
    item, place, n = np.zeros(3000, np.int64), np.arange(3000), np.full(3000, 200)
    tiles = blas_rank.vocabulary_tiles(item, place, n, weight)
    value = np.full(3000, 25_000 * 999_999)
    got = blas_rank._product(np.zeros(3000, np.int64), place, value, 1, 3000, tiles, 0, 1)
    assert got[0, 0] == 3000 * 200 * 25_000 * 999_999 > 1 << 53


def test_long_documents_do_not_overflow():
    n = np.array([10 ** 9, 5])
    got = blas_rank.impacts(np.array([3, 1]), n, 10 ** 12, 10 ** 14)
    assert got.tolist() == [(10 ** 9 * t) // (1000 * t + 12 * (75 + 25 * int(x) * 10 ** 12 // 10 ** 14)) for t, x in zip([3, 1], n)]


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(None, "a"), (2, None)])])
def test_empty_tables(spark, docs, items):
    df = blas_rank.rank_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert rows_of(df) == brute(docs, items)


def test_repeated_items_and_clashing_columns(spark):
    docs, _ = data(3, 60)
    df = spark.createDataFrame([(*r, 1, 2) for r in docs], DOCS + ", score int, item_id int")
    asked = spark.createDataFrame([(1, "w3", 0), (1, "w3", 0), (1, "w4 w9", 0)], ITEMS + ", rank int")
    got = rows_of(blas_rank.rank_documents(df, asked))
    assert sorted(got) == sorted(brute(docs, [(1, "w3"), (1, "w3"), (1, "w4 w9")]))


def test_query_names(spark):
    assert "op13_lexical_search" in QUERIES
