"""Top-k of sparse products against all products."""

import numpy as np
import pytest

from shelfwise.operators import top_products as tp


def data(seed, n, columns, share, whole):
    rng = np.random.default_rng(seed)
    m = np.where(rng.random((n, columns)) < share * rng.random((n, 1)), rng.integers(1, 5, (n, columns)) if whole
                 else rng.random((n, columns)), 0.0)
    m[n // 2: n // 2 + 12] = m[0]  # equal rows: ties
    if not whole:
        m /= np.maximum(np.sqrt((m * m).sum(1, keepdims=True)), 1e-9)
    return m


def frame(spark, m, ids):
    rows, columns = np.nonzero(m)
    return spark.createDataFrame([(int(ids[r]), int(c) * 7 - 3, float(m[r, c])) for r, c in zip(rows, columns)],
                                 "member long, column long, weight double")


def brute(m, ids, k, digits, wanted=None):
    s = m @ m.T
    s = s if digits is None else np.floor(s * 10**digits + 0.5) / 10**digits
    out = {}
    for i in range(len(m)):
        if wanted is None or ids[i] in wanted:
            order = sorted((-s[i, j], ids[j]) for j in range(len(m)) if j != i and s[i, j] > 0)[:k]
            out.update({(int(ids[i]), r + 1): (int(j), -x) for r, (x, j) in enumerate(order)})
    return out


def got(df):
    return {(r.member, r["rank"]): (r.other, r.score) for r in df.collect()}


@pytest.mark.parametrize("order, digits, share, block, entries, hot", [
    ("norm", None, 0.4, 16, 1 << 20, 1 << 18), ("norm", None, 0.4, 64, 200, 1 << 18), ("norm", None, 0.5, 32, 1 << 20, 12),
    ("columns", 6, 0.4, 16, 1 << 20, 1 << 18), ("columns", 6, 0.04, 50, 1 << 20, 1 << 18), ("columns", 6, 0.5, None, 90, 10)])
def test_top_products_follow_all_products(spark, order, digits, share, block, entries, hot):
    m = data(1, 150, 40, share, digits is None)
    ids = np.random.default_rng(2).permutation(1000)[:150] - 300
    found = got(tp.top_products(frame(spark, m, ids), 5, order, digits, block=block, entries=entries, hot=hot))
    want = brute(m, ids, 5, digits)
    assert {p: j for p, (j, _) in found.items()} == {p: j for p, (j, _) in want.items()}
    assert all(abs(found[p][1] - x) < 1e-9 for p, (_, x) in want.items())


def test_only_wanted_members_get_lists(spark):
    m, ids = data(3, 80, 30, 0.3, False), np.arange(80)
    wanted = spark.createDataFrame([(3,), (3,), (44,), (None,), (999,)], "member long")
    for hot in (1 << 18, 8):
        found = got(tp.top_products(frame(spark, m, ids), 4, "columns", wanted=wanted, block=16, hot=hot))
        assert {p: j for p, (j, _) in found.items()} == {
            p: j for p, (j, _) in brute(m, ids, 4, 6, {3, 44}).items()}


def test_few_shared_columns_are_multiplied_entry_by_entry(monkeypatch):
    m = data(5, 60, 200, 0.05, False)
    rows, columns = np.nonzero(m)
    block = tp.Block.of(np.arange(60), np.bincount(rows, minlength=60), columns, m[rows, columns], np.ones(60, bool))
    for cost, pairs in ((0, 7), (10**9, 7)):
        monkeypatch.setattr(tp, "PAIR_COST", cost)
        monkeypatch.setattr(tp, "PAIRS", pairs)
        some = np.array([3, 50, 7])
        out = block.products(some, block)
        if cost == 0:
            dense = np.zeros((3, 60))
            dense[out[0], out[1]] = out[2]
            out = dense
        assert np.allclose(out, m[some] @ m.T)


def test_blocks_that_cannot_reach_are_not_visited(spark):
    # Two groups of rows without a common column, and one of tiny norms.
    m = np.zeros((120, 40))
    rng = np.random.default_rng(4)
    m[:60, :20] = rng.random((60, 20))
    m[60:, 20:] = rng.random((60, 20))
    m[100:] *= 1e-3
    packed = {}
    stored = tp.stored

    def keep(df, name):
        packed[name] = stored(df, name)
        return packed[name]

    tp.stored = keep
    try:
        found = got(tp.top_products(frame(spark, m, np.arange(120)), 3, "columns", None, block=10))
    finally:
        tp.stored = stored
    assert {p: j for p, (j, _) in found.items()} == {p: j for p, (j, _) in brute(m, np.arange(120), 3, None).items()}
    blocks = packed["blocks"].count()
    assert packed["visits"].count() < blocks * (blocks - 1) / 2


def test_empty_null_and_useless_rows(spark):
    kind = "member long, column long, weight double"
    assert tp.top_products(spark.createDataFrame([], kind), 3).collect() == []
    rows = [(None, 1, 1.0), (1, None, 1.0), (1, 2, 0.0), (1, 3, -1.0), (1, 4, None), (1, 5, 1.0), (2, 5, 2.0), (3, 6, 1.0)]
    assert got(tp.top_products(spark.createDataFrame(rows, kind), 3, digits=None)) == {(1, 1): (2, 2.0), (2, 1): (1, 2.0)}


def test_only_full_lists_leave_the_search(spark, monkeypatch):
    """However many blocks are visited, no more than k rows per member are given on."""
    found, top_k = [], tp.top_k
    monkeypatch.setattr(tp, "top_k", lambda df, *args, **names: found.append(df) or top_k(df, *args, **names))
    monkeypatch.setattr(tp, "HELD", 40)
    m, ids = data(6, 150, 12, 0.9, True), np.arange(150)
    lists = got(tp.top_products(frame(spark, m, ids), 4, digits=None, block=10))
    want = brute(m, ids, 4, None)
    assert {p: j for p, (j, _) in lists.items()} == {p: j for p, (j, _) in want.items()}
    assert found[0].count() == len(want)


@pytest.mark.parametrize("scale", [1.0, 1e-20, 1e20])
def test_single_precision_only_screens_pairs(scale, monkeypatch):
    draw = np.random.default_rng(5)
    x = draw.random((600, 40)) * (draw.random((600, 40)) < 0.7)
    x[300:] = x[:300] * (1 + 1e-7 * draw.random((300, 1)))  # nearer to one another than single precision can tell
    x *= scale
    sizes = (x > 0).sum(1)
    block = tp.Block.of(np.arange(600), sizes, np.nonzero(x)[1], x[x > 0], np.ones(600, bool))
    kinds, take = set(), tp.Lists._take
    monkeypatch.setattr(tp.Lists, "_take", lambda self, rows, other, products, *a: (
        kinds.add(products.dtype), take(self, rows, other, products, *a)))
    lists = tp.Lists(block, 7, None)
    lists.visit(block)
    line, place, others, scores = lists.found()
    assert kinds == {np.dtype(np.float32 if scale == 1.0 else np.float64)}
    dots = x @ x.T
    np.fill_diagonal(dots, -1)
    want = np.lexsort((np.tile(np.arange(600), (600, 1)), -dots), axis=1)[:, :7]
    assert (others.reshape(600, 7) == want).mean() > 0.999  # sums of another order may differ in the last digit
    assert np.allclose(scores.reshape(600, 7), np.take_along_axis(dots, want, 1), rtol=1e-14, atol=0)
