import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import blocks, counts, joins, ordering, similarity

DRAW = random.Random(5)
# One user holds a third of all rows.
INTERACTIONS = [(0, DRAW.randrange(25), float(i), i) for i in range(60)] + [
    (DRAW.randrange(1, 12), DRAW.randrange(25), float(i), 100 + i) for i in range(120)
]


@pytest.fixture(scope="module")
def interactions(spark):
    return spark.createDataFrame(INTERACTIONS, "user_id long, item_id long, rating double, ts long")


def matrix():
    users, items = 12, 25
    m = np.zeros((users, items))
    for u, i, _, _ in INTERACTIONS:
        m[u, i] += 1
    return m


@pytest.mark.parametrize("hot", [2, 5, 10_000])
def test_item_cosine_with_split_users(interactions, hot):
    m = matrix()
    unit = m / np.linalg.norm(m, axis=0)
    want = unit.T @ unit
    got = {(r.item_id, r.other_id): r.similarity
           for r in similarity.item_cosine(interactions, hot=hot).collect()}
    expected = {(a, b) for a in range(25) for b in range(25) if a != b and want[a, b] > 0}
    assert set(got) == expected
    assert all(abs(got[p] - want[p]) < 1e-6 for p in expected)


def test_item_cosine_options(interactions):
    counted = Counter(i for _, i, _, _ in INTERACTIONS)
    kept = {i for i, n in counted.items() if n >= 7}
    edges = similarity.item_cosine(interactions, min_support=7).collect()
    assert {r.item_id for r in edges} <= kept


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_co_pairs_count_repeats(spark, hot):
    baskets = [(b, DRAW.randrange(6)) for b in range(5) for _ in range(7)]
    want = Counter()
    for b in range(5):
        items = [i for x, i in baskets if x == b]
        want.update(tuple(sorted(p)) for p in itertools.combinations(items, 2))
    df = spark.createDataFrame(baskets, "basket_id long, item_id long")
    pairs = joins.co_pairs(df, hot)
    assert {(r.item_a, r.item_b): r.pair_count for r in pairs.collect()} == dict(want)
    full = {(r.item_a, r.item_b): r.pair_count for r in joins.co_matrix(pairs).collect()}
    assert all(full[b, a] == n for (a, b), n in want.items())
    wide = joins.co_matrix_wide(pairs, [0, 1]).collect()
    assert {(r["item_a"], r["1"]) for r in wide} == {(0, want[0, 1]), (1, want[1, 1])}


def test_users_and_votes(interactions):
    m = matrix()
    dots = m @ m.T
    np.fill_diagonal(dots, -1)
    held = counts.user_item_counts(interactions)
    near = similarity.similar_users(held, 3)
    got = {(r.user_id, r["rank"]): (r.other_user, r.dot) for r in near.collect()}
    for u in range(12):
        order = sorted((-dots[u, v], v) for v in range(12) if dots[u, v] > 0)[:3]
        assert [got[u, k + 1] for k in range(len(order))] == [(v, -d) for d, v in order]
    votes = similarity.recommend_from_neighbors(held, near, 100).collect()
    for r in votes:
        others = [got[r.user_id, k][0] for k in (1, 2, 3)]
        assert m[r.user_id, r.item_id] == 0
        assert r.votes == sum(m[o, r.item_id] > 0 for o in others)


@pytest.mark.parametrize("n, p", [(1, 0.5), (10, 0.5), (11, 0.5), (40, 0.9), (40, 0.0), (40, 1.0)])
def test_exact_quantile(spark, n, p):
    values = [DRAW.choice([DRAW.randrange(10**13), 5_000_000_000]) for _ in range(n)]
    df = spark.createDataFrame([(x,) for x in values] + [(None,)], "v long")
    got = counts.exact_quantile(df, "v", p).first()[0]
    assert got == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_history_edges(spark, rows):
    df = spark.createDataFrame(
        [(1, 5, 10), (1, 5, 11), (1, 7, 11), (1, 8, 1), (2, 1, 1)],
        "user_id long, item_id long, ts long",
    )
    assert rows(ordering.user_history(df, 2)) == [(1, 5), (1, 7), (2, 1)]
    assert rows(ordering.user_history(df, 0)) == []
    assert rows(ordering.history_lists(df, 2)) == [(1, (5, 7)), (2, (1,))]


def test_positions_and_leaves(spark, rows):
    df = spark.createDataFrame(
        [(i, [i % 2, 0], t) for i, t in enumerate(["b", None, "a", "z", "a", None])],
        "item_id long, semantic_id array<long>, title string",
    )
    assert rows(ordering.leaf_numbers(df), "item_id", "leaf_id") == [
        (0, 2), (1, 1), (2, 0), (3, 0), (4, 1), (5, 2)]
    ids = spark.createDataFrame([(9,), (4,), (9,), (None,), (7,)], "item_id long")
    assert rows(ordering.dense_ids(ids, "item_id")) == [(4, 0), (7, 1), (9, 2)]


def test_top_k_ties(spark, rows):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 2.0)], "item_id long, score double")
    assert rows(ordering.top_k(df, 2), "rank", "item_id") == [(1, 2), (2, 1)]


def test_metadata_takes_lowest_title(spark, rows):
    items = spark.createDataFrame([(1, "b"), (1, "a"), (2, None)], "item_id long, title string")
    df = spark.createDataFrame([(1,), (2,), (3,)], "item_id long")
    assert rows(joins.attach_metadata(df, items, ["title"])) == [(1, "a"), (2, None), (3, None)]


def test_future_events_bounds(spark, rows):
    hour = 3_600_000_000
    events = spark.createDataFrame(
        [(1, i, t, 1.0) for i, t in enumerate([0, 1, 24 * hour, 24 * hour + 1])],
        "user_id long, item_id long, event_us long, reward double",
    )
    anchors = spark.createDataFrame([(1, 0, 0)], "user_id long, anchor_id long, anchor_us long")
    assert rows(joins.future_events(anchors, events, 24), "item_id") == [(1,), (2,)]


def test_score_vs_seeds(spark, rows):
    edges = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.5), (3, 2, 0.1)],
                                  "item_id long, other_id long, similarity double")
    known = spark.createDataFrame([(1,), (2,), (3,)], "item_id long")
    seeds = spark.createDataFrame([(7, 1), (7, 3), (7, 99)], "user_id long, item_id long")
    cand = spark.createDataFrame([(7, 1), (7, 2), (7, 50), (8, 2)], "user_id long, item_id long")
    mean = counts.score_vs_seeds(cand, seeds, edges, known, "mean")
    assert rows(mean, "user_id", "item_id", "seed_similarity") == [
        (7, 1, 0.5), (7, 2, 0.3), (7, 50, 0.0), (8, 2, 0.0)]
    best = counts.score_vs_seeds(cand, seeds, edges, known, "max")
    assert rows(best, "item_id", "seed_similarity") == [(1, 1.0), (2, 0.0), (2, 0.5), (50, 0.0)]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "user_id long, item_id long, ts timestamp")
    assert counts.popularity(empty).count() == 0
    assert counts.sparsity(empty).first()["sparsity"] is None
    assert counts.dataset_summary(empty).first()["mean_count"] is None


def test_wide_views(spark, rows):
    df = spark.createDataFrame([(1, 5, 2), (2, 6, 1)], "user_id long, item_id long, n long")
    assert rows(counts.user_item_wide(df, [5, 6])) == [(1, 2, 0), (2, 0, 1)]


def test_volume_fills_gaps(spark, rows):
    df = spark.createDataFrame([("2024-01-05", 1), ("2024-03-01", 2), ("2024-03-02", None)],
                               "d string, item_id long").withColumn("ts", F.to_timestamp("d"))
    volume = counts.volume_by_period(df).select(F.col("period").cast("string"), "volume")
    assert rows(volume) == [("2024-01-01", 1), ("2024-02-01", 0), ("2024-03-01", 1)]


@pytest.mark.parametrize("hot, dense", [(2, 3), (4, 1), (100, 5), (1000, 1000)])
def test_pair_sums_by_every_way(spark, hot, dense):
    rows = sorted({(g, DRAW.randrange(14)) for g in range(8) for _ in range(2 + 3 * g)})
    weight = {r: 1.0 + (r[0] * 7 + r[1]) % 5 for r in rows}
    want = Counter()
    for (g, a), (h, b) in itertools.product(rows, rows):
        if g == h and a < b:
            want[a, b] += weight[g, a] * weight[g, b]
    df = spark.createDataFrame([(*r, w) for r, w in weight.items()], "g long, m long, w double")
    got = joins.co_sums(df, "g", "m", "w", hot, dense).collect()
    assert {(r.a, r.b): r.weight for r in got} == dict(want)
    assert len(got) == len(want)


@pytest.mark.parametrize("text", [False, True])
def test_block_products_over_many_blocks(spark, text):
    cells = sorted({(DRAW.randrange(9), DRAW.randrange(11)) for _ in range(60)})
    name = (lambda m: f"m{m:02d}") if text else (lambda m: m)
    want = Counter()
    for (c, a), (d, b) in itertools.product(cells, cells):
        if c == d and a < b:
            want[name(a), name(b)] += (c + a + 1) * (c + b + 1)
    kind = "string" if text else "long"
    df = spark.createDataFrame([(c, name(m), float(c + m + 1)) for c, m in cells],
                               f"column long, member {kind}, weight double")
    found = blocks.block_products(df, members=3, columns=2)
    got = found.groupBy("a", "b").agg(F.sum("product").alias("p")).collect()
    assert {(r.a, r.b): r.p for r in got} == dict(want)


def test_pair_sums_do_not_depend_on_the_way(spark, rows):
    data = [(g, m, float(w)) for g in range(3) for m, w in ((1, 0), (2, 1), (2, 2), (3, -1), (4, 5))]
    df = spark.createDataFrame(data, "g long, m long, w double")
    joined = rows(joins.co_sums(df, "g", "m", "w"))
    assert rows(joins.co_sums(df, "g", "m", "w", dense=1)) == joined
    assert rows(joins.co_sums(df, "g", "m", "w", hot=1)) == joined
    assert len(joined) == 6


def test_list_overlap_of_missing_and_unequal_lists(spark, rows):
    schema = "user_id long, item_id long"
    a = spark.createDataFrame([(1, 5), (1, 6), (2, 5), (3, None), (None, 5)], schema)
    b = spark.createDataFrame([(1, 6), (1, 7), (3, None), (4, 5), (None, 5)], schema)
    got = counts.list_overlap(a, b, 2)
    assert rows(got, "user_id", "shared", "changed") == [(1, 1, 1), (2, 0, 2), (3, 0, 2), (None, 0, 2)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and plan.count("Exchange hashpartitioning") == 1
