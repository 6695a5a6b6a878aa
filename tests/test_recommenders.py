import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import counts, ranking, sequences, similarity
from shelfwise.operators.ordering import user_history


@pytest.fixture(scope="module")
def interactions(spark):
    data = [(u, i, 1.0, 10 * u + i) for u in range(6) for i in range(8) if (u * 3 + i * 5) % 4]
    data += [(9, i, 1.0, i) for i in range(8)]
    return spark.createDataFrame(data, "user_id long, item_id long, rating double, ts long")


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame([(u,) for u in (0, 1, 2, 9, 77)], "user_id long")


def test_nothing_seen_is_recommended(requests, interactions, rows):
    edges = similarity.item_cosine(interactions)
    seen = set(rows(user_history(interactions)))
    popular = [r.item_id for r in counts.popular_items(interactions, 3).orderBy("rank").collect()]
    for result in (
        ranking.recommend_item_knn(requests, interactions, edges, 3),
        ranking.recommend_popular(requests, interactions, 3),
        ranking.recommend_popular_rescored(requests, interactions, edges, 3),
    ):
        got = result.collect()
        assert not {(r.user_id, r.item_id) for r in got} & seen
        cold = sorted((r["rank"], r.item_id) for r in got if r.user_id == 77)
        assert [i for _, i in cold] == popular
        assert not [r for r in got if r.user_id == 9]


def test_pool_bounds_the_popular_list(requests, interactions):
    got = ranking.recommend_popular(requests, interactions, 3, pool=2).collect()
    assert max(Counter(r.user_id for r in got).values()) <= 2


def test_full_weight_is_similarity_order(spark, rows):
    df = spark.createDataFrame([(1, 1, 0.2, 1.0), (1, 2, 0.9, 0.0), (1, 3, 0.5, 0.4)],
                               "user_id long, item_id long, similarity double, popularity double")
    assert rows(ranking.rank_blend(df, 1.0, 2), "rank", "item_id") == [(1, 2), (2, 3)]
    assert rows(ranking.rank_blend(df, 0.0, 2), "rank", "item_id") == [(1, 1), (2, 3)]


def test_missing_signal_counts_zero(spark, rows):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 0.5)], "user_id long, item_id long, a double")
    assert rows(ranking.WeightedRanker({"a": 2.0})(df, 5), "item_id", "score") == [(1, 0.0), (2, 1.0)]


def test_response_form(spark):
    df = spark.createDataFrame([(1, 1, 5, 0.5)], "user_id long, rank long, item_id long, score double")
    row = ranking.scored_items(df, ["score"]).first()
    assert row["item"]["item_id"] == "5" and row["item"]["score"] == {"score": 0.5}


@pytest.mark.parametrize("k", [1, 3, 20])
def test_random_items(spark, k):
    requests = spark.createDataFrame([(i,) for i in range(400)], "request_id long")
    items = spark.createDataFrame([(100 + 7 * i,) for i in range(10)], "item_id long")
    got = similarity.random_items(requests, items, k, seed=3).collect()
    per = Counter(r.request_id for r in got)
    assert set(per.values()) == {min(k, 10)}
    assert len({(r.request_id, r.item_id) for r in got}) == len(got)
    shares = Counter(r.item_id for r in got)
    expected = 400 * min(k, 10) / 10
    assert all(abs(n - expected) <= 5 * math.sqrt(expected) for n in shares.values())
    again = similarity.random_items(requests, items, k, seed=3).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_random_items_broadcast_no_draws(spark):
    requests = spark.range(400).withColumnRenamed("id", "request_id")
    items = spark.range(50).withColumnRenamed("id", "item_id")
    plan = similarity.random_items(requests, items, 3)._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join [dense_id" in line)
    assert "SortMergeJoin" in join


def test_tags(spark, rows):
    items = spark.createDataFrame(
        [(1, ["a", "b"]), (2, ["b", "a"]), (3, ["b", "c"]), (4, []), (5, None), (6, ["z"])],
        "item_id long, tags array<string>",
    )
    for hot in (1, 100):
        near = similarity.similar_by_tags(items, 2, hot)
        assert rows(near, "item_id", "rank", "other_id", "similarity") == [
            (1, 1, 2, 1.0), (1, 2, 3, 0.333333), (2, 1, 1, 1.0), (2, 2, 3, 0.333333),
            (3, 1, 1, 0.333333), (3, 2, 2, 0.333333)]


def test_genre_route_fallbacks(spark):
    items = spark.createDataFrame([(1, ["a"]), (2, ["b"]), (3, ["a", "b"]), (4, ["c"])],
                                  "item_id long, genres array<string>")
    seen = spark.createDataFrame([(1, 2), (2, 4), (3, 1), (5, 99)], "user_id long, item_id long")
    requests = spark.createDataFrame(
        [(10, 1, 1), (11, 2, 1), (12, 3, None), (13, 4, None), (14, None, 2), (15, 5, None)],
        "request_id long, user_id long, seed_item_id long",
    )
    got = {}
    for r in similarity.popular_in_genre(requests, seen, items, 10).collect():
        got.setdefault(r.request_id, set()).add(r.item_id)
    rated = {1, 2, 4, 99}
    assert got == {10: {3}, 11: rated, 12: {1, 3}, 13: rated, 14: {2, 3}, 15: rated}


def test_routes(spark, rows):
    edges = spark.createDataFrame([(1, 2, 0.5)], "item_id long, other_id long, similarity double")
    served = spark.createDataFrame([(7, 3, 0.4)], "user_id long, item_id long, score double")
    popular = spark.createDataFrame([(9, 1.0, 1)], "item_id long, popularity double, rank long")
    requests = spark.createDataFrame([(1, 7, 1), (2, 7, None), (3, None, None)],
                                     "request_id long, user_id long, seed_item_id long")
    found = similarity.routed_candidates(requests, edges, served, popular)
    assert rows(found, "request_id", "route", "item_id") == [
        (1, "similar", 2), (2, "user", 3), (3, "popular", 9)]


def sessions_by_hand(events, gap):
    out = {}
    for user in {u for u, _, _ in events}:
        last = start = None
        for t, i in sorted((t, i) for u, i, t in events if u == user):
            if last is None or t - last >= gap:
                start = t
            out.setdefault((user, start), []).append(i)
            last = t
    return out


@pytest.mark.parametrize("slice_hours", [1, 24])
def test_sessions_across_slices(spark, slice_hours):
    minute = 60_000_000
    times = [0, 29, 58, 59, 61, 90, 119, 121, 151, 400, 429, 800, 830, 859, 888, 917, 946, 1500]
    events = [(u, i, t * minute) for u in (1, 2) for i, t in enumerate(times) if (i + u) % 5]
    events += [(3, 1, 0), (3, 2, 0), (3, 3, 30 * minute), (3, 4, 59 * minute)]
    df = spark.createDataFrame(events, "user_id long, item_id long, event_us long")
    marked = sequences.mark_sessions(df, 30, slice_hours)
    got = {}
    for r in marked.orderBy("event_us", "item_id").collect():
        got.setdefault((r.user_id, r.session_us), []).append(r.item_id)
    assert got == sessions_by_hand(events, 30 * minute)


def test_negatives(spark, rows):
    targets = spark.createDataFrame([(0, 3), (1, 4)], "position long, item_id long")
    drawn = sequences.sample_negatives(targets, 50, 500, seed=1)
    got = rows(drawn)
    assert [g[0] for g in got] == list(range(500)) and got[:2] == [(0, 3, True), (1, 4, True)]
    assert {g[1] for g in got} <= set(range(50)) and len({g[1] for g in got}) > 40
    assert got == rows(sequences.sample_negatives(targets, 50, 500, seed=1))


def test_serving_plan_counts_empty_intervals(spark, rows):
    data = [(0, 1, 1.0), (0, 2, 0.2), (2, 2, 0.9), (3, 1, 0.0)]
    df = spark.createDataFrame(data, "h long, item_id long, rate double").select(
        F.timestamp_seconds(F.col("h") * 3600).alias("interval_start"), "item_id", "rate")
    got = rows(counts.serving_plan(df, 1, 100, top=1), "interval", "item_id", "mean_rate", "planned")
    assert got == [(0, 1, None, 50), (0, 2, None, 50), (1, 1, 1.0, 100), (2, 1, 0.5, 100),
                   (3, 2, 0.366667, 100)]


def test_popular_for_a_user_who_has_seen_the_pool(spark):
    seen = [(1, i) for i in range(60)] + [(2, i) for i in range(100) for _ in range(2)] + [(3, 99)]
    data = spark.createDataFrame(seen, "user_id long, item_id long").withColumn("ts", F.current_timestamp())
    users = data.select("user_id").distinct()
    found = ranking.recommend_popular(users, data, k=10, pool=30).collect()
    mine = sorted((r["rank"], r["item_id"]) for r in found if r["user_id"] == 1)
    counted = {i: sum(1 for _, x in seen if x == i) for i in range(100)}
    want = sorted((i for i in range(60, 100)), key=lambda i: (-counted[i], i))[:10]
    assert mine == [(n + 1, i) for n, i in enumerate(want)]
    assert not [r for r in found if r["user_id"] == 2]
    assert sum(r["user_id"] == 3 for r in found) == 10
