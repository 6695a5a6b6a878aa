"""Bitmaps of items, joins on hot keys, and the operators that use them, against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import bitmaps, joins, similarity
from shelfwise.operators.spread import spread, spread_join

ITEMS = "item_id long, genres array<string>"


def test_bitmaps_over_several_buckets(spark):
    places = [1, 2, 8, 9, 32768, 32769, 40000, 65536, 65537]
    tagged = spark.createDataFrame([("a", p) for p in places] + [("b", 7), (None, 3)], "genre string, place long")
    maps = bitmaps.key_bitmaps(tagged, "genre")
    sets = spark.createDataFrame([(["a", "b"],)], "keys array<string>")
    both = bitmaps.united(sets, maps, "keys", "genre").select("bucket", bitmaps.members("bits").alias("at")).collect()
    got = sorted((r.bucket - 1) * bitmaps.BUCKET + at + 1 for r in both for at in r["at"])
    assert got == sorted([*places, 7])
    first = maps.where("genre = 'a'").select(bitmaps.first_common("bits", "bits", "bucket", 2).alias("p"))
    assert sorted(p for r in first.collect() for p in r.p) == [1, 2, 32768 + 1, 40000, 65537]


def test_spread_deals_a_hot_key(spark):
    """One key holds two thirds of the left rows; no (key, part) keeps more than a few times the limit."""
    left = spark.range(6000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 500).alias("k"), "id")
    right = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    dealt, repeated = spread(left, right, ["k"], hot=100)
    sizes = Counter((r.k, r._part) for r in dealt.collect())
    assert max(sizes.values()) < 200 and sum(sizes.values()) == 6000
    assert max(p for _, p in sizes) == 40
    assert repeated.count() == 500 + 40
    want = sorted((i, 0 if i < 4000 else (i % 500) * 2) for i in range(6000))
    assert sorted((r.id, r.v) for r in spread_join(left, right, "k", hot=100).collect()) == want


def test_spread_join_of_null_and_empty(spark):
    left = spark.createDataFrame([(None, 1), (1, 2)], "k long, a long")
    right = spark.createDataFrame([(None, 3), (1, 4), (1, 5)], "k long, b long")
    assert sorted(map(tuple, spread_join(left, right, "k", hot=1).collect())) == [(1, 2, 4), (1, 2, 5)]
    assert spread_join(left.limit(0), right, "k").count() == 0


def test_genre_overlap_of_nulls_repeats_and_empty(spark):
    items = spark.createDataFrame(
        [(1, ["a", None]), (2, ["a"]), (2, ["a"]), (3, ["b"]), (4, None), (5, []), (6, [None])], ITEMS)
    requests = spark.createDataFrame([(10,), (11,), (None,), (12,), (13,)], "request_id long")
    owned = spark.createDataFrame([(10, 1), (11, 1), (11, 3), (11, 3), (None, 2), (12, 6), (13, 77)],
                                  "request_id long, item_id long")
    got = joins.genre_overlap_join(requests, owned, items)
    assert sorted(map(tuple, got.collect())) == [(10, 1), (10, 2), (11, 1), (11, 2), (11, 3)]
    assert joins.genre_overlap_join(requests, owned, items.limit(0)).count() == 0


def test_genre_overlap_of_one_genre_is_made_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(joins, "KEYS_TOGETHER", 4)
    items = spark.range(70_000).select(F.col("id").alias("item_id"), F.array(F.lit("a")).alias("genres"))
    requests = spark.range(9).withColumnRenamed("id", "request_id")
    owned = requests.withColumn("item_id", F.lit(5).cast("long"))
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        got = joins.genre_overlap_join(requests, owned, items).withColumn("part", F.spark_partition_id())
        seen = got.groupBy("part").agg(F.count("*").alias("n"), F.sum("item_id").alias("items")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert len(seen) > 1
    assert sum(r.n for r in seen) == 9 * 70_000 and sum(r["items"] for r in seen) == 9 * 69_999 * 35_000


def popular_by_hand(requests, seen, items, n):
    counts = Counter(i for _, i in seen)
    most = max(counts.values(), default=1)
    score = {i: round(c / most, 6) for i, c in counts.items()}
    genres = dict(items)
    out = {}
    for request, user, seed in requests:
        mine = {g for u, i in seen if u == user for g in genres.get(i, [])}
        known = any(u == user for u, _ in seen)
        asked = set(genres.get(seed, [])) if seed is not None else set()
        fits = [i for i, g in items if (not asked or asked & set(g)) and (not known or mine & set(g))]
        if not asked and not known:
            fits = []
        fits = fits or list(score)
        out[request] = sorted(fits, key=lambda i: (-score.get(i, 0.0), i))[:n]
    return out


@pytest.mark.parametrize("n", [1, 4])
def test_popular_in_genre_over_several_buckets(spark, n, monkeypatch):
    """With tiny buckets the lists need several growing ranges of places."""
    rng = random.Random(5)
    items = [(i, rng.sample("abcdefgh", rng.choice([0, 1, 1, 2]))) for i in range(60)]
    seen = [(rng.randrange(12), int(60 * rng.random() ** 2)) for _ in range(150)]
    requests = [(r, rng.choice([None, *range(14)]), rng.choice([None, *range(62)])) for r in range(60)]
    small = 8

    def key_bitmaps(tagged, key, place="place"):
        bucket = ((F.col(place) - 1) / small).cast("long") + 1
        bit = F.bitmap_bit_position((F.col(place) - 1) % small + 1)
        return tagged.groupBy(key, bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bits"))

    monkeypatch.setattr(bitmaps, "BUCKET", small)
    monkeypatch.setattr(similarity, "BUCKET", small)
    monkeypatch.setattr(similarity, "key_bitmaps", key_bitmaps)
    # Python workers read the constant of the module, so the expression takes the offset from here.
    wide = bitmaps.first_common

    def first_common(a, b, bucket, n):
        at = F.transform(wide(a, b, F.lit(1).cast("long"), n), lambda p: (p - 1) % small)
        return F.transform(at, lambda p: p + (F.col(bucket) - 1) * small + 1)

    monkeypatch.setattr(similarity, "first_common", first_common)
    found = similarity.popular_in_genre(
        spark.createDataFrame(requests, "request_id long, user_id long, seed_item_id long"),
        spark.createDataFrame(seen, "user_id long, item_id long"),
        spark.createDataFrame(items, ITEMS), n,
    )
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(r.request_id, []).append(r.item_id)
    assert got == popular_by_hand(requests, seen, items, n)
