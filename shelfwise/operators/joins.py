"""Metadata, history, pool, basket and time-range joins.

Broadcast is hinted only for one-row aggregates and for lists whose length the
caller fixes; everything else is left to the optimizer, which measures sizes at
run time and falls back to a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.bitmaps import key_bitmaps, members, united
from shelfwise.operators.blocks import block_products
from shelfwise.operators.ordering import dense_ids, top_k
from shelfwise.operators.spread import spread_join
from shelfwise.session import stored

HOT_GROUP = 4096
DENSE_GROUP = 256
# Requests in one array of the genre join; an array of items holds those of a bucket of places.
KEYS_TOGETHER = 4096


def one_row_per_item(items: DataFrame) -> DataFrame:
    """Of duplicate items keep the one with the lowest title (nulls last)."""
    first = Window.partitionBy("item_id").orderBy(F.col("title").asc_nulls_last())
    return items.withColumn("_n", F.row_number().over(first)).where(F.col("_n") == 1).drop("_n")


def attach_metadata(df: DataFrame, items: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.join(one_row_per_item(items).select("item_id", *cols), "item_id", "left")


def top_items_with_titles(counts: DataFrame, items: DataFrame, n: int = 20) -> DataFrame:
    top = top_k(counts, n, by="interactions")
    return one_row_per_item(items).select("item_id", "title").join(F.broadcast(top), "item_id")


def drop_seen(candidates: DataFrame, history: DataFrame) -> DataFrame:
    return candidates.join(history, ["user_id", "item_id"], "left_anti")


def restrict_to_pool(candidates: DataFrame, pool: DataFrame) -> DataFrame:
    return candidates.join(pool.select("item_id"), "item_id", "left_semi")


def merge_candidates(
    a: DataFrame, b: DataFrame, keys: Sequence[str], signals: Sequence[str]
) -> DataFrame:
    """Full outer merge of two candidate lists; a missing signal is 0."""
    merged = a.join(b, list(keys), "full_outer")
    return merged.select(*keys, *[F.coalesce(s, F.lit(0.0)).alias(s) for s in signals])


def add_signal(
    candidates: DataFrame, scores: DataFrame, signal: str, default: float = 0.0
) -> DataFrame:
    known = candidates.join(scores.select("item_id", signal), "item_id", "left")
    return known.withColumn(signal, F.coalesce(signal, F.lit(default)))


def genre_overlap_join(
    requests: DataFrame, owned: DataFrame, items: DataFrame, key: str = "request_id"
) -> DataFrame:
    """Distinct (key, item) where the item shares a genre with any item the key owns.

    Items of a genre are bitmaps, and the bitmaps are united once per distinct
    set of wanted genres, not per request. The result has a row per request and
    item and so grows with both; it is written from pairs of one array of
    requests and one array of items with the same wanted genres. These pairs
    are few and of bounded size and are dealt evenly over tasks, so no task
    makes the rows of a whole set. Null genres and null keys match nothing.
    """
    index = stored(dense_ids(items, "item_id", "place").withColumn("place", F.col("place") + 1), "places")
    tagged = items.select("item_id", F.explode("genres").alias("genre"))
    maps = stored(key_bitmaps(tagged.join(index, "item_id"), "genre"), "genre-bitmaps")
    genres = tagged.groupBy("item_id").agg(F.collect_set("genre").alias("genres"))
    owning = stored(
        requests.select(key).where(F.col(key).isNotNull()).join(owned.select(key, "item_id"), key), "owning"
    )
    wanted = stored(
        spread_join(owning, genres, "item_id").select(key, F.explode("genres").alias("genre"))
        .groupBy(key).agg(F.sort_array(F.collect_set("genre")).alias("wanted")),
        "wanted-genres",
    )
    ids = index.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.sort_array(F.collect_list(F.struct("place", "item_id")))["item_id"].alias("ids")
    )
    sizes = wanted.groupBy("wanted").agg(F.ceil(F.count("*") / KEYS_TOGETHER).alias("_pieces"))
    sets = united(sizes.select("wanted"), maps, "wanted", "genre")
    found = sets.join(ids, "bucket").select("wanted", members("bits").alias("_at"), "ids").select(
        "wanted", F.transform("_at", lambda at: F.get("ids", at)).alias("_items")
    )
    asking = spread_join(wanted, sizes, "wanted").groupBy(
        "wanted", F.pmod(F.xxhash64(key), "_pieces").alias("_piece")
    ).agg(F.collect_list(key).alias("_keys"))
    # A set number of parts: by their bytes, Spark would give all pairs to a few tasks.
    parts = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = asking.hint("merge").join(found, "wanted").select("_keys", "_items").repartition(parts)
    return pairs.select(F.explode("_keys").alias(key), "_items").select(key, F.explode("_items").alias("item_id"))


def co_sums(
    rows: DataFrame, group: str, member: str, weight: str, hot: int = HOT_GROUP,
    dense: int = DENSE_GROUP,
) -> DataFrame:
    """Per unordered pair a < b: sum over shared groups of the product of weights.

    ``rows`` has one row per (group, member) and is stored first, as it is read
    several times. Pairs are added up in the stage that makes them, so only
    partial sums are shuffled. Groups differ in size by far, so there are three
    exact ways, and a group takes one of them:

    * a small group is joined with itself;
    * a group of more than ``hot`` rows is split: one side is spread over
      ``ceil(rows / hot)`` parts, the other is repeated once per part;
    * a group with over ``dense`` rows and over 1 % of all members shares most
      of its pairs with other such groups: these are multiplied as matrices,
      which makes every pair once per block of groups and not once per group.
    """
    rows = stored(rows.select(group, member, weight), "pair-rows")
    wide = F.greatest(
        rows.agg(F.ceil(F.approx_count_distinct(member) / 100)).scalar(), F.lit(dense)
    )
    sizes = rows.groupBy(group).agg(F.count("*").alias("_rows"))
    sizes = sizes.where(F.col("_rows") > min(hot, dense)).withColumn("_dense", F.col("_rows") > wide)
    sizes = sizes.where(F.col("_dense") | (F.col("_rows") > hot)).select(
        group, "_dense", F.ceil(F.col("_rows") / hot).cast("int").alias("_parts")
    )
    a = rows.select(group, F.col(member).alias("a"), F.col(weight).alias("_wa"))
    b = rows.select(group, F.col(member).alias("b"), F.col(weight).alias("_wb"))
    plain = a.join(sizes.select(group), group, "left_anti").join(b, group)

    parted = sizes.where(~F.col("_dense")).drop("_dense")
    part = F.pmod(F.xxhash64("a"), F.col("_parts")).cast("int")
    spread = a.join(parted, group).withColumn("_part", part).drop("_parts")
    every = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    repeated = b.join(parted, group).withColumn("_part", every).drop("_parts")
    split = spread.join(repeated, [group, "_part"]).drop("_part")

    joined = plain.unionByName(split).where(F.col("a") < F.col("b"))
    products = joined.select("a", "b", (F.col("_wa") * F.col("_wb")).cast("double").alias("_p"))
    kept = rows.join(sizes.where("_dense").select(group), group, "left_semi")
    blocks = block_products(
        kept.select(F.col(group).alias("column"), F.col(member).alias("member"),
                    F.col(weight).alias("weight"))
    )
    weighed = products.unionByName(blocks.withColumnRenamed("product", "_p"))
    return weighed.groupBy("a", "b").agg(F.sum("_p").alias("weight"))


def co_pairs(baskets: DataFrame, hot: int = HOT_GROUP) -> DataFrame:
    """(item_a <= item_b, pair_count) over baskets with repeats.

    Repeats are counted before pairing: distinct items give the product of
    their counts, an item with itself gives n(n-1)/2.
    """
    counted = baskets.groupBy("basket_id", "item_id").agg(F.count("*").alias("n"))
    pair_count = F.col("weight").cast("bigint").alias("pair_count")
    distinct_pairs = co_sums(counted, "basket_id", "item_id", "n", hot).select(
        F.col("a").alias("item_a"), F.col("b").alias("item_b"), pair_count
    )
    twice = (F.col("n") * (F.col("n") - 1) / 2).cast("bigint")
    own_pairs = (
        counted.where(F.col("n") > 1)
        .groupBy(F.col("item_id").alias("item_a"), F.col("item_id").alias("item_b"))
        .agg(F.sum(twice).alias("pair_count"))
    )
    return distinct_pairs.unionByName(own_pairs)


def co_matrix(pairs: DataFrame) -> DataFrame:
    """The symmetric long form; an absent cell is 0."""
    mirrored = pairs.where(F.col("item_a") != F.col("item_b")).select(
        F.col("item_b").alias("item_a"), F.col("item_a").alias("item_b"), "pair_count"
    )
    return pairs.unionByName(mirrored)


def co_matrix_wide(pairs: DataFrame, items: Sequence[int]) -> DataFrame:
    """Display form for a given short list of items."""
    wide = co_matrix(pairs).groupBy("item_a").pivot("item_b", list(items)).sum("pair_count")
    return wide.where(F.col("item_a").isin(list(items))).na.fill(0)


def future_events(anchors: DataFrame, events: DataFrame, hours: int = 24) -> DataFrame:
    """Events of the same user in (t, t + hours].

    Both sides carry a time slice of a quarter of the horizon, so that a busy
    user's events meet in many small groups and not in one.
    """
    slice_us = hours * 3_600_000_000 // 4
    ahead = hours * 3_600_000_000
    a = anchors.select("user_id", "anchor_id", F.col("anchor_us")).withColumn(
        "_slice",
        F.explode(
            F.sequence(
                F.floor(F.col("anchor_us") / slice_us),
                F.floor((F.col("anchor_us") + ahead) / slice_us),
            )
        ),
    )
    b = events.withColumn("_slice", F.floor(F.col("event_us") / slice_us))
    gap = F.col("event_us") - F.col("anchor_us")
    return (
        a.join(b, ["user_id", "_slice"])
        .where((F.col("event_us") > F.col("anchor_us")) & (gap <= ahead))
        .withColumn("hours_ahead", gap / F.lit(3.6e9))
        .drop("_slice")
    )


def feature_lookup(candidates: DataFrame, features: DataFrame) -> DataFrame:
    """Candidates with their item features; without features they are dropped."""
    return candidates.join(features, "item_id")


def query_vector_for_item(requests: DataFrame, vectors: DataFrame) -> DataFrame:
    seeds = vectors.select(F.col("item_id").alias("seed_item_id"), "embedding")
    return requests.where(F.col("seed_item_id").isNotNull()).join(seeds, "seed_item_id")
