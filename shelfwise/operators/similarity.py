"""Item, user, tag, text and embedding similarity, and the candidate lists built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import vectors as V
from shelfwise.functions.text import words
from shelfwise.functions.draws import draw as draw_of
from shelfwise.operators.bitmaps import BUCKET, first_common, key_bitmaps, united
from shelfwise.operators.blocks import block_top_k
from shelfwise.operators.counts import popularity, user_item_counts
from shelfwise.operators.joins import (
    HOT_GROUP, co_sums, drop_seen, merge_candidates,
)
from shelfwise.operators.ordering import (
    HALF_NUDGE, dense_ids, global_position, rounded, rounded_blend, top_k, user_history,
)
from shelfwise.operators.set_joins import nearest_sets
from shelfwise.operators.spread import HOT_ROWS, spread_join
from shelfwise.operators.top_products import top_products
from shelfwise.session import stored

# Common English function words, used when no stop list is given.
STOP_WORDS = (
    "a an and are as at be been but by for from had has have he her his i if in into is it its "
    "me my no not of on or our she so such that the their them then there these they this to "
    "was we were which will with you your"
).split()


def mirror(pairs: DataFrame, value: Column, name: str) -> DataFrame:
    """Both directions of (a, b) as (item_id, other_id, <name>)."""
    both = F.explode(
        F.array(
            F.struct(F.col("a").alias("item_id"), F.col("b").alias("other_id")),
            F.struct(F.col("b").alias("item_id"), F.col("a").alias("other_id")),
        )
    )
    return pairs.select(both.alias("_e"), value.alias(name)).select("_e.*", name)


def unit_counts(interactions: DataFrame, min_support: int = 1) -> DataFrame:
    """(user_id, item_id, w): the columns of the count matrix at unit length.

    ``min_support`` leaves out items with fewer interactions. Dividing by the
    norms here touches every row once, not every pair twice.
    """
    counts = user_item_counts(interactions)
    norms = counts.groupBy("item_id").agg(
        F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("_norm"), F.sum("n").alias("_support")
    )
    if min_support > 1:
        norms = norms.where(F.col("_support") >= min_support)
    return counts.join(norms, "item_id").select(
        "user_id", "item_id", (F.col("n") / F.col("_norm")).alias("w")
    )


def item_cosine(
    interactions: DataFrame,
    min_support: int = 1,
    hot: int = HOT_GROUP,
) -> DataFrame:
    """Cosine between the item columns of the count matrix as (item_id, other_id, similarity).

    Every pair of items of a user; ``nearest_items`` is the way to the k best
    of each item. Users with many items are split, see ``co_sums``.
    """
    pairs = co_sums(unit_counts(interactions, min_support), "user_id", "item_id", "w", hot)
    return mirror(pairs, rounded_blend(F.col("weight")), "similarity")


def nearest_items(interactions: DataFrame, k: int, min_support: int = 1) -> DataFrame:
    """The k items of the highest cosine for every item, by bounds instead of all pairs."""
    rows = unit_counts(interactions, min_support).select(
        F.col("item_id").alias("member"), F.col("user_id").alias("column"), F.col("w").alias("weight")
    )
    return top_products(rows, k, "columns", nudge=HALF_NUDGE).select(
        F.col("member").alias("item_id"), F.col("other").alias("other_id"),
        F.col("score").alias("similarity"), "rank",
    )


def similar_items(edges: DataFrame, seeds: DataFrame | None, k: int = 100) -> DataFrame:
    """The k nearest items of every distinct seed, or of every item without ``seeds``.

    An unknown seed has none. Without seeds each task keeps its k best edges
    per item before the shuffle.
    """
    near = edges.where(F.col("similarity") > 0)
    if seeds is not None:
        near = near.join(seeds.select("item_id").distinct(), "item_id", "left_semi")
    return top_k(near, k, by="similarity", tie="other_id", per="item_id")


def _largest_dots(counts: DataFrame, member: str, column: str, other: str, k: int) -> DataFrame:
    rows = counts.select(F.col(member).alias("member"), F.col(column).alias("column"), F.col("n").alias("weight"))
    return top_products(rows, k, digits=None).select(
        F.col("member").alias(member), F.col("other").alias(other), F.col("score").cast("bigint").alias("dot"), "rank"
    )


def similar_items_dot(counts: DataFrame, k: int = 3) -> DataFrame:
    """The k items with the highest dot product of count vectors (counts above 0)."""
    return _largest_dots(counts, "item_id", "user_id", "other_id", k)


def similar_users(counts: DataFrame, k: int = 3) -> DataFrame:
    """The k users with the highest dot product of count vectors (counts above 0)."""
    return _largest_dots(counts, "user_id", "item_id", "other_user", k)


def recommend_from_neighbors(counts: DataFrame, neighbours: DataFrame, k: int = 3) -> DataFrame:
    """Votes = similar users that hold an item the user lacks."""
    held = counts.select(F.col("user_id").alias("other_user"), "item_id")
    votes = (
        spread_join(stored(neighbours.select("user_id", "other_user"), "neighbours"), held, "other_user")
        .groupBy("user_id", "item_id").agg(F.count("*").alias("votes"))
    )
    unseen = drop_seen(votes, counts.select("user_id", "item_id"))
    return top_k(unseen, k, by="votes", per="user_id")


def tag_sets(items: DataFrame) -> DataFrame:
    """Distinct tag sets: (tag_set, tags, items). Items with equal tags are one row."""
    tags = F.sort_array(F.array_distinct(F.coalesce("tags", F.array().cast("array<string>"))))
    return (
        items.groupBy(tags.alias("tags")).agg(F.count("*").alias("items"))
        .select(F.array_join("tags", "|").alias("tag_set"), "tags", "items")
    )


def tag_overlaps(sets: DataFrame, hot: int = HOT_GROUP) -> DataFrame:
    """Jaccard of every two tag sets that share a tag, itself included; other pairs are 0.

    |A and B| is a count over the shared tags, |A or B| follows from the sizes,
    and both work on distinct sets, however many items carry them.
    """
    sized = sets.select("tag_set", F.size("tags").alias("size"), F.explode("tags").alias("tag"))
    ones = sized.select("tag", "tag_set", F.lit(1).alias("one"))
    shared = co_sums(ones, "tag", "tag_set", "one", hot)
    size = sets.select("tag_set", F.size("tags").alias("size"))
    a = size.select(F.col("tag_set").alias("a"), F.col("size").alias("_sa"))
    b = size.select(F.col("tag_set").alias("b"), F.col("size").alias("_sb"))
    union = F.col("_sa") + F.col("_sb") - F.col("weight")
    pairs = shared.join(a, "a").join(b, "b")
    both = mirror(pairs, rounded(F.col("weight") / union), "similarity").withColumnsRenamed(
        {"item_id": "tag_set", "other_id": "other_set"}
    )
    itself = size.where(F.col("size") > 0).select(
        "tag_set", F.col("tag_set").alias("other_set"), F.lit(1.0).alias("similarity")
    )
    return both.unionByName(itself)


def similar_by_tags(items: DataFrame, k: int, hot: int = HOT_ROWS) -> DataFrame:
    """Jaccard top-k of every item, itself left out, zero overlap left out; null tags are none.

    All items of a tag set share one candidate list. Its k + 1 best items are
    enough for each of them, so only the k + 1 lowest ids of a set are needed.
    The list is one ordered array per set, so an item takes its k from it
    without a ranking of its own. Item ids are unique.
    """
    no_tags = F.array().cast("array<string>")
    tags = F.sort_array(F.array_distinct(F.array_compact(F.coalesce("tags", no_tags))))
    keyed = stored(items.select("item_id", tags.alias("tags")).where(F.size("tags") > 0), "tagged-items")
    sets = keyed.groupBy("tags").agg(F.min("item_id").alias("low"), F.count("*").alias("items"))
    near = nearest_sets(sets, k + 1, hot)
    low_ids = top_k(keyed, k + 1, by="item_id", tie="item_id", per="tags", ascending=True)
    low_ids = low_ids.select(F.col("tags").alias("other"), F.col("item_id").alias("other_id"))
    lists = top_k(near.join(low_ids, "other"), k + 1, by="similarity", tie="other_id", per="tags")
    packed = lists.groupBy("tags").agg(
        F.sort_array(F.collect_list(F.struct("rank", "other_id", "similarity"))).alias("_list")
    )
    own = spread_join(keyed, packed, "tags", hot, hint="merge")
    others = F.filter("_list", lambda o: o["other_id"] != F.col("item_id"))
    return own.select("item_id", F.posexplode(F.slice(others, 1, k)).alias("_at", "_o")).select(
        "item_id", "_o.other_id", "_o.similarity", (F.col("_at") + 1).cast("bigint").alias("rank")
    )


def similar_by_embedding(vectors: DataFrame, seeds: DataFrame, k: int = 2) -> DataFrame:
    """Cosine top-k of every seed that has a vector, itself left out."""
    unit = vectors.select("item_id", V.l2_normalize("embedding").alias("embedding"))
    wanted = seeds.select("item_id").distinct()
    queries = unit.join(wanted, "item_id", "left_semi").withColumnRenamed("item_id", "query_id")
    found = block_top_k(queries, unit, k, skip_self=True)
    return found.select(
        F.col("query_id").alias("item_id"), F.col("item_id").alias("other_id"),
        F.col("score").alias("similarity"), "rank",
    )


def user_profiles(history: DataFrame, vectors: DataFrame) -> DataFrame:
    """Mean vector of each user's items, as (user_id, embedding)."""
    owned = history.select("user_id", "item_id").distinct().join(
        vectors.select("item_id", "embedding"), "item_id"
    )
    return V.mean_vectors(owned, "user_id", dim=V.vector_dim(vectors))


def recommend_from_profile(history: DataFrame, vectors: DataFrame, k: int = 2) -> DataFrame:
    """Cosine of the user's mean vector to all items the user does not have."""
    owned = history.select("user_id", "item_id").distinct()
    profiles = stored(user_profiles(owned, vectors), "profiles").select(
        F.col("user_id").alias("query_id"), V.l2_normalize("embedding").alias("embedding")
    )
    unit = vectors.select("item_id", V.l2_normalize("embedding").alias("embedding"))
    seen = owned.withColumnRenamed("user_id", "query_id")
    found = block_top_k(profiles, unit, k, exclude=seen)
    return found.withColumnsRenamed({"query_id": "user_id", "score": "similarity"})


def term_stats(docs: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    """(term, total, df) over whole texts, without stop words.

    A text adds every word to the total and every distinct word to df, in one
    pass, so only per-task sums of terms are shuffled. Stop words are taken out
    of the few terms, not of the many words.
    """
    terms = docs.select(words("text").alias("w"))
    each = F.transform("w", lambda t: F.struct(t.alias("term"), F.lit(1).alias("n"), F.lit(0).alias("d")))
    once = F.transform(
        F.array_distinct("w"),
        lambda t: F.struct(t.alias("term"), F.lit(0).alias("n"), F.lit(1).alias("d")),
    )
    cells = terms.select(F.explode(F.concat(each, once)).alias("c")).select("c.*")
    sums = cells.groupBy("term").agg(F.sum("n").alias("total"), F.sum("d").alias("df"))
    return sums.where(~F.col("term").isin(list(stop_words))) if stop_words else sums


def tfidf_vocabulary(
    docs: DataFrame, max_terms: int = 500, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """The most frequent terms with their index (by term) and smooth idf."""
    kept = top_k(term_stats(docs, stop_words), max_terms, by="total", tie="term")
    n = docs.agg(F.count("*")).scalar()
    idf = F.log((1 + n) / (1 + F.col("df"))) + 1
    place = (F.row_number().over(Window.orderBy("term")) - 1).cast("bigint")
    return kept.select("term", "df", idf.alias("idf"), place.alias("term_id"))


def tfidf_fit(
    docs: DataFrame, max_terms: int = 500, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """L2-normalised TF-IDF postings (item_id, term, term_id, idf, weight).

    Words outside the vocabulary are dropped by a lookup before anything is
    shuffled; an item then has at most ``max_terms`` rows.
    """
    vocabulary = F.broadcast(tfidf_vocabulary(docs, max_terms, stop_words))
    terms = docs.select("item_id", F.explode(words("text")).alias("term"))
    counts = terms.join(vocabulary, "term").groupBy("item_id", "term", "term_id", "idf").agg(
        F.count("*").alias("tf")
    )
    raw = counts.withColumn("raw", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("item_id")))
    return raw.select("item_id", "term", "term_id", "idf", (F.col("raw") / length).alias("weight"))


def top_idf_terms(postings: DataFrame, n: int = 10) -> DataFrame:
    terms = postings.groupBy("term").agg(rounded(F.max("idf")).alias("idf"))
    return top_k(terms, n, by="idf", tie="term")


def similar_by_content(postings: DataFrame, seeds: DataFrame, k: int = 100) -> DataFrame:
    """TF-IDF cosine top-k of every seed: (item_id, other_id, similarity, rank).

    Texts are packed as inverted lists with the largest weight per term; a text
    meets a block of others only if these weights let it into its k best.
    """
    rows = postings.select(
        F.col("item_id").alias("member"), F.col("term_id").alias("column"), "weight"
    )
    wanted = seeds.select(F.col("item_id").alias("member"))
    return top_products(rows, k, "columns", wanted=wanted).select(
        F.col("member").alias("item_id"), F.col("other").alias("other_id"),
        F.col("score").alias("similarity"), "rank",
    )


def pool_list(pool: DataFrame, fields: Sequence[str]) -> Column:
    """A short ranked list (its length is a parameter) as one array value."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", *fields)))
    return pool.agg(ranked).scalar()


def unseen_from_pool(
    users: DataFrame, pool: DataFrame, history: DataFrame, k: int, fields: Sequence[str]
) -> DataFrame:
    """The first k pool entries each user has not seen, in pool order.

    The pool is one short list; a user's seen pool items are at most as many,
    so every user needs one row and no user x pool product is built.
    """
    seen = (
        history.join(pool.select("item_id"), "item_id", "left_semi")
        .groupBy("user_id").agg(F.collect_set("item_id").alias("_seen"))
    )
    none = F.array().cast("array<bigint>")
    rows = users.join(seen, "user_id", "left").withColumn("_seen", F.coalesce("_seen", none))
    listed = rows.withColumn("_pool", pool_list(pool, fields))
    fresh = F.filter(
        F.slice("_pool", 1, F.lit(k) + F.size("_seen")),
        lambda p: ~F.array_contains(F.col("_seen"), p["item_id"]),
    )
    picked = listed.select(*users.columns, F.posexplode(F.slice(fresh, 1, k)).alias("_at", "_p"))
    return picked.select(
        *users.columns, *[F.col(f"_p.{f}").alias(f) for f in fields],
        (F.col("_at") + 1).cast("bigint").alias("rank"),
    )


def popular_in_genre(
    requests: DataFrame, interactions: DataFrame, items: DataFrame, n: int = 1000
) -> DataFrame:
    """Popular items of the seed's genres and of the genres the user knows.

    Both given: items in both sets; one given: that one; nothing left: all
    rated items. Ordered by popularity, unrated items count 0.

    Items are numbered in that order and the items of a genre are bitmaps over
    these places, so the first n common bits of a profile's two unions are its
    list. Profiles (distinct pairs of genre sets) read the buckets of places in
    growing ranges and end as soon as they have n items. Requests with the same
    profile share one list.
    """
    ids = items.select("item_id").distinct()
    scores = stored(popularity(interactions), "popularity")
    scored = ids.join(scores, "item_id", "left").withColumn("popularity", F.coalesce("popularity", F.lit(0.0)))
    ranked = stored(
        global_position(scored, [F.col("popularity").desc(), F.col("item_id").asc()], "place"), "popular-places"
    )
    tagged = items.select("item_id", F.explode(F.array_distinct("genres")).alias("genre"))
    genres = stored(tagged.groupBy("item_id").agg(F.collect_set("genre").alias("genres")), "item-genres")
    maps = stored(key_bitmaps(tagged.join(ranked, "item_id"), "genre"), "popular-bitmaps")

    none = F.array().cast("array<string>")
    requests = stored(requests, "requests")
    seeds = requests.where(F.col("seed_item_id").isNotNull()).select("request_id", "seed_item_id")
    seed = spread_join(seeds, genres.withColumnRenamed("item_id", "seed_item_id"), "seed_item_id").select(
        "request_id", F.sort_array("genres").alias("seed_genres")
    )
    history = stored(user_history(interactions), "history")
    owned = spread_join(history, genres, "item_id").select(
        "user_id", F.explode("genres").alias("genre")
    ).groupBy("user_id").agg(F.sort_array(F.collect_set("genre")).alias("user_genres"))
    known = history.select("user_id").distinct().withColumn("has_history", F.lit(True))
    owned = known.join(owned, "user_id", "left").withColumn("user_genres", F.coalesce("user_genres", none))
    s, u = F.col("seed_genres"), F.col("user_genres")
    one, other = F.coalesce(s, u, none), F.coalesce(u, s, none)
    profiled = stored(
        requests.join(seed, "request_id", "left").join(owned, "user_id", "left")
        .select(*requests.columns, one.alias("one"), other.alias("other")),
        "profiles",
    )
    lists = _first_of_profiles(profiled.select("one", "other").distinct(), maps, ranked, n)
    listed = lists.join(ranked, "place").groupBy("one", "other").agg(
        F.sort_array(F.collect_list(F.struct("rank", "item_id", "popularity"))).alias("_list")
    )
    listed = stored(listed, "profile-lists")
    direct = spread_join(profiled, listed, ["one", "other"])
    empty = profiled.join(listed, ["one", "other"], "left_anti")
    everything = top_k(scores, n, by="popularity")
    fallback = empty.withColumn("_list", pool_list(everything, ["item_id", "popularity"]))
    return direct.unionByName(fallback).select("*", F.explode("_list").alias("_p")).select(
        *requests.columns, "_p.item_id", "_p.popularity", F.col("_p.rank").cast("bigint").alias("rank")
    )


def _first_of_profiles(profiles: DataFrame, maps: DataFrame, ranked: DataFrame, n: int) -> DataFrame:
    """(one, other, place, rank): the first n places with a genre of both sets of each profile."""
    last = ranked.agg(F.coalesce(F.max("place"), F.lit(0))).first()[0]
    buckets = -(-last // BUCKET)
    todo, found, low, done = profiles.withColumn("_have", F.array().cast("array<bigint>")), [], 1, False
    while not done:
        high = 2 * low - 1
        near = maps.where(F.col("bucket").between(low, high))
        sets = todo.select(F.explode(F.array("one", "other")).alias("set")).distinct()
        bits = stored(united(sets, near, "set", "genre"), "profile-bits")
        a = bits.select(F.col("set").alias("one"), "bucket", F.col("bits").alias("_a"))
        b = bits.select(F.col("set").alias("other"), "bucket", F.col("bits").alias("_b"))
        both = spread_join(spread_join(todo.select("one", "other"), a, "one"), b, ["other", "bucket"])
        places = both.select("one", "other", first_common("_a", "_b", "bucket", n).alias("_p"))
        new = places.groupBy("one", "other").agg(F.flatten(F.collect_list("_p")).alias("_new"))
        taken = F.concat("_have", F.coalesce("_new", F.array().cast("array<bigint>")))
        visited = stored(
            todo.join(new, ["one", "other"], "left")
            .select("one", "other", F.slice(F.sort_array(taken), 1, n).alias("_have")),
            "profile-places",
        )
        done = high >= buckets
        found.append(visited if done else visited.where(F.size("_have") >= n))
        todo, low = visited.where(F.size("_have") < n), high + 1
    lists = found[0]
    for more in found[1:]:
        lists = lists.unionByName(more)
    return lists.select("one", "other", F.posexplode("_have").alias("_at", "place")).select(
        "one", "other", "place", (F.col("_at") + 1).cast("bigint").alias("rank")
    )


def hybrid_candidates(content: DataFrame, behaviour: DataFrame, k: int = 100) -> DataFrame:
    """Half from content, half from behaviour, merged per (item_id, other_id).

    Both inputs are ranked lists (item_id, other_id, similarity, rank).
    """
    half = k // 2
    a = content.where(F.col("rank") <= half).select(
        "item_id", "other_id", F.col("similarity").alias("content_similarity")
    )
    b = behaviour.where(F.col("rank") <= half).select(
        "item_id", "other_id", F.col("similarity").alias("behavioral_similarity")
    )
    return merge_candidates(
        a, b, ["item_id", "other_id"], ["content_similarity", "behavioral_similarity"]
    )


def routed_candidates(
    requests: DataFrame, edges: DataFrame, served: DataFrame, popular: DataFrame, k: int = 100
) -> DataFrame:
    """A seed item asks for similar items, else a user for the served list, else popular.

    ``edges`` (item_id, other_id, similarity), ``served`` (user_id, item_id,
    score), ``popular`` (item_id, popularity, rank).
    """
    by_seed = requests.where(F.col("seed_item_id").isNotNull())
    by_user = requests.where(F.col("seed_item_id").isNull() & F.col("user_id").isNotNull())
    by_none = requests.where(F.col("seed_item_id").isNull() & F.col("user_id").isNull())
    near = top_k(edges, k, by="similarity", tie="other_id", per="item_id")
    a = spread_join(by_seed, near.withColumnRenamed("item_id", "seed_item_id"), "seed_item_id").select(
        "request_id", F.lit("similar").alias("route"), F.col("other_id").alias("item_id"),
        F.col("similarity").alias("score"), "rank",
    )
    own = top_k(served, k, by="score", per="user_id")
    b = by_user.join(own, "user_id").select(
        "request_id", F.lit("user").alias("route"), "item_id", "score", "rank"
    )
    pool = popular.where(F.col("rank") <= k)
    c = by_none.select(
        "request_id", F.explode(pool_list(pool, ["item_id", "popularity"])).alias("_p")
    ).select(
        "request_id", F.lit("popular").alias("route"), "_p.item_id",
        F.col("_p.popularity").alias("score"), F.col("_p.rank").alias("rank"),
    )
    return a.unionByName(b).unionByName(c)


def random_items(requests: DataFrame, items: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """k distinct items per request, every k-subset equally likely, repeatable by seed.

    Floyd's sampling over the dense item index: draw from a range that grows by
    one per step and take the new end when the draw was taken before. The draws
    follow from (request, step, seed), so there are fewer than 2^31 items; only
    the k hits are joined to items. Both sides of that join grow with the
    tables, and neither size is known to Spark, so it is a sort-merge join.
    """
    index = dense_ids(items, "item_id")
    n = F.col("_n")
    step_of = F.sequence(F.greatest(n - k, F.lit(0)), n - 1)

    def draw(taken: Column, end: Column) -> Column:
        at = F.array(draw_of(F.col("_seed"), end) % (end + 1))
        return F.concat(taken, F.transform(at, lambda x: F.when(F.array_contains(taken, x), end).otherwise(x)))

    none = F.array().cast("array<bigint>")
    # A set number of parts, as few scan tasks would draw for all requests.
    parts = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = requests.select("request_id").repartition(parts).select(
        "request_id", draw_of(seed, "request_id").alias("_seed"), index.agg(F.count("*")).scalar().alias("_n")
    )
    places = drawn.where(n > 0).select(
        "request_id", F.posexplode(F.aggregate(step_of, none, draw)).alias("_at", "dense_id")
    )
    return places.hint("merge").join(index, "dense_id").select(
        "request_id", "item_id", (F.col("_at") + 1).cast("bigint").alias("rank")
    )


def cold_start_fallback(
    requests: DataFrame, history: DataFrame, popular: DataFrame, k: int
) -> DataFrame:
    """Users without history get the k most popular items, without similarity."""
    cold = requests.join(history.select("user_id").distinct(), "user_id", "left_anti")
    pool = pool_list(popular.where(F.col("rank") <= k), ["item_id", "popularity"])
    return cold.select("*", F.explode(pool).alias("_p")).select(
        *requests.columns, "_p.item_id", F.lit(None).cast("double").alias("similarity"),
        "_p.popularity", F.col("_p.rank").alias("rank"),
    )
