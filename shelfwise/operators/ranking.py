"""Blending of signals, re-ranking, and the recommenders for all users at once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.blocks import _matrix, block_top_k
from shelfwise.operators.counts import merge_by_max, popularity, score_vs_seeds
from shelfwise.operators.joins import add_signal, attach_metadata, drop_seen, feature_lookup
from shelfwise.operators.ordering import (
    long_order, rounded, rounded_blend, stable_order, top_k, user_history,
)
from shelfwise.operators.similarity import (
    cold_start_fallback, similar_by_tags, similar_items, unseen_from_pool,
)
from shelfwise.session import stored


def blend(df: DataFrame, weights: Mapping[str, float], score: str = "score") -> DataFrame:
    """Weighted sum of signal columns; a missing signal is 0."""
    total: Column = F.lit(0.0)
    for signal, weight in weights.items():
        total = total + F.coalesce(F.col(signal), F.lit(0.0)) * F.lit(float(weight))
    return df.withColumn(score, rounded_blend(total))


def rank_blend(
    df: DataFrame, similarity_weight: float = 0.7, k: int = 10, per: str = "user_id"
) -> DataFrame:
    weights = {"similarity": similarity_weight, "popularity": 1.0 - similarity_weight}
    return top_k(blend(df, weights), k, per=per)


def rank_three_signals(
    df: DataFrame, content: float = 0.3, behavioral: float = 0.5, k: int = 10,
    per: str = "user_id", tie: str = "item_id",
) -> DataFrame:
    weights = {
        "content_similarity": content,
        "behavioral_similarity": behavioral,
        "popularity": 1.0 - content - behavioral,
    }
    return top_k(blend(df, weights), k, per=per, tie=tie)


@dataclass(frozen=True)
class WeightedRanker:
    """Rank stage with any {signal: weight}."""

    weights: Mapping[str, float]

    def __call__(self, df: DataFrame, k: int, per: str = "user_id") -> DataFrame:
        return top_k(blend(df, self.weights), k, per=per)


def weight_sweep(
    df: DataFrame, weights: Sequence[float] = (1.0, 0.5, 0.0), k: int = 10, per: str = "user_id"
) -> DataFrame:
    """The ranking for every similarity weight of a short list."""
    each = F.explode(F.array(*[F.lit(float(w)) for w in weights]))
    swept = df.withColumn("weight", each)
    score = F.col("weight") * F.col("similarity") + (1 - F.col("weight")) * F.col("popularity")
    return top_k(swept.withColumn("score", rounded_blend(score)), k, per=[per, "weight"])


def neighbours_of_recent(
    interactions: DataFrame, neighbours: DataFrame, recent: int
) -> DataFrame:
    """(user_id, item_id, similarity): best similarity to the user's newest items.

    ``neighbours`` (item_id, other_id, similarity) holds a short list per item;
    it is packed to one row per item, so a popular seed stays a plain lookup.
    """
    packed = neighbours.groupBy("item_id").agg(
        F.collect_list(F.struct("other_id", "similarity")).alias("_near")
    )
    seeds = user_history(interactions, recent)
    near = seeds.join(packed, "item_id").select("user_id", F.explode("_near").alias("_n"))
    return merge_by_max(
        near.select("user_id", F.col("_n.other_id").alias("item_id"), "_n.similarity")
    )


def _blend_unseen(
    candidates: DataFrame, interactions: DataFrame, weight: float, k: int
) -> DataFrame:
    fresh = drop_seen(candidates, user_history(interactions))
    scored = add_signal(fresh, popularity(interactions), "popularity")
    return rank_blend(scored, weight, k).select(
        "user_id", "item_id", "similarity", "popularity", "score", "rank"
    )


def _with_cold(
    ranked: DataFrame, users: DataFrame, interactions: DataFrame, k: int
) -> DataFrame:
    popular = top_k(popularity(interactions), k, by="popularity")
    cold = cold_start_fallback(users.select("user_id"), user_history(interactions), popular, k)
    return ranked.unionByName(cold.withColumn("score", F.lit(None).cast("double")))


def recommend_item_knn(
    users: DataFrame, interactions: DataFrame, edges: DataFrame, k: int = 10,
    similarity_weight: float = 0.7, recent: int = 10, neighbours: int = 50,
) -> DataFrame:
    """Neighbours of recent items, blended with popularity; users without history get popular."""
    mine = interactions.join(users.select("user_id"), "user_id", "left_semi")
    near = similar_items(edges, mine, neighbours)
    candidates = neighbours_of_recent(mine, near, recent)
    ranked = _blend_unseen(candidates, interactions, similarity_weight, k)
    return _with_cold(ranked, users, interactions, k)


def recommend_content(
    users: DataFrame, interactions: DataFrame, neighbours: DataFrame, k: int = 10,
    similarity_weight: float = 0.7, recent: int = 20,
) -> DataFrame:
    """As above with content neighbours (item_id, other_id, similarity) of 20 recent items."""
    mine = interactions.join(users.select("user_id"), "user_id", "left_semi")
    candidates = neighbours_of_recent(mine, neighbours, recent)
    ranked = _blend_unseen(candidates, interactions, similarity_weight, k)
    return _with_cold(ranked, users, interactions, k)


def recommend_popular_rescored(
    users: DataFrame, interactions: DataFrame, edges: DataFrame, k: int = 10,
    similarity_weight: float = 0.7, recent: int = 10, neighbours: int = 50,
) -> DataFrame:
    """A pool of the 3k most popular items, re-scored by the neighbours of recent items."""
    pool = top_k(popularity(interactions), 3 * k, by="popularity")
    mine = interactions.join(users.select("user_id"), "user_id", "left_semi")
    near = similar_items(edges, mine, neighbours)
    near = near.join(pool.select(F.col("item_id").alias("other_id")), "other_id", "left_semi")
    raised = neighbours_of_recent(mine, near, recent)
    base = unseen_from_pool(
        users.select("user_id"), pool, user_history(interactions), 3 * k,
        ["item_id", "popularity"],
    ).drop("rank")
    candidates = base.join(raised, ["user_id", "item_id"], "left").withColumn(
        "similarity", F.coalesce("similarity", F.lit(0.0))
    )
    return rank_blend(candidates, similarity_weight, k).select(
        "user_id", "item_id", "similarity", "popularity", "score", "rank"
    )


def rerank_by_seed_similarity(
    candidates: DataFrame, seeds: DataFrame, edges: DataFrame, known: DataFrame,
    items: DataFrame, agg: str = "max",
) -> DataFrame:
    scored = score_vs_seeds(candidates, seeds, edges, known, agg)
    return stable_order(attach_metadata(scored, items, ["title", "genres"]), "seed_similarity")


def recommend_popular(
    users: DataFrame, interactions: DataFrame, k: int = 10, pool: int = 1000
) -> DataFrame:
    """The most popular items a user has not seen.

    The ``pool`` most popular are one list for all. A user who has seen so many
    of them that the list may not do is served from the ranking of all items:
    the first k ranks that are missing among those of the history.
    """
    counts = popularity(interactions)
    popular = top_k(counts, pool, by="popularity")
    history = user_history(interactions)
    asked = users.select("user_id")
    in_pool = history.join(popular.select("item_id"), "item_id", "left_semi").groupBy("user_id").agg(
        F.count("*").alias("_n")
    )
    heavy = stored(in_pool.where(F.col("_n") > pool - k).select("user_id"), "heavy-users")
    fields = ["item_id", "popularity"]
    if heavy.isEmpty():
        return unseen_from_pool(asked, popular, history, k, fields)
    light = unseen_from_pool(asked.join(heavy, "user_id", "left_anti"), popular, history, k, fields)
    ranked = stored(long_order(counts, "popularity"), "popularity-ranks")
    seen = history.join(heavy, "user_id", "left_semi").join(ranked.select("item_id", "position"), "item_id")
    seen = seen.groupBy("user_id").agg(F.collect_set("position").alias("_seen"))
    reach = F.sequence(F.lit(1).cast("bigint"), F.lit(k) + F.size("_seen"))
    missing = F.slice(F.array_sort(F.array_except(reach, "_seen")), 1, k)
    places = asked.join(seen, "user_id").select("user_id", F.posexplode(missing).alias("_at", "position"))
    rest = places.join(ranked, "position").select(
        "user_id", *fields, (F.col("_at") + 1).cast("bigint").alias("rank")
    )
    return light.unionByName(rest)


def rerank_by_daypart(
    requests: DataFrame, items: DataFrame, preferred: DataFrame, k: int = 3, base: int = 10
) -> DataFrame:
    """Tag-similar items re-ordered by how many of their tags suit the request's daypart.

    ``requests`` (request_id, seed_item_id, daypart); ``preferred`` (daypart,
    tag). Matches are counted per (daypart, item) once, not per request.
    """
    near = similar_by_tags(items, base).select(
        F.col("item_id").alias("seed_item_id"), F.col("other_id").alias("item_id"),
        F.col("rank").alias("base_rank"),
    )
    tags = items.select("item_id", F.explode(F.array_distinct("tags")).alias("tag"))
    matches = tags.join(preferred, "tag").groupBy("daypart", "item_id").agg(
        F.count("*").alias("matches")
    )
    found = requests.join(near, "seed_item_id").join(matches, ["daypart", "item_id"], "left")
    found = found.withColumn("matches", F.coalesce("matches", F.lit(0)))
    return top_k(found, k, by="matches", tie="base_rank", per="request_id").select(
        "request_id", "daypart", "seed_item_id", "item_id", "matches", "base_rank", "rank"
    )


Stage = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class FourStage:
    """Retrieve, filter, score, rank: each stage is a DataFrame function.

    Requests carry ``user_id``; the result has the k best rows per request.
    """

    retrieve: Stage
    rank: Callable[[DataFrame, int], DataFrame]
    filter: Stage = field(default=lambda df: df)
    score: Stage = field(default=lambda df: df)
    score_first: bool = False

    def run(self, requests: DataFrame, k: int = 10) -> DataFrame:
        middle = (self.score, self.filter) if self.score_first else (self.filter, self.score)
        found = requests.transform(self.retrieve)
        return found.transform(middle[0]).transform(middle[1]).transform(self.rank, k)


def scored_items(ranked: DataFrame, signals: Sequence[str]) -> DataFrame:
    """The response form: string id, map of scores, per ranked row."""
    pairs = [c for s in signals for c in (F.lit(s), F.col(s))]
    return ranked.select(
        "user_id", "rank",
        F.struct(
            F.col("item_id").cast("string").alias("item_id"),
            F.create_map(*pairs).alias("score"),
            F.create_map().cast("map<string,string>").alias("metadata"),
        ).alias("item"),
    )


def linear_score(
    df: DataFrame, user: Sequence[float], item: Sequence[float], cross: Sequence[float],
    bias: float = 0.0,
) -> DataFrame:
    """Joint score that is linear in [user, item, cross] features."""
    from shelfwise.functions.vectors import dot

    def weights(values: Sequence[float]) -> Column:
        return F.array(*[F.lit(float(v)) for v in values])

    total = (
        dot("user_features", weights(user)) + dot("item_features", weights(item))
        + dot("cross_features", weights(cross)) + F.lit(float(bias))
    )
    return df.withColumn("score", rounded(total))


def joint_score(df: DataFrame, layers: Sequence[Mapping[str, np.ndarray]]) -> DataFrame:
    """Score of [user, item, cross] through given trained layers.

    Every layer but the last is linear, layer norm, ReLU; the last is linear to
    one number. Layers are mappings with ``weight``, ``bias`` and, for the
    inner ones, ``scale`` and ``shift``. The weights travel with the task.
    """
    layers = [{name: np.asarray(v, dtype=np.float64) for name, v in l.items()} for l in layers]
    shared = df.sparkSession.sparkContext.broadcast(layers)

    def run(batches):
        for batch in batches:
            parts = [_matrix(pa.chunked_array([batch.column(c)])) for c in
                     ("user_features", "item_features", "cross_features")]
            x = np.concatenate(parts, axis=1)
            *inner, last = shared.value
            for layer in inner:
                x = x @ layer["weight"].T + layer["bias"]
                centred = x - x.mean(axis=1, keepdims=True)
                x = centred / np.sqrt(x.var(axis=1, keepdims=True) + 1e-5)
                x = np.maximum(x * layer["scale"] + layer["shift"], 0.0)
            score = (x @ last["weight"].T + last["bias"]).ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column("user_id"), batch.column("item_id"), pa.array(score)],
                names=["user_id", "item_id", "score"],
            )

    wide = df.select("user_id", "item_id", "user_features", "item_features", "cross_features")
    return wide.mapInArrow(run, "user_id bigint, item_id bigint, score double")


def retrieve_and_rerank(
    users: DataFrame, index: DataFrame, user_features: DataFrame, item_features: DataFrame,
    score: Callable[[DataFrame], DataFrame], retrieval_k: int = 500, final_k: int = 50,
) -> DataFrame:
    """Vector retrieval, feature lookup, joint score, top-k.

    ``users`` (user_id, embedding); ``score`` takes user_features and
    item_features columns and adds ``score``.
    """
    found = block_top_k(users.withColumnRenamed("user_id", "query_id"), index, retrieval_k)
    pairs = found.select(F.col("query_id").alias("user_id"), "item_id")
    featured = feature_lookup(pairs, item_features).join(user_features, "user_id")
    return top_k(score(featured), final_k, per="user_id")
