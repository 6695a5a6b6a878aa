"""Queries of the blending, re-ranking and whole recommenders."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.vectors import feature_cross
from shelfwise.operators import counts, ranking, similarity
from shelfwise.operators.joins import add_signal, drop_seen
from shelfwise.operators.ordering import user_history
from shelfwise.plans.analytics import POPULAR_SQL, SEEDS_SQL, popular_lists, seed_candidates
from shelfwise.plans.candidates import HYBRID_SQL, hybrid_lists
from shelfwise.plans.catalog import query
from shelfwise.plans.columns import ITEM_MATRIX, USER_MATRIX, _project_sql
from shelfwise.plans.joins import RECENT_SQL
from shelfwise.plans.views import Views


def scored_candidates(v: Views) -> DataFrame:
    """(user_id, item_id, similarity, popularity), seen items included."""
    near = similarity.similar_items(v.edges, None, 50)
    candidates = ranking.neighbours_of_recent(v.interactions, near, 10)
    return add_signal(candidates, v.popularity, "popularity")


# Candidates with their popularity, before and after dropping seen items.
SCORED_SQL = RECENT_SQL.format(n=10) + """,
    v_scored AS (SELECT c.*, coalesce(p.popularity, 0.0) AS popularity
      FROM v_cand c LEFT JOIN v_popularity p USING (item_id)),
    v_fresh AS (SELECT s.* FROM v_scored s ANTI JOIN v_history h
      ON h.user_id = s.user_id AND h.item_id = s.item_id)"""
D7, D3 = "CAST(0.7 AS DOUBLE)", "(1 - CAST(0.7 AS DOUBLE))"


def blend_sql(source: str, w: str = D7, v: str = D3, k: int = 10) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
      FROM (SELECT *, round({w} * similarity + {v} * popularity + 1e-9, 6) AS score FROM {source})
      QUALIFY rank <= {k}"""


@query("g01_rank_blend", f"WITH {SCORED_SQL} {blend_sql('v_scored')}")
def blended(v: Views) -> DataFrame:
    return ranking.rank_blend(scored_candidates(v), 0.7, 10)


@query(
    "g02_rank_three_signals",
    f"""WITH {HYBRID_SQL} SELECT item_id, other_id, score, row_number() OVER
          (PARTITION BY item_id ORDER BY score DESC, other_id) AS rank FROM (
          SELECT h.item_id, h.other_id, round(CAST(0.3 AS DOUBLE) * content_similarity
            + CAST(0.5 AS DOUBLE) * behavioral_similarity
            + (1 - CAST(0.3 AS DOUBLE) - CAST(0.5 AS DOUBLE)) * coalesce(popularity, 0.0)
            + 1e-9, 6) AS score
          FROM v_hybrid h LEFT JOIN v_popularity p ON p.item_id = h.other_id)
        QUALIFY rank <= 10""",
)
def three_signals(v: Views) -> DataFrame:
    scores = v.popularity.withColumnRenamed("item_id", "other_id")
    candidates = hybrid_lists(v).join(scores, "other_id", "left")
    ranked = ranking.rank_three_signals(candidates, 0.3, 0.5, 10, per="item_id", tie="other_id")
    return ranked.select("item_id", "other_id", "score", "rank")


@query(
    "g03_weighted_ranker",
    f"WITH {SCORED_SQL} {blend_sql('v_scored', 'CAST(0.25 AS DOUBLE)', 'CAST(0.75 AS DOUBLE)', 5)}",
)
def weighted(v: Views) -> DataFrame:
    ranker = ranking.WeightedRanker({"similarity": 0.25, "popularity": 0.75})
    return ranker(scored_candidates(v), 5)


@query(
    "g04_weight_sweep",
    f"""WITH {SCORED_SQL}, v_w AS (SELECT s.*, w.weight, round(weight * similarity
          + (1 - weight) * popularity + 1e-9, 6) AS score FROM v_scored s CROSS JOIN (
          SELECT unnest(CAST([1.0, 0.5, 0.0] AS DOUBLE[])) AS weight) w)
        SELECT *, row_number() OVER (PARTITION BY user_id, weight ORDER BY score DESC, item_id)
          AS rank FROM v_w QUALIFY rank <= 10""",
)
def sweep(v: Views) -> DataFrame:
    return ranking.weight_sweep(scored_candidates(v), (1.0, 0.5, 0.0), 10)


COLD_SQL = """SELECT r.user_id, p.item_id, CAST(NULL AS DOUBLE) AS similarity, p.popularity,
      CAST(NULL AS DOUBLE) AS score, p.rank
    FROM (SELECT user_id FROM v_requests ANTI JOIN v_history USING (user_id)) r JOIN (
      SELECT *, row_number() OVER (ORDER BY popularity DESC, item_id) AS rank
      FROM v_popularity QUALIFY rank <= 10) p ON true"""


@query("g05_recommend_item_knn", f"WITH {SCORED_SQL} {blend_sql('v_fresh')} UNION ALL {COLD_SQL}")
def item_knn(v: Views) -> DataFrame:
    return ranking.recommend_item_knn(v.requests, v.interactions, v.edges, 10)


@query(
    "g06_recommend_popular_rescored",
    f"""WITH {RECENT_SQL.format(n=10)},
          v_pool AS (SELECT * FROM v_popularity ORDER BY popularity DESC, item_id LIMIT 30),
          v_base AS (SELECT r.user_id, p.item_id, coalesce(c.similarity, 0.0) AS similarity,
              p.popularity FROM v_requests r CROSS JOIN v_pool p
            LEFT JOIN v_cand c ON c.user_id = r.user_id AND c.item_id = p.item_id
            ANTI JOIN v_history h ON h.user_id = r.user_id AND h.item_id = p.item_id)
        {blend_sql('v_base')}""",
)
def rescored(v: Views) -> DataFrame:
    return ranking.recommend_popular_rescored(v.requests, v.interactions, v.edges, 10)


@query(
    "g07_rerank_by_seed_similarity",
    f"""WITH {SEEDS_SQL.format(agg='max')} SELECT s.*, i.title, array_to_string(i.genres, '|')
          AS genres FROM v_score s LEFT JOIN v_items i USING (item_id)""",
)
def reranked(v: Views) -> DataFrame:
    found = ranking.rerank_by_seed_similarity(
        seed_candidates(v), user_history(v.interactions, 5), v.edges,
        counts.item_counts(v.interactions), v.items,
    )
    return found.withColumn("genres", F.array_join("genres", "|"))


@query(
    "g08_recommend_content",
    f"""WITH v_recent AS (SELECT DISTINCT user_id, item_id FROM (SELECT user_id, item_id,
            row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id DESC) AS n
            FROM v_interactions) WHERE n <= 20),
          v_cand AS (SELECT r.user_id, e.other_id AS item_id, max(e.similarity) AS similarity
            FROM v_recent r JOIN v_content e USING (item_id) GROUP BY ALL),
          v_fresh AS (SELECT c.*, coalesce(p.popularity, 0.0) AS popularity FROM v_cand c
            LEFT JOIN v_popularity p USING (item_id) ANTI JOIN v_history h
            ON h.user_id = c.user_id AND h.item_id = c.item_id)
        {blend_sql('v_fresh')} UNION ALL {COLD_SQL}""",
)
def content_lists(v: Views) -> DataFrame:
    seeds = user_history(v.interactions, 20)
    near = similarity.similar_by_content(v.postings, seeds, 50)
    return ranking.recommend_content(v.requests, v.interactions, near, 10)


@query("g09_recommend_popular", f"WITH {POPULAR_SQL} SELECT * FROM v_lists")
def popular(v: Views) -> DataFrame:
    return popular_lists(v)


@query(
    "g10_rerank_by_daypart",
    """WITH v_t AS (SELECT item_id, unnest(tags) AS tag, len(tags) AS size FROM v_items),
         v_near_tags AS MATERIALIZED (SELECT item_id, other_id, row_number() OVER
           (PARTITION BY item_id ORDER BY similarity DESC, other_id) AS base_rank FROM (
             SELECT a.item_id, b.item_id AS other_id, round(count(*) /
               (any_value(a.size) + any_value(b.size) - count(*)), 6) AS similarity
             FROM v_t a JOIN v_t b ON a.tag = b.tag AND a.item_id <> b.item_id
             GROUP BY a.item_id, b.item_id) QUALIFY base_rank <= 10)
       SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY matches DESC, base_rank)
         AS rank FROM (
         SELECT r.request_id, r.daypart, r.seed_item_id, n.other_id AS item_id,
           (SELECT count(*) FROM v_t t JOIN v_daypart_tags d ON d.tag = t.tag
            WHERE t.item_id = n.other_id AND d.daypart = r.daypart) AS matches, n.base_rank
         FROM v_requests r JOIN v_near_tags n ON n.item_id = r.seed_item_id)
       QUALIFY rank <= 3""",
)
def by_daypart(v: Views) -> DataFrame:
    asked = v.requests.where(F.col("seed_item_id").isNotNull())
    return ranking.rerank_by_daypart(
        asked.select("request_id", "seed_item_id", "daypart"), v.items, v.daypart_tags, 3
    )


def four_stage(v: Views, score_first: bool) -> DataFrame:
    near = similarity.similar_items(v.edges, None, 50)
    candidates = ranking.neighbours_of_recent(v.interactions, near, 10)
    stages = ranking.FourStage(
        retrieve=lambda users: candidates.join(users.select("user_id"), "user_id", "left_semi"),
        filter=lambda df: drop_seen(df, user_history(v.interactions)),
        score=lambda df: add_signal(df, v.popularity, "popularity"),
        rank=ranking.WeightedRanker({"similarity": 0.7, "popularity": 0.3}),
        score_first=score_first,
    )
    return stages.run(v.requests, 10)


FOUR_SQL = f"WITH {SCORED_SQL} {blend_sql('v_fresh', D7, 'CAST(0.3 AS DOUBLE)')}"


@query("g11_four_stage", FOUR_SQL)
def filter_first(v: Views) -> DataFrame:
    return four_stage(v, score_first=False)


@query("g11_four_stage_score_first", FOUR_SQL)
def score_first(v: Views) -> DataFrame:
    return four_stage(v, score_first=True)


# Weights of the linear joint score: eight user, eight item and four cross features.
USER_WEIGHTS = [round((i % 5 - 2) / 8, 3) for i in range(8)]
ITEM_WEIGHTS = [round((i % 3 - 1) / 4 + 0.05, 3) for i in range(8)]
CROSS_WEIGHTS = [round((i + 1) / 4, 3) for i in range(4)]
CROSS = (USER_MATRIX, ITEM_MATRIX)


def _weights_sql(values: list[float]) -> str:
    return f"CAST([{', '.join(map(str, values))}] AS DOUBLE[])"


JOINT_SQL = f"""list_dot_product(uf, {_weights_sql(USER_WEIGHTS)})
    + list_dot_product(itf, {_weights_sql(ITEM_WEIGHTS)})
    + list_dot_product(list_transform(list_zip({_project_sql('uf', USER_MATRIX)},
        {_project_sql('itf', ITEM_MATRIX)}), lambda p: p[1] * p[2]),
        {_weights_sql(CROSS_WEIGHTS)})"""


def linear(df: DataFrame) -> DataFrame:
    crossed = df.withColumn(
        "cross_features", feature_cross("user_features", "item_features", *CROSS)
    )
    return ranking.linear_score(crossed, USER_WEIGHTS, ITEM_WEIGHTS, CROSS_WEIGHTS)


def user_features(v: Views) -> DataFrame:
    return v.profiles.select("user_id", F.slice("embedding", 1, 8).alias("user_features"))


def item_features(v: Views) -> DataFrame:
    return v.vectors.select("item_id", F.slice("embedding", 9, 8).alias("item_features"))


@query(
    "g12_retrieve_and_rerank",
    f"""WITH v_found AS (SELECT q.user_id, u.item_id, round(list_dot_product(q.embedding,
            u.embedding), 6) AS s FROM v_profiles q CROSS JOIN v_unit u
          QUALIFY row_number() OVER (PARTITION BY q.user_id ORDER BY s DESC, u.item_id) <= 100),
        v_f AS (SELECT f.user_id, f.item_id, p.embedding[1:8] AS uf, v.embedding[9:16] AS itf
          FROM v_found f JOIN v_profiles p USING (user_id) JOIN v_vectors v USING (item_id)),
        v_s AS (SELECT user_id, item_id, round({JOINT_SQL}, 6) AS score FROM v_f)
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
        FROM v_s QUALIFY rank <= 20""",
)
def two_stage(v: Views) -> DataFrame:
    found = ranking.retrieve_and_rerank(
        v.profiles, v.unit, user_features(v), item_features(v), linear, 100, 20
    )
    return found.select("user_id", "item_id", "score", "rank")


def owned_pairs(v: Views) -> DataFrame:
    """Every user with every item of the history, and their features."""
    pairs = user_history(v.interactions).join(item_features(v), "item_id")
    joined = pairs.join(user_features(v), "user_id")
    return joined.withColumn(
        "cross_features", feature_cross("user_features", "item_features", *CROSS)
    )


@query(
    "g13_joint_score_linear",
    f"""SELECT user_id, item_id, round({JOINT_SQL}, 6) AS score FROM (
          SELECT h.user_id, h.item_id, p.embedding[1:8] AS uf, v.embedding[9:16] AS itf
          FROM v_history h JOIN v_profiles p USING (user_id) JOIN v_vectors v USING (item_id))""",
)
def joint_linear(v: Views) -> DataFrame:
    scored = ranking.linear_score(owned_pairs(v), USER_WEIGHTS, ITEM_WEIGHTS, CROSS_WEIGHTS)
    return scored.select("user_id", "item_id", "score")


def given_layers(inputs: int = 20, hidden: int = 16) -> list[dict[str, np.ndarray]]:
    """Stand-in for trained weights: two inner layers and the output."""
    draw = np.random.default_rng(7).standard_normal
    layers, width = [], inputs
    for _ in range(2):
        layers.append({"weight": draw((hidden, width)) / width**0.5, "bias": np.zeros(hidden),
                       "scale": np.ones(hidden), "shift": np.zeros(hidden)})
        width = hidden
    return [*layers, {"weight": draw((1, width)) / width**0.5, "bias": np.zeros(1)}]


def _layers_sql() -> str:
    """The given layers as one CTE per step, from x0 (the features) to the score."""
    *inner, last = given_layers()
    parts = [f"""v_x0 AS (SELECT user_id, item_id, list_concat(list_concat(uf, itf),
        list_transform(list_zip({_project_sql('uf', USER_MATRIX)},
          {_project_sql('itf', ITEM_MATRIX)}), lambda p: p[1] * p[2])) AS x FROM (
        SELECT h.user_id, h.item_id, p.embedding[1:8] AS uf, v.embedding[9:16] AS itf
        FROM v_history h JOIN v_profiles p USING (user_id) JOIN v_vectors v USING (item_id)))"""]

    def rows(weight: np.ndarray, x: str) -> str:
        dots = [f"list_dot_product({_weights_sql(row.tolist())}, {x})" for row in weight]
        return f"[{', '.join(dots)}]"

    for i, layer in enumerate(inner):
        parts.append(f"""v_h{i} AS (SELECT user_id, item_id, list_transform(h, lambda y: y
            - list_avg(h)) AS h FROM (SELECT user_id, item_id, {rows(layer['weight'], 'x')} AS h
            FROM v_x{i}))""")
        parts.append(f"""v_x{i + 1} AS (SELECT user_id, item_id, list_transform(h, lambda y:
            greatest(y / sqrt(list_dot_product(h, h) / len(h) + 1e-5), 0.0)) AS x FROM v_h{i})""")
    score = rows(last["weight"], "x")
    return f"""WITH {', '.join(parts)} SELECT user_id, item_id, round({score}[1], 6) AS score
        FROM v_x{len(inner)}"""


@query("g13_joint_score", _layers_sql())
def joint(v: Views) -> DataFrame:
    scored = ranking.joint_score(owned_pairs(v), given_layers())
    return scored.withColumn("score", F.round("score", 6))
