"""Queries of the similarity operators and candidate lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.draws import draw_sql
from shelfwise.operators import counts, similarity
from shelfwise.operators.ordering import rounded, top_k, user_history
from shelfwise.plans.catalog import query
from shelfwise.plans.views import Views


@query("f01_item_cosine", "SELECT * FROM v_edges")
def cosine(v: Views) -> DataFrame:
    return similarity.item_cosine(v.interactions)


@query(
    "f01_item_cosine_purchases",
    """WITH v_pc AS MATERIALIZED (SELECT user_id, item_id, count(*) AS n FROM v_purchases
           GROUP BY ALL),
         v_norm AS (SELECT item_id, sqrt(sum(n * n)) AS norm FROM v_pc GROUP BY item_id),
         v_pair AS (SELECT a.item_id, b.item_id AS other_id, sum(a.n * b.n) AS w
           FROM v_pc a JOIN v_pc b ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY ALL)
       SELECT p.item_id, other_id, round(w / (a.norm * b.norm) + 1e-9, 6) AS similarity, row_number() OVER
         (PARTITION BY p.item_id ORDER BY round(w / (a.norm * b.norm) + 1e-9, 6) DESC, other_id) AS rank
       FROM v_pair p JOIN v_norm a ON a.item_id = p.item_id JOIN v_norm b ON b.item_id = p.other_id
       QUALIFY rank <= 10""",
)
def cosine_purchases(v: Views) -> DataFrame:
    """The ten nearest items of every item bought, over all purchases."""
    return similarity.nearest_items(v.purchases, 10)


@query("f02_similar_items", "SELECT * FROM v_near_items WHERE rank <= 20")
def near_items(v: Views) -> DataFrame:
    return similarity.similar_items(v.edges, v.items.select("item_id"), 20)


DOT_SQL = """SELECT a.{x} AS {x}, b.{x} AS {y}, CAST(sum(a.n * b.n) AS BIGINT) AS dot,
      row_number() OVER (PARTITION BY a.{x} ORDER BY sum(a.n * b.n) DESC, b.{x}) AS rank
    FROM v_ui a JOIN v_ui b ON a.{g} = b.{g} AND a.{x} <> b.{x} GROUP BY a.{x}, b.{x}
    QUALIFY rank <= 3"""


@query("f03_similar_items_dot", DOT_SQL.format(x="item_id", y="other_id", g="user_id"))
def item_dots(v: Views) -> DataFrame:
    return similarity.similar_items_dot(counts.user_item_counts(v.interactions), 3)


@query("f04_similar_users", DOT_SQL.format(x="user_id", y="other_user", g="item_id"))
def user_dots(v: Views) -> DataFrame:
    return similarity.similar_users(counts.user_item_counts(v.interactions), 3)


@query(
    "f05_recommend_from_neighbors",
    "WITH v_nb AS (" + DOT_SQL.format(x="user_id", y="other_user", g="item_id") + """)
      SELECT n.user_id, u.item_id, count(*) AS votes, row_number() OVER
        (PARTITION BY n.user_id ORDER BY count(*) DESC, u.item_id) AS rank
      FROM (SELECT user_id, other_user FROM v_nb) n JOIN v_ui u ON u.user_id = n.other_user
      ANTI JOIN v_ui o ON o.user_id = n.user_id AND o.item_id = u.item_id
      GROUP BY n.user_id, u.item_id QUALIFY rank <= 3""",
)
def neighbour_votes(v: Views) -> DataFrame:
    held = counts.user_item_counts(v.interactions)
    return similarity.recommend_from_neighbors(held, similarity.similar_users(held, 3), 3)


TAGS_SQL = """v_t AS (SELECT item_id, unnest(tags) AS tag, len(list_distinct(tags)) AS size
      FROM v_items),
    v_tag_near AS (SELECT item_id, other_id, similarity, row_number() OVER
      (PARTITION BY item_id ORDER BY similarity DESC, other_id) AS rank FROM (
        SELECT a.item_id, b.item_id AS other_id,
          round(count(*) / (any_value(a.size) + any_value(b.size) - count(*)), 6) AS similarity
        FROM v_t a JOIN v_t b ON a.tag = b.tag AND a.item_id <> b.item_id
        GROUP BY a.item_id, b.item_id) QUALIFY rank <= 10)"""


@query("f06_similar_by_tags", f"WITH {TAGS_SQL} SELECT * FROM v_tag_near")
def near_tags(v: Views) -> DataFrame:
    return similarity.similar_by_tags(v.items, 10)


@query(
    "f07_tag_similarity_matrix",
    """WITH v_s AS (SELECT DISTINCT list_sort(list_distinct(tags)) AS tags FROM v_items)
       SELECT array_to_string(a.tags, '|') AS tag_set, array_to_string(b.tags, '|') AS other_set,
         round(len(list_intersect(a.tags, b.tags)) /
           len(list_distinct(list_concat(a.tags, b.tags))), 6) AS similarity
       FROM v_s a JOIN v_s b ON list_has_any(a.tags, b.tags)""",
)
def tag_matrix(v: Views) -> DataFrame:
    """Over distinct tag sets; a pair that is not listed has no common tag."""
    return similarity.tag_overlaps(similarity.tag_sets(v.items))


@query(
    "f08_similar_by_embedding",
    """SELECT a.item_id, b.item_id AS other_id,
         round(list_dot_product(a.embedding, b.embedding), 6) AS similarity, row_number() OVER
         (PARTITION BY a.item_id ORDER BY round(list_dot_product(a.embedding, b.embedding), 6) DESC,
          b.item_id) AS rank
         FROM v_unit a JOIN v_unit b ON a.item_id <> b.item_id QUALIFY rank <= 10""",
)
def near_vectors(v: Views) -> DataFrame:
    return similarity.similar_by_embedding(v.vectors, v.vectors, 10)


@query(
    "f09_recommend_from_profile",
    """SELECT q.query_id AS user_id, u.item_id,
         round(list_dot_product(q.embedding, u.embedding), 6) AS similarity, row_number() OVER
         (PARTITION BY q.query_id ORDER BY round(list_dot_product(q.embedding, u.embedding), 6) DESC,
          u.item_id) AS rank
         FROM v_queries q JOIN v_unit u ON true
         ANTI JOIN v_history h ON h.user_id = q.query_id AND h.item_id = u.item_id
         QUALIFY rank <= 10""",
)
def profile_items(v: Views) -> DataFrame:
    return similarity.recommend_from_profile(v.interactions, v.vectors, 10)


@query("f10_tfidf_fit", "SELECT item_id, term, round(idf, 6) AS idf, round(weight, 6) AS weight FROM v_post")
def tfidf(v: Views) -> DataFrame:
    return v.postings.select(
        "item_id", "term", rounded("idf").alias("idf"), rounded("weight").alias("weight")
    )


@query(
    "f11_top_idf_terms",
    """SELECT term, round(idf, 6) AS idf, row_number() OVER (ORDER BY round(idf, 6) DESC, term)
         AS rank FROM v_vocab QUALIFY rank <= 10""",
)
def idf_terms(v: Views) -> DataFrame:
    return similarity.top_idf_terms(v.postings, 10)


@query("f12_similar_by_content", "SELECT * FROM v_content")
def near_content(v: Views) -> DataFrame:
    return v.content_near


@query(
    "f13_popular_items",
    """SELECT item_id, popularity, row_number() OVER (ORDER BY popularity DESC, item_id) AS rank
         FROM (SELECT item_id, round(n / max(n) OVER (), 6) AS popularity FROM (
           SELECT item_id, count(*) AS n FROM v_purchases GROUP BY item_id)) QUALIFY rank <= 1000""",
)
def popular(v: Views) -> DataFrame:
    return counts.popular_items(v.purchases, 1000)


@query(
    "f14_popular_in_genre",
    """WITH v_g AS (SELECT item_id, unnest(genres) AS genre FROM v_items),
         v_si AS (SELECT DISTINCT r.request_id, g.item_id FROM v_requests r
           JOIN v_g s ON s.item_id = r.seed_item_id JOIN v_g g USING (genre)),
         v_ug AS (SELECT DISTINCT r.request_id, g.genre FROM v_requests r
           JOIN v_history h USING (user_id) JOIN v_g g ON g.item_id = h.item_id),
         v_hi AS (SELECT DISTINCT u.request_id, g.item_id FROM v_ug u JOIN v_g g USING (genre)),
         v_c AS (SELECT s.* FROM v_si s SEMI JOIN v_hi h
             ON h.request_id = s.request_id AND h.item_id = s.item_id
           UNION ALL SELECT s.* FROM v_si s ANTI JOIN v_ug u USING (request_id)
           UNION ALL SELECT h.* FROM v_hi h ANTI JOIN v_si s USING (request_id)),
         v_all AS (SELECT * FROM v_c UNION ALL SELECT r.request_id, p.item_id
           FROM v_requests r ANTI JOIN v_c USING (request_id) CROSS JOIN v_popularity p)
       SELECT request_id, item_id, coalesce(popularity, 0.0) AS popularity, row_number() OVER
         (PARTITION BY request_id ORDER BY coalesce(popularity, 0.0) DESC, item_id) AS rank
       FROM v_all LEFT JOIN v_popularity USING (item_id) QUALIFY rank <= 20""",
)
def genre_popular(v: Views) -> DataFrame:
    found = similarity.popular_in_genre(v.requests, v.interactions, v.items, 20)
    return found.select("request_id", "item_id", "popularity", "rank")


HYBRID_SQL = """v_hybrid AS (SELECT coalesce(a.item_id, b.item_id) AS item_id,
      coalesce(a.other_id, b.other_id) AS other_id,
      coalesce(a.similarity, 0.0) AS content_similarity,
      coalesce(b.similarity, 0.0) AS behavioral_similarity
    FROM (SELECT * FROM v_content WHERE rank <= 10) a FULL JOIN
      (SELECT * FROM v_near_items WHERE rank <= 10) b
      ON a.item_id = b.item_id AND a.other_id = b.other_id)"""


def hybrid_lists(v: Views) -> DataFrame:
    content = similarity.similar_by_content(v.postings, v.docs, 10)
    behaviour = similarity.similar_items(v.edges, None, 10)
    return similarity.hybrid_candidates(content, behaviour, 20)


@query("f15_hybrid_candidates", f"WITH {HYBRID_SQL} SELECT * FROM v_hybrid")
def hybrid(v: Views) -> DataFrame:
    return hybrid_lists(v)


@query(
    "f16_routed_candidates",
    """WITH v_r AS (SELECT request_id, seed_item_id, CASE WHEN user_id IN
           (SELECT user_id FROM v_history) THEN user_id END AS user_id FROM v_requests),
         v_own AS (SELECT user_id, item_id, round(sum(rating), 6) AS score, row_number() OVER
           (PARTITION BY user_id ORDER BY round(sum(rating), 6) DESC, item_id) AS rank
           FROM v_interactions GROUP BY user_id, item_id QUALIFY rank <= 100)
       SELECT request_id, 'similar' AS route, other_id AS item_id, similarity AS score, rank
         FROM v_r JOIN v_near_items n ON n.item_id = seed_item_id WHERE rank <= 100
       UNION ALL SELECT request_id, 'user', item_id, score, rank FROM v_r JOIN v_own USING (user_id)
         WHERE seed_item_id IS NULL
       UNION ALL SELECT request_id, 'popular', item_id, popularity, rank FROM v_r JOIN (
         SELECT *, row_number() OVER (ORDER BY popularity DESC, item_id) AS rank
         FROM v_popularity QUALIFY rank <= 100) p ON seed_item_id IS NULL AND user_id IS NULL""",
)
def routed(v: Views) -> DataFrame:
    """Customers without any event are anonymous visitors."""
    known = v.interactions.select("user_id").distinct().withColumn("_known", F.lit(True))
    requests = v.requests.join(known, "user_id", "left").select(
        "request_id", "seed_item_id", F.when(F.col("_known"), F.col("user_id")).alias("user_id")
    )
    served = v.interactions.groupBy("user_id", "item_id").agg(
        rounded(F.sum("rating")).alias("score")
    )
    return similarity.routed_candidates(
        requests, v.edges, served, counts.popular_items(v.interactions, 100), 100
    )


@query(
    "f17_random_items",
    f"""WITH v_d AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS d
           FROM (SELECT DISTINCT item_id FROM v_items WHERE item_id IS NOT NULL)),
         v_n AS (SELECT count(*) AS n FROM v_d)
       SELECT request_id, item_id, rank FROM (
         SELECT request_id, unnest(taken) AS d, unnest(range(1, len(taken) + 1)) AS rank FROM (
           WITH RECURSIVE f AS (
             SELECT request_id, greatest(n - 10, 0) AS e, CAST([] AS BIGINT[]) AS taken, n
             FROM v_requests, v_n WHERE n > 0
             UNION ALL
             SELECT request_id, e + 1, list_append(taken, CASE WHEN list_contains(taken, x) THEN e ELSE x END), n
             FROM (SELECT *, {draw_sql(42, "request_id", "e")} % (e + 1) AS x FROM f WHERE e < n))
           SELECT * FROM f WHERE e = n)) JOIN v_d USING (d)""",
)
def random(v: Views) -> DataFrame:
    return similarity.random_items(v.requests, v.items, 10, seed=42)


@query(
    "f18_cold_start_fallback",
    """SELECT r.user_id, p.item_id, CAST(NULL AS DOUBLE) AS similarity, p.popularity, p.rank
         FROM (SELECT user_id FROM v_requests ANTI JOIN v_history USING (user_id)) r JOIN (
           SELECT *, row_number() OVER (ORDER BY popularity DESC, item_id) AS rank
           FROM v_popularity QUALIFY rank <= 10) p ON true""",
)
def cold(v: Views) -> DataFrame:
    popular10 = top_k(v.popularity, 10, by="popularity")
    return similarity.cold_start_fallback(
        v.requests.select("user_id"), user_history(v.interactions), popular10, 10
    )
