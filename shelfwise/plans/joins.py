"""Queries of the joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import counts, joins, ranking, similarity
from shelfwise.operators.ordering import rounded, top_k, user_history
from shelfwise.plans.catalog import query
from shelfwise.plans.views import Views


@query(
    "c01_attach_metadata",
    """SELECT p.item_id, p.popularity, i.title, i.description FROM v_popularity p
         LEFT JOIN v_items i USING (item_id)""",
)
def metadata(v: Views) -> DataFrame:
    doubled = v.items.unionByName(v.items.withColumn("title", F.concat("title", F.lit(" copy"))))
    return joins.attach_metadata(v.popularity, doubled, ["title", "description"])


@query(
    "c02_top_items_with_titles",
    """SELECT item_id, title, interactions, rank FROM (SELECT *, row_number() OVER
         (ORDER BY interactions DESC, item_id) AS rank FROM v_counts) JOIN v_items USING (item_id)
         WHERE rank <= 20""",
)
def top_titles(v: Views) -> DataFrame:
    return joins.top_items_with_titles(counts.item_counts(v.interactions), v.items, 20)


def _near_candidates(v: Views) -> DataFrame:
    """(user_id, item_id, similarity): neighbours of each user's ten newest items."""
    near = similarity.similar_items(v.edges, None, 50)
    return ranking.neighbours_of_recent(v.interactions, near, 10)


RECENT_SQL = """v_recent AS (SELECT DISTINCT user_id, item_id FROM (
      SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id
        ORDER BY ts DESC, item_id DESC) AS n FROM v_interactions) WHERE n <= {n}),
    v_cand AS (SELECT r.user_id, e.other_id AS item_id, max(e.similarity) AS similarity
      FROM v_recent r JOIN v_near_items e USING (item_id) WHERE e.rank <= 50 GROUP BY ALL)"""


@query(
    "c03_drop_seen",
    "WITH " + RECENT_SQL.format(n=10) + """ SELECT c.* FROM v_cand c
      ANTI JOIN v_history h ON h.user_id = c.user_id AND h.item_id = c.item_id""",
)
def unseen(v: Views) -> DataFrame:
    return joins.drop_seen(_near_candidates(v), user_history(v.interactions))


@query(
    "c04_restrict_to_pool",
    "WITH " + RECENT_SQL.format(n=10) + """ SELECT c.* FROM v_cand c SEMI JOIN (
      SELECT item_id FROM v_popularity ORDER BY popularity DESC, item_id LIMIT 30) p
      ON p.item_id = c.item_id""",
)
def pooled(v: Views) -> DataFrame:
    pool = top_k(v.popularity, 30, by="popularity")
    return joins.restrict_to_pool(_near_candidates(v), pool)


@query(
    "c05_merge_candidates",
    "WITH " + RECENT_SQL.format(n=10) + """, v_rated AS (SELECT user_id, item_id,
        round(avg(rating), 6) AS rating FROM v_interactions GROUP BY ALL)
      SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.item_id, b.item_id) AS item_id,
        coalesce(a.similarity, 0.0) AS similarity, coalesce(b.rating, 0.0) AS rating
      FROM v_cand a FULL JOIN v_rated b ON a.user_id = b.user_id AND a.item_id = b.item_id""",
)
def merged(v: Views) -> DataFrame:
    rated = v.interactions.groupBy("user_id", "item_id").agg(
        rounded(F.avg("rating")).alias("rating")
    )
    return joins.merge_candidates(
        _near_candidates(v), rated, ["user_id", "item_id"], ["similarity", "rating"]
    )


@query(
    "c06_add_signal",
    """SELECT i.item_id, coalesce(p.popularity, 0.0) AS popularity FROM v_items i
         LEFT JOIN v_popularity p USING (item_id)""",
)
def signal(v: Views) -> DataFrame:
    return joins.add_signal(v.items.select("item_id"), v.popularity, "popularity")


@query(
    "c07_genre_overlap_join",
    """SELECT DISTINCT g.request_id, i.item_id
         FROM (SELECT DISTINCT r.request_id, unnest(s.genres) AS genre
               FROM v_requests r JOIN v_items s ON s.item_id = r.seed_item_id) g
         JOIN (SELECT item_id, unnest(genres) AS genre FROM v_items) i USING (genre)""",
)
def genre_overlap(v: Views) -> DataFrame:
    owned = v.requests.where(F.col("seed_item_id").isNotNull()).select(
        "request_id", F.col("seed_item_id").alias("item_id")
    )
    return joins.genre_overlap_join(v.requests, owned, v.items)


PAIRS_SQL = """v_lines AS (SELECT l_orderkey AS basket_id, l_partkey AS item_id,
      row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS at
      FROM lineitem),
    v_pairs AS (SELECT least(a.item_id, b.item_id) AS item_a,
      greatest(a.item_id, b.item_id) AS item_b, count(*) AS pair_count
      FROM v_lines a JOIN v_lines b ON a.basket_id = b.basket_id AND a.at < b.at GROUP BY ALL)"""


@query("c08_co_pairs", "WITH " + PAIRS_SQL + " SELECT * FROM v_pairs")
def pairs(v: Views) -> DataFrame:
    return joins.co_pairs(v.baskets)


@query(
    "c09_co_matrix",
    "WITH " + PAIRS_SQL + """ SELECT * FROM v_pairs UNION ALL
      SELECT item_b AS item_a, item_a AS item_b, pair_count FROM v_pairs WHERE item_a <> item_b""",
)
def matrix(v: Views) -> DataFrame:
    return joins.co_matrix(joins.co_pairs(v.baskets))


def anchors(v: Views) -> DataFrame:
    """Every event is an anchor."""
    return v.events.select("user_id", F.col("event_id").alias("anchor_id"),
                           F.col("event_us").alias("anchor_us"))


def rewards(v: Views) -> DataFrame:
    return v.events.select("user_id", "item_id", "event_us", F.col("value").alias("reward"))


FUTURE_SQL = """SELECT a.event_id AS anchor_id, a.user_id, b.item_id, b.rating AS reward,
      (b.event_us - a.event_us) / 3600000000 AS hours_ahead
    FROM v_interactions a JOIN v_interactions b ON a.user_id = b.user_id
      AND b.event_us > a.event_us AND b.event_us <= a.event_us + 86400000000"""


@query(
    "c10_future_events",
    f"""SELECT anchor_id, user_id, item_id, reward, round(hours_ahead, 6) AS hours_ahead
          FROM ({FUTURE_SQL})""",
)
def future(v: Views) -> DataFrame:
    ahead = joins.future_events(anchors(v), rewards(v), 24)
    return ahead.select("anchor_id", "user_id", "item_id", "reward",
                        rounded("hours_ahead").alias("hours_ahead"))


@query(
    "c11_feature_lookup",
    "WITH " + RECENT_SQL.format(n=10) + """ SELECT c.user_id, c.item_id,
        round(list_sum(v.embedding[9:16]), 6) AS feature_sum
      FROM v_cand c JOIN v_vectors v USING (item_id)""",
)
def features(v: Views) -> DataFrame:
    store = v.vectors.select("item_id", F.slice("embedding", 9, 8).alias("features"))
    found = joins.feature_lookup(_near_candidates(v), store)
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    return found.select("user_id", "item_id", rounded(total).alias("feature_sum"))


@query(
    "c12_query_vector_for_item",
    """SELECT r.request_id, r.seed_item_id, round(list_sum(v.embedding), 6) AS vector_sum
         FROM v_requests r JOIN v_vectors v ON v.item_id = r.seed_item_id""",
)
def seed_vectors(v: Views) -> DataFrame:
    found = joins.query_vector_for_item(v.requests, v.vectors)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return found.select("request_id", "seed_item_id", rounded(total).alias("vector_sum"))
