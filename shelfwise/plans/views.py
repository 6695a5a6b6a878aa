"""Recommendation views over the given tables, in Spark and as SQL text.

Each view exists twice: as a DataFrame of ``Views`` and as a CTE of
``VIEW_SQL`` with the same rows, so that a query and its check read the same
input. All views cover their whole tables.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import vectors as V
from shelfwise.functions.text import daypart, epoch_micros
from shelfwise.operators import counts, similarity, vector_index
from shelfwise.operators.semantic_ids import (
    assign_semantic_ids, fit_codebooks, level_of, residual_quantize,
)
from shelfwise.session import stored
from shelfwise.sources.readers import read_interaction_log, read_texts

# The tags preferred per daypart (two per daypart).
DAYPART_TAGS = [
    ("morning", "small"), ("morning", "STANDARD"),
    ("afternoon", "large"), ("afternoon", "PROMO"),
    ("evening", "red"), ("evening", "ECONOMY"),
    ("night", "blue"), ("night", "MEDIUM"),
]
DIM = 64
SIZES = [16, 8]
STEPS = 2
PARTS, BITS = 16, 4


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.sf_dir = sf_dir

    def path(self, name: str) -> str:
        return os.path.join(self.sf_dir, f"{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def interactions(self) -> DataFrame:
        return read_interaction_log(self.spark, self.path("events"))

    @cached_property
    def events(self) -> DataFrame:
        """The event log with its item and time in microseconds."""
        return self.table("events").select(
            "event_id", "user_id", "event_type", "value", "ts",
            F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
            epoch_micros("ts").alias("event_us"),
        )

    @cached_property
    def purchases(self) -> DataFrame:
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").alias("rating"), F.col("o_orderdate").alias("ts"),
        )

    @cached_property
    def baskets(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("basket_id"), F.col("l_partkey").alias("item_id")
        )

    @cached_property
    def items(self) -> DataFrame:
        year = F.lit(1950) + F.col("p_size")
        words = F.split("p_name", " ")
        genres = F.array(F.col("p_type"), words[0])
        return self.table("part").select(
            F.col("p_partkey").alias("item_id"),
            F.concat(F.col("p_name"), F.lit(" ("), year.cast("string"), F.lit(")")).alias("title"),
            genres.alias("genres"),
            F.array_join(genres, "|").alias("genre_text"),
            F.concat(words, F.array("p_type")).alias("tags"),
            F.col("p_brand").alias("description"),
        )

    @cached_property
    def requests(self) -> DataFrame:
        """One request per customer; the seed is the item of a last view or click."""
        last = F.max(F.struct("event_us", "item_id", "event_type")).alias("l")
        newest = self.events.groupBy("user_id").agg(last)
        seed = F.when(F.col("l.event_type").isin("view", "click"), F.col("l.item_id"))
        return self.table("customer").select(F.col("c_custkey").alias("user_id")).join(
            newest, "user_id", "left"
        ).select(
            F.col("user_id").alias("request_id"), "user_id", seed.alias("seed_item_id"),
            daypart(F.timestamp_micros("l.event_us")).alias("daypart"),
        )

    @cached_property
    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("item_id"), V.as_doubles("embedding").alias("embedding"),
            F.col("label").cast("bigint").alias("label"),
        )

    @cached_property
    def profiles(self) -> DataFrame:
        """A table of its own, as several steps of a search read it."""
        return stored(similarity.user_profiles(self.interactions, self.vectors), "profiles")

    @cached_property
    def profile_queries(self) -> DataFrame:
        return self.profiles.withColumnRenamed("user_id", "query_id")

    @cached_property
    def docs(self) -> DataFrame:
        return read_texts(self.spark, self.path("documents"))

    @cached_property
    def postings(self) -> DataFrame:
        return similarity.tfidf_fit(self.docs)

    @cached_property
    def content_near(self) -> DataFrame:
        """The 50 nearest texts of every text."""
        return similarity.similar_by_content(self.postings, self.docs, 50)

    @cached_property
    def daypart_tags(self) -> DataFrame:
        return self.spark.createDataFrame(DAYPART_TAGS, "daypart string, tag string")

    @cached_property
    def edges(self) -> DataFrame:
        return similarity.item_cosine(self.interactions)

    @cached_property
    def popularity(self) -> DataFrame:
        return counts.popularity(self.interactions)

    @cached_property
    def unit(self) -> DataFrame:
        return vector_index.build_flat(self.vectors)

    @cached_property
    def seed_codebook(self) -> DataFrame:
        """Centroids of the clustered indexes, fitted on all unit vectors."""
        return level_of(fit_codebooks(self.unit, SIZES[:1], init="first_k", iters=STEPS), 0)

    @cached_property
    def cell_parts(self) -> DataFrame:
        """What the centroid of its cell leaves of each unit vector."""
        cells = vector_index.nearest_code(self.unit, self.seed_codebook, "cell")
        return stored(vector_index.cell_residuals(cells, self.seed_codebook), "cell-residuals")

    @cached_property
    def part_codebooks(self) -> DataFrame:
        return vector_index.pq_lloyd_codebooks(self.cell_parts, PARTS, DIM, BITS, STEPS)

    @cached_property
    def codebooks(self) -> DataFrame:
        return fit_codebooks(self.vectors, SIZES, init="first_k", iters=STEPS)

    @cached_property
    def quantized(self) -> DataFrame:
        return residual_quantize(self.vectors, self.codebooks, len(SIZES))

    @cached_property
    def codes(self) -> DataFrame:
        return self.quantized.select("item_id", "codes")

    @cached_property
    def ids(self) -> DataFrame:
        return self.codes.select("item_id", F.col("codes").alias("semantic_id"))

    @cached_property
    def semantic_ids(self) -> DataFrame:
        return assign_semantic_ids(self.items, self.codes)


def _lloyd_sql(level: int | str, size: int, steps: int, after: int | str | None = None) -> dict[str, str]:
    """CTEs that fit one level from the first K ids, assign codes and take residuals."""
    source = f"v_res{level}"
    after = level + 1 if isinstance(level, int) else after
    views = {
        f"v_book{level}_0": f"""SELECT row_number() OVER (ORDER BY item_id) - 1 AS code, embedding
            FROM (SELECT item_id, embedding FROM {source} ORDER BY item_id LIMIT {size})"""
    }
    for step in range(steps):
        views[f"v_near{level}_{step}"] = _nearest_sql(source, f"v_book{level}_{step}")
        views[f"v_book{level}_{step + 1}"] = f"""
            SELECT b.code, coalesce(m.embedding, b.embedding) AS embedding
            FROM v_book{level}_{step} b LEFT JOIN (
              SELECT code, list(x ORDER BY dim) AS embedding FROM (
                SELECT code, dim, avg(x) AS x FROM (
                  SELECT n.code, unnest(r.embedding) AS x,
                         generate_subscripts(r.embedding, 1) AS dim
                  FROM v_near{level}_{step} n JOIN {source} r USING (item_id))
                GROUP BY code, dim) GROUP BY code) m USING (code)"""
    views[f"v_near{level}_{steps}"] = _nearest_sql(source, f"v_book{level}_{steps}")
    if after is not None:
        views[f"v_res{after}"] = f"""
        SELECT r.item_id,
               list_transform(list_zip(r.embedding, b.embedding), lambda p: p[1] - p[2])
                 AS embedding
        FROM {source} r JOIN v_near{level}_{steps} n USING (item_id)
        JOIN v_book{level}_{steps} b USING (code)"""
    return views


def _parts_sql() -> dict[str, str]:
    """CTEs of the sub-codebooks: every part of the cells' residuals fitted on its own."""
    width = DIM // PARTS
    views: dict[str, str] = {}
    for p in range(PARTS):
        views[f"v_resP{p}"] = f"SELECT item_id, embedding[{p * width + 1}:{(p + 1) * width}] AS embedding FROM v_resC"
        views |= _lloyd_sql(f"P{p}", 2**BITS, STEPS)
    for name, table in (("v_part_codes", f"SELECT item_id, {{p}} AS part, code FROM v_nearP{{p}}_{STEPS}"),
                        ("v_part_books", f"SELECT {{p}} AS part, code, embedding FROM v_bookP{{p}}_{STEPS}")):
        views[name] = " UNION ALL ".join(table.format(p=p) for p in range(PARTS))
    return views


def _nearest_sql(source: str, book: str) -> str:
    return f"""SELECT item_id, code FROM (
            SELECT r.item_id, b.code, row_number() OVER (PARTITION BY r.item_id ORDER BY
              list_sum(list_transform(list_zip(r.embedding, b.embedding),
                                      lambda p: (p[1] - p[2]) * (p[1] - p[2]))), b.code) AS n
            FROM {source} r CROSS JOIN {book} b) WHERE n = 1"""


VIEW_SQL: dict[str, str] = {
    "v_interactions": """SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT)
        AS item_id, value AS rating, ts, event_id, event_type, epoch_us(ts) AS event_us
        FROM events""",
    "v_history": "SELECT DISTINCT user_id, item_id FROM v_interactions",
    "v_purchases": """SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS rating,
        o_orderdate AS ts FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_items": """SELECT p_partkey AS item_id, p_name || ' (' || (1950 + p_size) || ')' AS title,
        [p_type, split_part(p_name, ' ', 1)] AS genres,
        p_type || '|' || split_part(p_name, ' ', 1) AS genre_text,
        list_append(string_split(p_name, ' '), p_type) AS tags, p_brand AS description
        FROM part""",
    "v_daypart_tags": "SELECT * FROM (VALUES "
    + ", ".join(f"('{d}', '{t}')" for d, t in DAYPART_TAGS)
    + ") AS t(daypart, tag)",
    "v_requests": """SELECT c_custkey AS request_id, c_custkey AS user_id,
        CASE WHEN l.event_type IN ('view', 'click') THEN l.item_id END AS seed_item_id,
        CASE WHEN hour(l.ts) BETWEEN 6 AND 11 THEN 'morning'
             WHEN hour(l.ts) BETWEEN 12 AND 17 THEN 'afternoon'
             WHEN hour(l.ts) BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END AS daypart
        FROM customer LEFT JOIN (SELECT * FROM v_interactions QUALIFY row_number() OVER
          (PARTITION BY user_id ORDER BY ts DESC, item_id DESC, event_type DESC) = 1) l
        ON c_custkey = l.user_id""",
    "v_counts": "SELECT item_id, count(*) AS interactions FROM v_interactions GROUP BY item_id",
    "v_popularity": """SELECT item_id,
        round(interactions / (SELECT max(interactions) FROM v_counts), 6) AS popularity
        FROM v_counts""",
    "v_ui": "SELECT user_id, item_id, count(*) AS n FROM v_interactions GROUP BY ALL",
    "v_edges": """SELECT a.item_id, b.item_id AS other_id,
        round(sum(a.n * b.n) / (any_value(na.norm) * any_value(nb.norm)) + 1e-9, 6)
          AS similarity
        FROM v_ui a JOIN v_ui b ON a.user_id = b.user_id AND a.item_id <> b.item_id
        JOIN (SELECT item_id, sqrt(sum(n * n)) AS norm FROM v_ui GROUP BY item_id) na
          ON na.item_id = a.item_id
        JOIN (SELECT item_id, sqrt(sum(n * n)) AS norm FROM v_ui GROUP BY item_id) nb
          ON nb.item_id = b.item_id
        GROUP BY a.item_id, b.item_id""",
    "v_near_items": """SELECT *, row_number() OVER (PARTITION BY item_id
        ORDER BY similarity DESC, other_id) AS rank FROM v_edges WHERE similarity > 0""",
    "v_vectors": """SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS embedding,
        CAST(label AS BIGINT) AS label FROM embeddings""",
    "v_unit": """SELECT item_id, CASE WHEN len > 0
        THEN list_transform(embedding, lambda x: x / len) ELSE embedding END AS embedding
        FROM (SELECT *, sqrt(list_dot_product(embedding, embedding)) AS len FROM v_vectors)""",
    "v_profiles": """SELECT user_id, list(x ORDER BY dim) AS embedding FROM (
        SELECT user_id, dim, avg(x) AS x FROM (
          SELECT h.user_id, unnest(v.embedding) AS x, generate_subscripts(v.embedding, 1) AS dim
          FROM v_history h JOIN v_vectors v USING (item_id)) GROUP BY user_id, dim)
        GROUP BY user_id""",
    "v_queries": """SELECT user_id AS query_id, list_transform(embedding, lambda x: x / len)
        AS embedding FROM (SELECT *, sqrt(list_dot_product(embedding, embedding)) AS len
        FROM v_profiles)""",
    "v_docs": "SELECT doc_id AS item_id, text FROM documents",
    "v_res0": "SELECT item_id, embedding FROM v_vectors",
    **_lloyd_sql(0, SIZES[0], STEPS),
    **_lloyd_sql(1, SIZES[1], STEPS),
    # The clustered indexes: cells of the unit vectors, sub-codebooks of the residuals.
    "v_resU": "SELECT item_id, embedding FROM v_unit",
    **_lloyd_sql("U", SIZES[0], STEPS, after="C"),
    **_parts_sql(),
    "v_ids": f"""SELECT item_id, a.code AS c0, b.code AS c1
        FROM v_near0_{STEPS} a JOIN v_near1_{STEPS} b USING (item_id)""",
    "v_levels": """SELECT item_id, CAST(0 AS BIGINT) AS level, c0 AS code FROM v_ids
        UNION ALL SELECT item_id, CAST(1 AS BIGINT), c1 FROM v_ids""",
    "v_rebuilt": f"""SELECT item_id, list_transform(list_zip(a.embedding, b.embedding),
        lambda p: p[1] + p[2]) AS embedding FROM v_ids
        JOIN v_book0_{STEPS} a ON a.code = c0 JOIN v_book1_{STEPS} b ON b.code = c1""",
}
# Text views: postings of the 500 most frequent terms, and each text's 50 nearest texts.
_STOP_LIST = ", ".join(f"'{w}'" for w in similarity.STOP_WORDS)
VIEW_SQL |= {
    "v_tf": f"""SELECT item_id, term, count(*) AS tf FROM (SELECT item_id,
        unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS term FROM v_docs)
        WHERE term NOT IN ({_STOP_LIST}) GROUP BY ALL""",
    "v_vocab": """SELECT term, ln((1 + (SELECT count(*) FROM v_docs)) / (1 + df)) + 1 AS idf
        FROM (SELECT term, sum(tf) AS total, count(*) AS df FROM v_tf GROUP BY term
              ORDER BY total DESC, term LIMIT 500)""",
    "v_post": """SELECT item_id, term, idf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY item_id))
        AS weight FROM (SELECT item_id, term, idf, tf * idf AS raw FROM v_tf JOIN v_vocab
        USING (term))""",
    "v_content": """SELECT *, row_number() OVER (PARTITION BY item_id
        ORDER BY similarity DESC, other_id) AS rank FROM (
        SELECT a.item_id, b.item_id AS other_id, round(sum(a.weight * b.weight), 6) AS similarity
        FROM v_post a JOIN v_post b ON a.term = b.term AND a.item_id <> b.item_id GROUP BY ALL)
        WHERE similarity > 0 QUALIFY rank <= 50""",
}
# Views that several later ones read are computed once.
COMPUTED_ONCE = {
    name for name in VIEW_SQL
    if name.startswith(("v_near", "v_book", "v_res", "v_edges", "v_profiles", "v_requests",
                        "v_ids", "v_unit", "v_queries", "v_interactions", "v_part",
                        "v_tf", "v_vocab", "v_post", "v_content"))
}
