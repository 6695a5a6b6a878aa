"""Queries of the column expressions, filters and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import checks, text
from shelfwise.functions import vectors as V
from shelfwise.operators.counts import trailing_window
from shelfwise.operators.ordering import dense_ids, rounded
from shelfwise.plans.catalog import query
from shelfwise.plans.views import DIM, Views

CLEAN_SQL = f"trim(regexp_replace(title, '{text.TITLE_YEAR}', ''))"


@query("b02_clean_title", f"SELECT item_id, {CLEAN_SQL} AS clean_title FROM v_items")
def clean(v: Views) -> DataFrame:
    return v.items.select("item_id", text.clean_title("title").alias("clean_title"))


@query(
    "b03_content_text",
    f"SELECT item_id, coalesce({CLEAN_SQL}, '') || ' ' || coalesce(genre_text, '') AS content "
    "FROM v_items",
)
def content(v: Views) -> DataFrame:
    return v.items.select("item_id", text.content_text("title", "genre_text").alias("content"))


@query(
    "b04_item_blob",
    "SELECT item_id, title || '. ' || genre_text || '. ' || description AS blob FROM v_items",
)
def blob(v: Views) -> DataFrame:
    return v.items.select(
        "item_id", text.item_blob("title", "genre_text", "description").alias("blob")
    )


@query(
    "b05_split_genres",
    "SELECT item_id, unnest(string_split(genre_text, '|')) AS genre FROM v_items",
)
def genres(v: Views) -> DataFrame:
    return v.items.select("item_id", F.explode(text.split_genres("genre_text")).alias("genre"))


@query(
    "b07_trailing_window",
    """SELECT user_id, item_id, CAST(rating AS DOUBLE) AS rating,
         epoch_us(ts) // 1000000 AS ts_s FROM v_purchases
         WHERE ts >= (SELECT max(ts) FROM v_purchases) - INTERVAL 365 DAYS""",
)
def last_year(v: Views) -> DataFrame:
    kept = trailing_window(v.purchases, "ts", 365)
    seconds = F.floor(text.epoch_micros("ts") / 1_000_000).alias("ts_s")
    return kept.select("user_id", "item_id", "rating", seconds)


@query(
    "b08_parse_event_time",
    """SELECT event_id, (event_us // 1000000) * 1000000 AS parsed_us FROM v_interactions
         WHERE event_type <> 'error'""",
)
def parsed_time(v: Views) -> DataFrame:
    seconds = F.floor(F.col("event_us") / 1_000_000).cast("string")
    broken = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(seconds)
    raw = v.events.select("event_id", broken.alias("timestamp"))
    parsed = text.parse_event_time(raw, "timestamp", "s")
    return parsed.select("event_id", F.unix_micros("ts").alias("parsed_us"))


@query(
    "b09_filter_text",
    """SELECT item_id, title, starts_with(title, 'red') AS red,
         regexp_matches(title, '(?i)\\bwidget\\b') AS widget FROM v_items
         WHERE title IS NOT NULL AND (starts_with(title, 'red')
           OR regexp_matches(title, '(?i)\\bwidget\\b'))""",
)
def filtered(v: Views) -> DataFrame:
    named = text.with_title(v.items).select("item_id", "title")
    marked = named.select(
        "item_id", "title", text.starts_with("title", "red").alias("red"),
        text.has_word("title", "WIDGET").alias("widget"),
    )
    return marked.where(F.col("red") | F.col("widget"))


@query(
    "b10_daypart",
    """SELECT event_id, CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN 'morning'
         WHEN hour(ts) BETWEEN 12 AND 17 THEN 'afternoon'
         WHEN hour(ts) BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END AS daypart
         FROM v_interactions""",
)
def dayparts(v: Views) -> DataFrame:
    return v.events.select("event_id", text.daypart("ts").alias("daypart"))


@query(
    "b11_dense_ids",
    """SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS dense_id
         FROM (SELECT DISTINCT item_id FROM v_purchases)""",
)
def dense(v: Views) -> DataFrame:
    return dense_ids(v.purchases, "item_id")


@query("b12_sid_token", "SELECT item_id, 'SID_' || c0 || '_' || c1 AS token FROM v_ids")
def tokens(v: Views) -> DataFrame:
    return v.ids.select("item_id", text.sid_token("semantic_id").alias("token"))


@query(
    "b13_l2_normalize",
    """SELECT item_id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS dim,
         round(unnest(embedding), 6) AS x FROM v_unit""",
)
def normalized(v: Views) -> DataFrame:
    cells = v.vectors.select(
        "item_id", F.posexplode(V.l2_normalize("embedding")).alias("dim", "x")
    )
    return cells.select("item_id", F.col("dim").cast("bigint").alias("dim"), rounded("x").alias("x"))


@query(
    "b14_vector_products",
    """SELECT q.query_id, v.item_id,
         round(list_dot_product(q.embedding, v.embedding), 6) AS dot,
         round(list_dot_product(q.embedding, v.embedding) /
           sqrt(list_dot_product(q.embedding, q.embedding)
                * list_dot_product(v.embedding, v.embedding)), 6) AS cosine,
         round(list_sum(list_transform(list_zip(q.embedding, v.embedding),
           lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6) AS sq_l2
         FROM (SELECT user_id AS query_id, embedding FROM v_profiles) q
         JOIN v_history h ON h.user_id = q.query_id JOIN v_vectors v USING (item_id)""",
)
def products(v: Views) -> DataFrame:
    """Every user's profile against each item the user has."""
    owned = v.interactions.select(F.col("user_id").alias("query_id"), "item_id").distinct()
    mean = v.profile_queries.withColumnRenamed("embedding", "q")
    pairs = owned.join(mean, "query_id").join(v.vectors, "item_id")
    return pairs.select(
        "query_id", "item_id",
        rounded(V.dot("q", "embedding")).alias("dot"),
        rounded(V.cosine("q", "embedding")).alias("cosine"),
        rounded(V.sq_l2("q", "embedding")).alias("sq_l2"),
    )


@query(
    "b15_jaccard",
    """SELECT h.user_id, h.item_id, round(len(list_intersect(a.tags, b.tags)) /
         len(list_distinct(list_concat(a.tags, b.tags))), 6) AS jaccard
         FROM v_history h JOIN v_items a USING (item_id)
         JOIN (SELECT user_id, item_id AS seed FROM v_interactions QUALIFY row_number() OVER
           (PARTITION BY user_id ORDER BY event_us DESC, item_id DESC) = 1) l
           ON l.user_id = h.user_id JOIN v_items b ON b.item_id = l.seed""",
)
def jaccards(v: Views) -> DataFrame:
    """Tags of each item of a user against the tags of the user's newest item."""
    newest = v.events.groupBy("user_id").agg(F.max(F.struct("event_us", "item_id")).alias("l"))
    tags = v.items.select("item_id", "tags")
    seeds = newest.select("user_id", F.col("l.item_id").alias("item_id")).join(tags, "item_id")
    seeds = seeds.select("user_id", F.col("tags").alias("seed_tags"))
    owned = v.interactions.select("user_id", "item_id").distinct().join(tags, "item_id")
    return owned.join(seeds, "user_id").select(
        "user_id", "item_id", rounded(V.jaccard("tags", "seed_tags")).alias("jaccard")
    )


# Projection weights of the query below: four outputs of eight inputs.
USER_MATRIX = [[round(((i * 8 + j) % 7 - 3) / 4, 2) for j in range(8)] for i in range(4)]
ITEM_MATRIX = [[round(((i * 5 + j * 3) % 9 - 4) / 5, 2) for j in range(8)] for i in range(4)]


def _project_sql(vec: str, matrix: list[list[float]]) -> str:
    rows = ", ".join(
        f"list_dot_product({vec}, CAST([{', '.join(map(str, row))}] AS DOUBLE[]))"
        for row in matrix
    )
    return f"[{rows}]"


@query(
    "b16_feature_cross",
    f"""SELECT item_id, CAST(generate_subscripts(c, 1) - 1 AS BIGINT) AS dim,
          round(unnest(c), 6) AS x FROM (
          SELECT item_id, list_transform(list_zip(
            {_project_sql('embedding[1:8]', USER_MATRIX)},
            {_project_sql('embedding[9:16]', ITEM_MATRIX)}), lambda p: p[1] * p[2]) AS c
          FROM v_vectors)""",
)
def crosses(v: Views) -> DataFrame:
    cross = V.feature_cross(
        F.slice("embedding", 1, 8), F.slice("embedding", 9, 8), USER_MATRIX, ITEM_MATRIX
    )
    cells = v.vectors.select("item_id", F.posexplode(cross).alias("dim", "x"))
    return cells.select("item_id", F.col("dim").cast("bigint").alias("dim"), rounded("x").alias("x"))


@query("b01_require_columns", "SELECT count(*) AS events, count(item_id) AS with_item FROM v_interactions")
def required(v: Views) -> DataFrame:
    events = checks.require_columns(v.events, ["user_id", "item_id", "event_us"])
    return events.agg(F.count("*").alias("events"), F.count("item_id").alias("with_item"))


@query(
    "b17_vector_dim_check",
    f"""SELECT count(*) AS vectors, CAST(coalesce(sum(CASE WHEN len(embedding) <> {DIM}
          THEN 1 ELSE 0 END), 0) AS BIGINT) AS wrong_dim FROM v_vectors""",
)
def dims(v: Views) -> DataFrame:
    return checks.vector_dim_counts(v.vectors, DIM)


@query(
    "b17_id_vector_alignment",
    """SELECT count(a.item_id) AS ids, count(b.item_id) AS vectors,
         count(*) FILTER (WHERE b.item_id IS NULL) AS without_vector,
         count(*) FILTER (WHERE a.item_id IS NULL) AS without_id
         FROM (SELECT DISTINCT item_id FROM v_items) a FULL JOIN v_vectors b
         ON a.item_id = b.item_id""",
)
def alignment(v: Views) -> DataFrame:
    return checks.alignment_counts(v.items, v.vectors)
