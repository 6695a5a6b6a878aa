"""Queries of the readers and writers: the given tables go out and come back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import GENRE_FLAGS, genre_flags_to_array
from shelfwise.operators import vector_index
from shelfwise.operators.sequences import session_sentences
from shelfwise.plans.catalog import query
from shelfwise.plans.views import STEPS, Views
from shelfwise.session import scratch_path
from shelfwise.sources import readers, writers


def _ratings(v: Views) -> DataFrame:
    return v.events.select(
        "user_id", "item_id", F.col("value").alias("rating"),
        F.floor(F.col("event_us") / 1_000_000).alias("timestamp"),
    )


RATINGS_SQL = """SELECT user_id, item_id, rating, event_us // 1000000 AS timestamp
    FROM v_interactions"""


@query("a01_read_interactions_tsv", RATINGS_SQL)
def interactions_tsv(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "ratings-tsv")
    writers.write_interactions_tsv(_ratings(v), path)
    return readers.read_interactions_tsv(v.spark, path)


def _piped(v: Views) -> DataFrame:
    """Items in the 24-column form; an item has the flags its size and key point at."""
    n = len(GENRE_FLAGS)
    flags = [
        F.when((F.col("p_size") % n == i) | (F.col("p_partkey") % n == i), 1).otherwise(0).alias(g)
        for i, g in enumerate(GENRE_FLAGS)
    ]
    none = F.lit(None).cast("string")
    title = F.concat(F.col("p_name"), F.lit(" é ("), (F.lit(1950) + F.col("p_size")), F.lit(")"))
    return v.table("part").select(
        F.col("p_partkey").alias("item_id"), title.alias("title"),
        F.lit("01-Jan-1995").alias("release_date"), none.alias("video_release_date"),
        none.alias("imdb_url"), *flags,
    )


def _write_piped(v: Views) -> str:
    path = scratch_path(v.spark, "items-piped")
    _piped(v).write.option("sep", "|").option("encoding", "ISO-8859-1").csv(path)
    return path


@query(
    "a02_read_items_piped",
    """SELECT p_partkey AS item_id, p_name || ' é (' || (1950 + p_size) || ')' AS title,
         CASE WHEN p_size % 19 = 5 OR p_partkey % 19 = 5 THEN 1 ELSE 0 END AS "Comedy" FROM part""",
)
def items_piped(v: Views) -> DataFrame:
    return readers.read_items_piped(v.spark, _write_piped(v), ["item_id", "title", "Comedy"])


def _genre_list_sql() -> str:
    cases = ", ".join(
        f"CASE WHEN p_size % 19 = {i} OR p_partkey % 19 = {i} THEN '{g.replace(chr(39), chr(39) * 2)}' END"
        for i, g in enumerate(GENRE_FLAGS)
    )
    return f"""SELECT p_partkey AS item_id, array_to_string(
        list_filter([{cases}], lambda g: g IS NOT NULL), '|') AS genres FROM part"""


@query("b06_genre_flags_to_array", _genre_list_sql())
def flags_to_array(v: Views) -> DataFrame:
    items = genre_flags_to_array(readers.read_items_piped(v.spark, _write_piped(v)))
    return items.select("item_id", F.array_join("genres", "|").alias("genres"))


@query("a03_read_interactions_csv", RATINGS_SQL)
def interactions_csv(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "ratings-csv")
    writers.write_table_csv(_ratings(v), path)
    return readers.read_interactions_csv(v.spark, path)


@query("a03_read_items_csv", "SELECT item_id, title, genre_text AS genres FROM v_items")
def items_csv(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "items-csv")
    writers.write_table_csv(
        v.items.select("item_id", "title", F.col("genre_text").alias("genres")), path
    )
    return readers.read_items_csv(v.spark, path)


@query(
    "a04_read_links",
    """SELECT p_partkey AS item_id, printf('%07d', p_partkey) AS imdb_id,
         CASE WHEN p_size > 25 THEN p_partkey + 100000 END AS tmdb_id FROM part""",
)
def links(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "links")
    key = F.col("p_partkey")
    writers.write_table_csv(
        v.table("part").select(
            key.alias("item_id"), F.format_string("%07d", key).alias("imdb_id"),
            F.when(F.col("p_size") > 25, key + 100000).alias("tmdb_id"),
        ),
        path,
    )
    missing = readers.read_links(v.spark, path + "-missing")
    return readers.read_links(v.spark, path).unionByName(missing)


@query(
    "a05_read_descriptions",
    """SELECT 'Document ' || doc_id AS title, coalesce(text, '') AS description, lang AS genres
         FROM documents""",
)
def descriptions(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "descriptions")
    title = F.concat(F.lit("Document "), F.col("doc_id").cast("string"))
    raw = v.table("documents").select(
        title.alias("Title"), F.col("text").alias("Overview"), F.col("lang").alias("Genre")
    )
    raw.write.option("header", True).option("quoteAll", True).option("escape", '"').option(
        "lineSep", "\n"
    ).csv(path)
    return readers.read_descriptions(v.spark, path).withColumn(
        "description", F.coalesce("description", F.lit(""))
    )


def _served_tables(v: Views, kind: str) -> str:
    """Write one of the precomputed tables."""
    if kind == "item_similarities":
        table = v.edges.withColumnRenamed("other_id", "similar_item_id")
    elif kind == "user_recommendations":
        ratings = v.interactions.groupBy("user_id", "item_id")
        table = ratings.agg(F.round(F.sum("rating"), 6).alias("score"))
    else:
        table = v.popularity.withColumnRenamed("popularity", "popularity_score")
    path = scratch_path(v.spark, kind)
    table.write.parquet(path)
    return path


def _served(v: Views, kind: str) -> DataFrame:
    return readers.read_served_table(v.spark, _served_tables(v, kind), kind)


@query(
    "a06_item_similarities",
    """SELECT item_id, other_id AS similar_item_id, similarity, row_number() OVER
         (PARTITION BY item_id ORDER BY similarity DESC, other_id) AS rank FROM v_edges
         QUALIFY rank <= 100""",
)
def served_similarities(v: Views) -> DataFrame:
    return _served(v, "item_similarities")


@query(
    "a06_user_recommendations",
    """SELECT user_id, item_id, score, row_number() OVER
         (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
         FROM (SELECT user_id, item_id, round(sum(rating), 6) AS score FROM v_interactions
               GROUP BY ALL) QUALIFY rank <= 100""",
)
def served_recommendations(v: Views) -> DataFrame:
    return _served(v, "user_recommendations")


@query(
    "a06_popular_items",
    """SELECT item_id, popularity AS popularity_score,
         row_number() OVER (ORDER BY popularity DESC, item_id) AS rank
         FROM v_popularity QUALIFY rank <= 100""",
)
def served_popular(v: Views) -> DataFrame:
    return _served(v, "popular_items")


@query("a07_write_table_csv", "SELECT item_id, title, genre_text AS genres FROM v_items")
def table_csv(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "table-csv")
    table = v.items.select("item_id", "title", F.col("genre_text").alias("genres"))
    writers.write_table_csv(table, path)
    schema = "item_id BIGINT, title STRING, genres STRING"
    return v.spark.read.schema(schema).option("header", True).csv(path)


@query(
    "a08_write_recommendations_json",
    """SELECT item_id, array_to_string(list(other_id ORDER BY rank), ',') AS top_k,
         array_to_string(list(printf('%.6f', similarity) ORDER BY rank), ',') AS scores
         FROM v_near_items WHERE rank <= 10 GROUP BY item_id""",
)
def recommendations_json(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "lists-json")
    near = readers.top_k(
        v.edges, 10, by="similarity", tie="other_id", per="item_id"
    ).withColumnsRenamed({"item_id": "seed", "other_id": "item_id", "similarity": "score"})
    writers.write_recommendations_json(near, path, ["seed"])
    back = v.spark.read.schema("seed BIGINT, top_k ARRAY<BIGINT>, scores ARRAY<DOUBLE>").json(path)
    scores = F.transform("scores", lambda s: F.format_string("%.6f", s))
    return back.select(
        F.col("seed").alias("item_id"),
        F.array_join(F.col("top_k").cast("array<string>"), ",").alias("top_k"),
        F.array_join(scores, ",").alias("scores"),
    )


@query(
    "a09_save_load_index",
    f"""SELECT u.item_id, n.code AS cell, CAST(generate_subscripts(u.embedding, 1) - 1 AS BIGINT)
          AS dim, round(unnest(u.embedding), 6) AS x
        FROM v_unit u JOIN v_nearU_{STEPS} n USING (item_id)""",
)
def saved_index(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "index")
    index, centroids = vector_index.ivf_build(v.vectors, centroids=v.seed_codebook)
    writers.save_index(index.select("item_id", "embedding", "cell"), path, True, centroids)
    loaded = writers.load_index(v.spark, path)
    return loaded.select(
        "item_id", "cell",
        F.posexplode("embedding").alias("dim", "x"),
    ).select("item_id", "cell", F.col("dim").cast("bigint").alias("dim"), F.round("x", 6).alias("x"))


SESSIONS_SQL = """v_s AS (
      SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY event_us, item_id
        ROWS UNBOUNDED PRECEDING) AS session_no FROM (
        SELECT user_id, item_id, event_us, CASE WHEN event_us - lag(event_us) OVER
          (PARTITION BY user_id ORDER BY event_us, item_id) < CAST({gap} AS BIGINT) * 60000000
          THEN 0 ELSE 1 END AS opens FROM v_interactions))"""
SENTENCES_SQL = (
    "WITH " + SESSIONS_SQL.format(gap=720) + """
    SELECT user_id, min(event_us_all) AS session_us,
      array_to_string(list(token ORDER BY event_us, item_id), ' ') || ' <|endoftext|>' AS sentence
    FROM (SELECT s.*, 'SID_' || c0 || '_' || c1 AS token,
            min(event_us) OVER (PARTITION BY user_id, session_no) AS event_us_all
          FROM v_s s LEFT JOIN v_ids USING (item_id))
    WHERE token IS NOT NULL GROUP BY user_id, session_no"""
)


@query("a10_write_token_corpus", f"SELECT sentence FROM ({SENTENCES_SQL})")
def token_corpus(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "corpus")
    writers.write_token_corpus(session_sentences(v.events, v.ids, gap_minutes=720), path)
    return v.spark.read.text(path).withColumnRenamed("value", "sentence")


