"""Readers with declared schemas; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.text import GENRE_FLAGS
from shelfwise.operators.ordering import top_k


def _schema(spec: str) -> T.StructType:
    return T.StructType.fromDDL(spec)


RATINGS = "user_id BIGINT, item_id BIGINT, rating DOUBLE, timestamp BIGINT"
ITEMS = "item_id BIGINT, title STRING, genres STRING"
LINKS = "item_id BIGINT, imdb_id STRING, tmdb_id BIGINT"
DESCRIPTIONS = "Title STRING, Overview STRING, Genre STRING"
# The first five fields of the piped item file, then one flag per genre.
PIPED_ITEMS = ", ".join(
    ["item_id BIGINT", "title STRING", "release_date STRING", "video_release_date STRING",
     "imdb_url STRING"]
    + [f"`{g}` INT" for g in GENRE_FLAGS]
)
SERVED_ROWS = 100
# The served tables as kind: (key column or none, score column, id column).
SERVED = {
    "item_similarities": ("item_id", "similarity", "similar_item_id"),
    "user_recommendations": ("user_id", "score", "item_id"),
    "popular_items": (None, "popularity_score", "item_id"),
}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on whatever file system it names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop)


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(hadoop).isDirectory()


def read_interactions_tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_schema(RATINGS)).option("sep", "\t").csv(path)


def read_items_piped(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    items = (
        spark.read.schema(_schema(PIPED_ITEMS))
        .option("sep", "|")
        .option("encoding", "ISO-8859-1")
        .csv(path)
    )
    return items.select(*[f"`{c}`" for c in columns]) if columns else items


def read_interactions_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_schema(RATINGS)).option("header", True).csv(path)


def read_items_csv(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(_schema(ITEMS)).option("header", True)
    return reader.option("quote", '"').option("escape", '"').csv(path)


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """Links to other catalogues; an absent file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], _schema(LINKS))
    return spark.read.schema(_schema(LINKS)).option("header", True).csv(path)


def read_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """Quoted, multi-line text, renamed to title, description, genres; absent is empty."""
    if exists(spark, path):
        raw = (
            spark.read.schema(_schema(DESCRIPTIONS))
            .option("header", True)
            .option("multiLine", True)
            .option("quote", '"')
            .option("escape", '"')
            .csv(path)
        )
    else:
        raw = spark.createDataFrame([], _schema(DESCRIPTIONS))
    return raw.withColumnsRenamed(
        {"Title": "title", "Overview": "description", "Genre": "genres"}
    )


def best_rows(df: DataFrame, kind: str, rows: int = SERVED_ROWS) -> DataFrame:
    """The served form of a table: its ``rows`` best entries per key."""
    key, score, tie = SERVED[kind]
    return top_k(df, rows, by=score, tie=tie, per=key)


def read_served_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return best_rows(spark.read.parquet(path), kind)


def read_texts(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(item_id, text), spread over all cores when the files have fewer splits than that.

    An input of many splits is left as it is read.
    """
    texts = spark.read.parquet(path).select(F.col(key).alias("item_id"), "text")
    cores = spark.sparkContext.defaultParallelism
    return texts.repartition(cores) if len(texts.inputFiles()) < cores else texts


def read_interaction_log(spark: SparkSession, path: str) -> DataFrame:
    """An event log as interactions: the item is the ``k`` of the JSON properties."""
    return spark.read.parquet(path).select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.col("value").alias("rating"),
        "ts",
    )
