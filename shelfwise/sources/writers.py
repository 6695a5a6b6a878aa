"""Writers: CSV tables, ranked lists as JSON, token corpora and vector indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_interactions_tsv(df: DataFrame, path: str) -> None:
    df.write.option("sep", "\t").csv(path)


def recommendation_records(df: DataFrame, keys: list[str]) -> DataFrame:
    """One record per key: item ids and scores in rank order (lists of k entries)."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "item_id", "score")))
    return df.groupBy(*keys).agg(ranked.alias("_r")).select(
        *keys,
        F.transform("_r", lambda r: r["item_id"]).alias("top_k"),
        F.transform("_r", lambda r: r["score"]).alias("scores"),
    )


def write_recommendations_json(df: DataFrame, path: str, keys: list[str]) -> None:
    recommendation_records(df, keys).write.json(path)


def write_token_corpus(df: DataFrame, path: str, col: str = "sentence") -> None:
    df.select(F.col(col).alias("value")).write.text(path)


def save_index(
    index: DataFrame, path: str, by_cell: bool = False, centroids: DataFrame | None = None
) -> None:
    """Vectors with their ids; ``by_cell`` lays the files out for cell pruning.

    The centroids of a clustered index go beside it, so it can be searched again.
    """
    if centroids is not None:
        centroids.write.parquet(f"{path}.centroids")
    writer = index.write
    if by_cell:
        writer = writer.partitionBy("cell")
    writer.parquet(path)


def load_index(spark: SparkSession, path: str) -> DataFrame:
    index = spark.read.parquet(path)
    return index.withColumn("cell", F.col("cell").cast("bigint")) if "cell" in index.columns else index


def load_centroids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}.centroids")
