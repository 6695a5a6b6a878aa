"""Checks that fail early, at plan time where the schema is enough."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def resolve_column(df: DataFrame, names: Sequence[str]) -> str:
    """The first of several alternative column names that exists."""
    for name in names:
        if name in df.columns:
            return name
    raise ValueError(f"none of these columns exists: {', '.join(names)}")


def vector_dim_counts(df: DataFrame, dim: int, vec: str = "embedding") -> DataFrame:
    """One row: number of vectors, and how many have another length than ``dim``."""
    wrong = F.when(F.col(vec).isNull() | (F.size(vec) != dim), 1).otherwise(0)
    return df.agg(
        F.count("*").alias("vectors"), F.coalesce(F.sum(wrong), F.lit(0)).alias("wrong_dim")
    )


def vector_dim_check(df: DataFrame, dim: int, vec: str = "embedding") -> DataFrame:
    wrong = vector_dim_counts(df, dim, vec).first()["wrong_dim"]
    if wrong:
        raise ValueError(f"{wrong} vectors do not have {dim} dimensions")
    return df


def alignment_counts(ids: DataFrame, vectors: DataFrame, key: str = "item_id") -> DataFrame:
    """One row: ids, vectors, ids without a vector and vectors without an id."""
    a = ids.select(key).distinct().withColumn("_a", F.lit(1))
    b = vectors.select(key).distinct().withColumn("_b", F.lit(1))
    return a.join(b, key, "full_outer").agg(
        F.count("_a").alias("ids"),
        F.count("_b").alias("vectors"),
        F.count_if(F.col("_b").isNull()).alias("without_vector"),
        F.count_if(F.col("_a").isNull()).alias("without_id"),
    )


def id_vector_alignment(ids: DataFrame, vectors: DataFrame, key: str = "item_id") -> DataFrame:
    row = alignment_counts(ids, vectors, key).first()
    if row["without_vector"] or row["without_id"]:
        raise ValueError(f"ids and vectors differ: {row.asDict()}")
    return vectors
