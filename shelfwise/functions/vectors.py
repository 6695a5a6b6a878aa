"""Arithmetic on ARRAY<DOUBLE> columns, all JVM-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def as_doubles(col: Column | str) -> Column:
    return _col(col).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    return _total(F.zip_with(_col(a), _col(b), lambda x, y: x * y))


def sq_l2(a: Column | str, b: Column | str) -> Column:
    return _total(F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y)))


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 when either vector is zero."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, dot(a, b) / scale).otherwise(F.lit(0.0))


def l2_normalize(a: Column | str) -> Column:
    """Unit length; a zero vector stays as it is."""
    length = norm(a)
    return F.when(length > 0, F.transform(_col(a), lambda x: x / length)).otherwise(_col(a))


def minus(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x - y)


def plus(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x + y)


def jaccard(a: Column | str, b: Column | str) -> Column:
    union = F.size(F.array_union(_col(a), _col(b)))
    shared = F.size(F.array_intersect(_col(a), _col(b)))
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def project(vec: Column | str, matrix: Sequence[Sequence[float]]) -> Column:
    """``matrix @ vec`` for a small constant matrix given by rows."""
    return F.array(*[dot(vec, F.array(*[F.lit(float(w)) for w in row])) for row in matrix])


def feature_cross(
    user: Column | str,
    item: Column | str,
    user_matrix: Sequence[Sequence[float]],
    item_matrix: Sequence[Sequence[float]],
) -> Column:
    """Elementwise product of the projected user and item vectors."""
    return F.zip_with(
        project(user, user_matrix), project(item, item_matrix), lambda x, y: x * y
    )


def vector_dim(df: DataFrame, vec: str = "embedding") -> int | None:
    """Number of dimensions, read from one row of a table of equally long vectors."""
    row = df.select(F.size(vec).alias("d")).first()
    return row["d"] if row else None


def mean_vectors(
    df: DataFrame, per: str | Sequence[str], vec: str = "embedding", dim: int | None = None
) -> DataFrame:
    """Mean vector per key, combined map-side.

    With ``dim`` a key ships one row of sums per map task; without it the
    dimensions are aggregated as rows of their own.
    """
    keys = [per] if isinstance(per, str) else list(per)
    if dim is None:
        cells = df.select(*keys, F.posexplode(vec).alias("dim", "x"))
        means = cells.groupBy(*keys, "dim").agg(F.avg("x").alias("x"))
        return collect_vectors(means, keys, vec)
    means = ", ".join(f"sum({vec}[{i}]) / count(1)" for i in range(dim))
    return df.groupBy(*keys).agg(F.expr(f"array({means})").alias(vec))


def collect_vectors(cells: DataFrame, keys: Sequence[str], vec: str = "embedding") -> DataFrame:
    """Rebuild arrays from (keys, dim, x) rows; a group holds one row per dimension."""
    ordered = F.sort_array(F.collect_list(F.struct("dim", "x")))
    return cells.groupBy(*keys).agg(F.transform(ordered, lambda c: c["x"]).alias(vec))
