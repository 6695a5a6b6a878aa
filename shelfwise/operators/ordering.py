"""Top-k, ranks and positions: every ranking is (score DESC, id ASC)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import stored

SCORE_DIGITS = 6
HALF_NUDGE = 1e-9


def rounded(col: Column | str) -> Column:
    """Scores are rounded before they are ranked, so float noise never decides a tie."""
    return F.round(col, SCORE_DIGITS)


def rounded_blend(col: Column) -> Column:
    """Rounding for sums and means of rounded scores.

    These often end in an exact half, which float noise would push either way;
    the nudge makes halves always go up.
    """
    return F.round(col + F.lit(HALF_NUDGE), SCORE_DIGITS)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, null when b is 0."""
    return F.try_divide(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


def top_k(
    df: DataFrame,
    k: int,
    by: str = "score",
    tie: str | Sequence[str] = "item_id",
    per: str | Sequence[str] | None = None,
    rank: str = "rank",
    ascending: bool = False,
) -> DataFrame:
    """The k best rows, overall or per key, with a 1-based ``rank``.

    Per key the ``row_number <= k`` filter lets Spark cut each key map-side
    (WindowGroupLimit), so a hot key ships at most k rows per map task.
    """
    ties = [tie] if isinstance(tie, str) else list(tie)
    order = [F.col(by).asc() if ascending else F.col(by).desc()] + [F.col(t).asc() for t in ties]
    if per is None:
        best = df.orderBy(*order).limit(k)
        return best.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    keys = [per] if isinstance(per, str) else list(per)
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
    return ranked.withColumn(rank, F.col(rank).cast("bigint"))


def stable_order(df: DataFrame, by: str = "score", tie: str = "item_id") -> DataFrame:
    return df.orderBy(F.col(by).desc(), F.col(tie).asc())


def global_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """1-based position in the total order, without a one-task window.

    Rows are range-partitioned by the order and written out once, so that the
    slice boundaries are fixed; each slice is numbered on its own and shifted
    by the size of the slices before it (one small row per slice).
    """
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = stored(
        df.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()), "slices"
    )
    before = (
        sliced.groupBy("_slice")
        .agg(F.count("*").alias("_n"))
        .select(
            "_slice",
            (F.sum("_n").over(Window.orderBy("_slice")) - F.col("_n")).alias("_before"),
        )
    )
    within = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    return (
        sliced.withColumn("_row", within)
        .join(F.broadcast(before), "_slice")
        .withColumn(name, (F.col("_before") + F.col("_row")).cast("bigint"))
        .drop("_slice", "_row", "_before")
    )


def long_order(df: DataFrame, by: str = "score", tie: str = "item_id") -> DataFrame:
    """``stable_order`` with the position of every row."""
    return global_position(df, [F.col(by).desc(), F.col(tie).asc()])


def dense_ids(df: DataFrame, col: str, index: str = "dense_id") -> DataFrame:
    """Contiguous 0-based index of the distinct ids, by id ascending."""
    ids = df.select(col).where(F.col(col).isNotNull()).distinct()
    return global_position(ids, [F.col(col).asc()], index).withColumn(index, F.col(index) - 1)


def user_history(df: DataFrame, last: int | None = None) -> DataFrame:
    """Distinct (user, item); with ``last`` only from each user's newest ``last`` rows."""
    if last is None:
        return df.select("user_id", "item_id").distinct()
    newest = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("item_id").desc())
    recent = df.select("user_id", "item_id", "ts").withColumn("_n", F.row_number().over(newest))
    return recent.where(F.col("_n") <= last).select("user_id", "item_id").distinct()


def history_lists(df: DataFrame, last: int) -> DataFrame:
    """The newest ``last`` rows of each user as one sorted list of distinct items."""
    items = F.sort_array(F.collect_set("item_id")).alias("items")
    return user_history(df, last).groupBy("user_id").agg(items)


def leaf_numbers(df: DataFrame, group: str = "semantic_id") -> DataFrame:
    """0-based position of each item inside its semantic id, by title (nulls last), then id.

    One id may hold a large part of the catalogue, so positions are taken in
    the total order and shifted by the first position of the id.
    """
    placed = global_position(
        df, [F.col(group).asc(), F.col("title").asc_nulls_last(), F.col("item_id").asc()], "_place"
    )
    first = placed.groupBy(group).agg(F.min("_place").alias("_first"))
    leaf = (F.col("_place") - F.col("_first")).alias("leaf_id")
    return placed.join(first, group).select(*df.columns, leaf)
