"""Streaming forms of the response rates and of adding items to an index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators.counts import response_rate
from shelfwise.operators.live_index import add_changes
from shelfwise.operators.ordering import top_k
from shelfwise.operators.vector_index import build_flat, nearest_code


def stream_interval_rates(
    stream: DataFrame, interval: str = "10 minutes", lateness: str = "1 day"
) -> DataFrame:
    """Impressions, clicks and rate per closed interval and item.

    State is one pair of counters per open (interval, item); the watermark
    closes intervals and drops their state.
    """
    seen = stream.where(F.col("event_type").isin("view", "click")).withWatermark("ts", lateness)
    counts = seen.groupBy(F.window("ts", interval).alias("_w"), "item_id").agg(
        F.count("*").alias("impressions"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
    )
    return counts.select(
        F.col("_w.start").alias("interval_start"), "item_id", "impressions", "clicks",
        response_rate("clicks", "impressions").alias("rate"),
    )


def run_to_table(rates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed intervals to Parquet until the available input is used up."""
    return (
        rates.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_add_items(
    stream: DataFrame, path: str, checkpoint: str, centroids: DataFrame | None = None
) -> StreamingQuery:
    """Append arriving vectors to an index as one folder per batch.

    A batch overwrites its own folder, so running it again after a failure
    changes nothing. ``read_index`` lets the newest batch win for an id.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        fresh = build_flat(batch)
        if centroids is not None:
            fresh = nearest_code(fresh, centroids, "cell")
        fresh.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_live_changes(
    stream: DataFrame, path: str, checkpoint: str, centroids: DataFrame, first_batch: int = 0
) -> StreamingQuery:
    """Feed arriving vectors (null: removed) to a live index; searches see each batch when it is written.

    Batches are numbered from ``first_batch``; a job with a new checkpoint must
    start behind the last batch of the one before.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        add_changes(batch, path, first_batch + batch_id, centroids)

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_index(batches: DataFrame) -> DataFrame:
    """The current index from the batch folders: the newest row of every id.

    Of several rows of one batch the one with the lowest vector wins.
    """
    newest = top_k(batches, 1, by="batch_id", tie="embedding", per="item_id")
    return newest.drop("rank", "batch_id")
