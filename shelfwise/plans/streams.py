"""Queries of the streaming jobs: a table is streamed until it is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import vectors as V
from shelfwise.operators import live_index
from shelfwise.operators.ordering import rounded
from shelfwise.plans.catalog import query
from shelfwise.plans.search import CELL_SQL, IVF_SQL, PROBES, ivf_index
from shelfwise.plans.views import Views
from shelfwise.session import scratch_path
from shelfwise.sources.readers import is_folder
from shelfwise.streaming import jobs


def stream_table(v: Views, name: str) -> DataFrame:
    """A given table as a file stream, whether it is one file or a folder."""
    reader = v.spark.readStream.schema(v.table(name).schema)
    if is_folder(v.spark, v.path(name)):
        return reader.parquet(v.path(name))
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(v.sf_dir)


@query(
    "k01_stream_interval_rates",
    """WITH v_seen AS (SELECT * FROM v_interactions WHERE event_type IN ('view', 'click')),
         v_r AS (SELECT time_bucket(INTERVAL '10 minutes', ts) AS s, item_id,
           count(*) AS impressions, count(*) FILTER (event_type = 'click') AS clicks
           FROM v_seen GROUP BY ALL)
       SELECT CAST(epoch(s) AS BIGINT) AS start_s, item_id, impressions, clicks,
         round(clicks / impressions, 6) AS rate FROM v_r
       WHERE s + INTERVAL '10 minutes' <= (SELECT max(ts) FROM v_seen) - INTERVAL 1 DAY""",
)
def interval_rates(v: Views) -> DataFrame:
    """Intervals closed by the watermark, one day behind the newest event."""
    events = stream_table(v, "events").select(
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        "event_type", F.col("ts").cast("timestamp").alias("ts"),
    )
    out = scratch_path(v.spark, "rates")
    rates = jobs.stream_interval_rates(events, "10 minutes", "1 day")
    jobs.run_to_table(rates, out, scratch_path(v.spark, "rates-state")).awaitTermination()
    return v.spark.read.schema(rates.schema).parquet(out).select(
        F.unix_seconds("interval_start").alias("start_s"), "item_id", "impressions", "clicks", "rate"
    )


@query(
    "k02_stream_add_items",
    f"""WITH {CELL_SQL} SELECT c.item_id, c.cell, round(list_sum(u.embedding), 6) AS total
        FROM v_cell c JOIN v_unit u USING (item_id)""",
)
def added(v: Views) -> DataFrame:
    arriving = stream_table(v, "embeddings").select(
        F.col("vec_id").alias("item_id"), V.as_doubles("embedding").alias("embedding")
    )
    out = scratch_path(v.spark, "index")
    job = jobs.stream_add_items(
        arriving, out, scratch_path(v.spark, "index-state"), v.seed_codebook
    )
    job.awaitTermination()
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    current = jobs.read_index(v.spark.read.parquet(out))
    return current.select("item_id", "cell", rounded(total).alias("total"))


@query("k02_stream_live_search", f"WITH {IVF_SQL} SELECT * FROM v_ivf WHERE rank <= 20")
def live_search(v: Views) -> DataFrame:
    """All vectors arrive as a stream over a base of every third one, reversed; then a compaction."""
    arriving = stream_table(v, "embeddings").select(
        F.col("vec_id").alias("item_id"), V.as_doubles("embedding").alias("embedding")
    )
    cells, centroids = ivf_index(v)
    path = scratch_path(v.spark, "live-index")
    turned = cells.where("item_id % 3 = 0").withColumn("embedding", F.transform("embedding", lambda x: -x))
    live_index.create_live(turned, path)
    state = scratch_path(v.spark, "live-state")
    jobs.stream_live_changes(arriving, path, state, centroids).awaitTermination()
    live_index.compact(v.spark, path)
    return live_index.search_live(path, centroids, v.profile_queries, 20, nprobe=PROBES)
