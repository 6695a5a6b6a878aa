from pyspark.sql import functions as F

from shelfwise.operators.vector_index import build_flat
from shelfwise.session import scratch_path
from shelfwise.streaming import jobs


def test_index_feed_takes_new_files_once(spark, rows):
    source, out = scratch_path(spark, "arrivals"), scratch_path(spark, "index")
    state = scratch_path(spark, "state")
    schema = "item_id long, embedding array<double>"

    def arrive(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.stream_add_items(stream, out, state).awaitTermination()
        return rows(jobs.read_index(spark.read.parquet(out)), "item_id", "embedding")

    assert arrive([(1, [2.0, 0.0]), (2, [0.0, 3.0])]) == [(1, (1.0, 0.0)), (2, (0.0, 1.0))]
    assert arrive([(2, [-1.0, 0.0]), (3, [0.0, 1.0])]) == [
        (1, (1.0, 0.0)), (2, (-1.0, 0.0)), (3, (0.0, 1.0))]


def test_open_intervals_are_held_back(spark, rows):
    source = scratch_path(spark, "events")
    data = [("view", 1, 0), ("click", 1, 60), ("click", 1, 599), ("view", 2, 700), ("view", 1, 90000),
            ("error", 1, 30)]
    df = spark.createDataFrame(data, "event_type string, item_id long, s long")
    df.select("event_type", "item_id", F.timestamp_seconds("s").alias("ts")).write.parquet(source)
    stream = spark.readStream.schema("event_type string, item_id long, ts timestamp").parquet(source)
    out = scratch_path(spark, "rates")
    rates = jobs.stream_interval_rates(stream, "10 minutes", "1 hour")
    jobs.run_to_table(rates, out, scratch_path(spark, "state")).awaitTermination()
    got = spark.read.schema(rates.schema).parquet(out)
    start = F.unix_seconds("interval_start").alias("s")
    assert rows(got.select(start, "item_id", "impressions", "clicks", "rate")) == [
        (0, 1, 3, 2, 0.666667), (600, 2, 1, 0, 0.0)]


def test_unit_vectors_of_zero(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0])], "item_id long, embedding array<double>")
    assert build_flat(df, 2).first()["embedding"] == [0.0, 0.0]
