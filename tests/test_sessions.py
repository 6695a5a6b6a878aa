import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import sequences

MINUTE = 60_000_000


def brute(events, gap):
    """{(user, start): items} by one scan of the sorted events."""
    known = sorted((e for e in events if e[0] is not None and e[2] is not None),
                   key=lambda e: (e[0], e[2], e[1] is not None, e[1] or 0))
    found, before = {}, None
    for user, item, us in known:
        if before is None or before[0] != user or us - before[1] >= gap * MINUTE:
            start = (user, us)
        found.setdefault(start, []).append(item)
        before = user, us
    return found


@pytest.fixture
def small_batches(spark):
    keys = {"spark.sql.execution.arrow.maxRecordsPerBatch": "7", "spark.sql.shuffle.partitions": "9",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_sessions_over_slices_and_batches(spark, small_batches):
    rng = random.Random(5)
    events = [(rng.choice([1, 1, 1, 2, 3, 4]), rng.randrange(20), rng.randrange(40_000) * MINUTE // 10)
              for _ in range(400)]
    events += [(9, i % 3, i * MINUTE) for i in range(150)]  # one session over many slices
    events += [(1, 5, 30 * MINUTE), (1, 5, 30 * MINUTE), (None, 1, 5), (2, 1, None), (3, None, 77)]
    df = spark.createDataFrame(events, "user_id long, item_id long, event_us long")
    got = [((r.user_id, r.session_us), r["items"]) for r in sequences.build_sessions(df, 15).collect()]
    assert len(got) == len(dict(got))
    assert dict(got) == brute(events, 15)
    pieces = sequences.session_pieces(df, "item_id", 15)
    assert pieces.agg(F.max(F.size("values"))).first()[0] <= 7
    assert len(dict(got)[9, 0]) == 150


def test_sentences_leave_out_unknown_items(spark, small_batches):
    events = [(1, i, i * MINUTE) for i in range(20)] + [(2, 50, 0), (2, 51, 1), (3, 2, 0), (3, 99, 5 * MINUTE)]
    df = spark.createDataFrame(events, "user_id long, item_id long, event_us long")
    ids = spark.createDataFrame([(i, [i, 0]) for i in range(0, 20, 2)], "item_id long, semantic_id array<int>")
    got = {(r.user_id, r.session_us): r.sentence for r in sequences.session_sentences(df, ids, 30).collect()}
    every = " ".join(f"SID_{i}_0" for i in range(0, 20, 2))
    assert got == {(1, 0): every + " <|endoftext|>", (3, 0): "SID_2_0 <|endoftext|>"}


def test_no_events_and_names_as_users(spark):
    schema = "user_id string, item_id long, event_us long"
    assert sequences.build_sessions(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([("b", 1, 0), ("a", 2, 0), ("a", 3, MINUTE)], schema)
    got = {(r.user_id, r.session_us): r["items"] for r in sequences.build_sessions(df).collect()}
    assert got == {("a", 0): [2, 3], ("b", 0): [1]}


def test_a_session_of_a_million_events_stays_within_batches(spark):
    df = spark.range(1_000_000).select(
        F.lit(1).cast("long").alias("user_id"), F.col("id").alias("item_id"),
        (F.col("id") * 1_000_000).alias("event_us"))
    found = sequences.session_pieces(df).agg(
        F.max(F.size("values")).alias("longest"), F.sum(F.size("values")).alias("events"),
        F.count_distinct("session_us").alias("sessions"), F.max("session_us").alias("start")).first()
    assert found.asDict() == {"longest": 10_000, "events": 1_000_000, "sessions": 1, "start": 0}


def test_label_logits_join_vectors_to_distinct_pairs(spark, rows):
    labels = spark.createDataFrame([(a, 1, a % 2, 0.5) for a in range(6)] + [(9, 1, 7, 1.0), (9, None, 1, 1.0)],
                                   "anchor_id long, user_id long, item_id long, weight double")
    users = spark.createDataFrame([(1, [1.0, 2.0])], "user_id long, embedding array<double>")
    items = spark.createDataFrame([(0, [3.0, 0.0]), (1, [0.0, 4.0]), (2, [1.0, 1.0])], "item_id long, embedding array<double>")
    got = sequences.label_logits(labels, labels, users, items)
    assert rows(got, "anchor_id", "logit") == [(a, 8.0 if a % 2 else 3.0) for a in range(6)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "embedding" not in plan and "_u" not in plan
