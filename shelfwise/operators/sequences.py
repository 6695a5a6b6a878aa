"""Sessions, token sentences, future-event labels and sampled softmax."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.draws import draw
from shelfwise.functions.text import sid_token
from shelfwise.functions.vectors import dot
from shelfwise.operators.blocks import block_logsumexp
from shelfwise.operators.joins import future_events
from shelfwise.operators.ordering import rounded
from shelfwise.session import cut_lineage, stored

END_OF_TEXT = "<|endoftext|>"


def mark_sessions(events: DataFrame, gap_minutes: int = 30, slice_hours: int = 1) -> DataFrame:
    """Add ``session_us``, the start of the event's session (gap strictly below the limit).

    Events (user_id, item_id, event_us). A user's events are cut into time
    slices that are worked on apart, so a user with most of the events is many
    small groups; only one summary row per slice is then linked over the user.
    """
    gap = gap_minutes * 60_000_000
    width = slice_hours * 3_600_000_000
    sliced = events.withColumn("_slice", F.floor(F.col("event_us") / width))
    keys = ["user_id", "_slice"]
    within = Window.partitionBy(*keys).orderBy("event_us", "item_id")
    before = F.lag("event_us").over(within)
    opens = before.isNull() | (F.col("event_us") - before >= gap)
    local = sliced.withColumn("_open", F.when(opens, F.col("event_us")))
    local = local.withColumn("_local", F.max("_open").over(within)).drop("_open")
    ends = local.groupBy(*keys).agg(
        F.min("event_us").alias("_first"), F.max("event_us").alias("_last"),
        F.max("_local").alias("_last_open"),
    )
    over_user = Window.partitionBy("user_id").orderBy("_slice")
    linked = F.col("_first") - F.lag("_last").over(over_user) < gap
    chain = ends.withColumn("_linked", F.coalesce(linked, F.lit(False)))
    whole = F.col("_linked") & (F.col("_last_open") == F.col("_first"))
    start = F.when(~whole, F.col("_last_open"))
    chain = chain.withColumn("_carried", F.last(start, ignorenulls=True).over(
        over_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    opened = F.when(F.col("_linked"), F.lag("_carried").over(over_user))
    heads = chain.select(*keys, "_first", opened.alias("_opened"))
    joined = local.join(heads, keys)
    continues = (F.col("_local") == F.col("_first")) & F.col("_opened").isNotNull()
    return joined.withColumn(
        "session_us", F.when(continues, F.col("_opened")).otherwise(F.col("_local"))
    ).drop("_slice", "_local", "_first", "_opened")


def _openings(users: pa.Array, us: np.ndarray, gap: int, before: tuple | None) -> np.ndarray:
    """Whether each row opens a session; without a row before, the first one does not."""
    opens = np.zeros(len(us), dtype=bool)
    changed = pc.not_equal(users.slice(1), users.slice(0, len(us) - 1))
    opens[1:] = changed.to_numpy(zero_copy_only=False) | (np.diff(us) >= gap)
    if before is not None:
        opens[0] = users[0].as_py() != before[0] or us[0] - before[1] >= gap
    return opens


def _slice_edges(ordered: DataFrame, gap: int) -> dict[int, int]:
    """Start of the session that each slice begins in.

    Slices send one row each (first and last event, newest opening inside); the
    driver, which schedules every slice anyway, carries openings over them.
    """
    user_type = ordered.schema["user_id"].dataType.simpleString()

    def edges(batches):
        first = last = opened = None
        for batch in batches:
            if batch.num_rows:
                users, us = batch.column(0), batch.column(1).to_numpy()
                heads = np.flatnonzero(_openings(users, us, gap, last))
                first = first or (users[0].as_py(), int(us[0]))
                last = users[-1].as_py(), int(us[-1])
                opened = int(us[heads[-1]]) if len(heads) else opened
        if first is not None:
            row = [TaskContext.get().partitionId(), *first, *last, opened]
            types = [pa.int32(), users.type, pa.int64(), users.type, pa.int64(), pa.int64()]
            names = ["slice", "user_a", "first", "user_b", "last", "opened"]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)

    schema = (f"slice int, user_a {user_type}, first bigint, user_b {user_type}, "
              "last bigint, opened bigint")
    begins, running, before = {}, None, None
    for e in sorted(ordered.select("user_id", "event_us").mapInArrow(edges, schema).collect()):
        goes_on = before is not None and e["user_a"] == before[0] and e["first"] - before[1] < gap
        begins[e["slice"]] = running if goes_on else e["first"]
        running = begins[e["slice"]] if e["opened"] is None else e["opened"]
        before = e["user_b"], e["last"]
    return begins


def session_pieces(events: DataFrame, value: str = "item_id", gap_minutes: int = 30) -> DataFrame:
    """(user_id, session_us, slice, piece, whole, values): sessions in pieces of at most one Arrow batch.

    Events (user_id, item_id, event_us[, value]); the order is by time, then
    item. Rows without user or time are left out, a null value stays. Events are
    range-partitioned by (user, time), sorted and checkpointed; one pass over
    each slice cuts the sessions, so neither a user nor a session is a group and
    a session of any length costs a task one batch. ``whole`` marks pieces that
    are complete sessions; the others are in order by (slice, piece).
    """
    gap = gap_minutes * 60_000_000
    order = list(dict.fromkeys(["user_id", "event_us", "item_id", value]))
    known = events.where(F.col("user_id").isNotNull() & F.col("event_us").isNotNull()).select(*order)
    ordered = cut_lineage(known.repartitionByRange(*order).sortWithinPartitions(*order))
    begins = _slice_edges(ordered, gap)

    def cut(batches):
        here = TaskContext.get().partitionId()
        start, before, count = begins.get(here), None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            users, us = batch.column(0), batch.column(1).to_numpy()
            opens = _openings(users, us, gap, before)
            heads = np.flatnonzero(opens)
            starts = us[heads]
            if not opens[0]:
                heads, starts = np.r_[0, heads], np.r_[start, starts]
            whole = np.ones(len(heads), dtype=bool)
            whole[0], whole[-1] = bool(opens[0]) and len(heads) > 1, False
            bounds = np.r_[heads, len(us)].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [users.take(pa.array(heads)), pa.array(starts.astype(np.int64)),
                 pa.array(np.full(len(heads), here, dtype=np.int32)),
                 pa.array(count + np.arange(len(heads), dtype=np.int64)), pa.array(whole),
                 pa.ListArray.from_arrays(pa.array(bounds), batch.column(2))],
                names=["user_id", "session_us", "slice", "piece", "whole", "values"])
            start, count = int(starts[-1]), count + len(heads)
            before = users[-1].as_py(), int(us[-1])

    types = {c: ordered.schema[c].dataType.simpleString() for c in ("user_id", value)}
    return ordered.select("user_id", "event_us", value).mapInArrow(
        cut, f"user_id {types['user_id']}, session_us bigint, slice int, piece bigint, "
             f"whole boolean, values array<{types[value]}>")


def _joined_pieces(pieces: DataFrame) -> DataFrame:
    """(user_id, session_us, values): only sessions that a batch cut are brought together, by piece."""
    pieces = stored(pieces, "session-pieces")
    parts = pieces.where("not whole").groupBy("user_id", "session_us").agg(
        F.sort_array(F.collect_list(F.struct("slice", "piece", "values"))).alias("_p"))
    together = parts.select(
        "user_id", "session_us", F.flatten(F.transform("_p", lambda p: p["values"])).alias("values"))
    return pieces.where("whole").select("user_id", "session_us", "values").unionByName(together)


def build_sessions(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """(user_id, session_us, items in time order): one row per session."""
    sessions = _joined_pieces(session_pieces(events, "item_id", gap_minutes))
    return sessions.withColumnRenamed("values", "items")


def session_sentences(events: DataFrame, ids: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """One sentence of item tokens per session; items without an id are left out."""
    tokens = ids.select("item_id", sid_token("semantic_id").alias("token"))
    pieces = session_pieces(events.join(tokens, "item_id", "left"), "token", gap_minutes)
    spoken = pieces.withColumn("values", F.array_compact("values"))
    sessions = _joined_pieces(spoken).where(F.size("values") > 0)
    return sessions.select(
        "user_id", "session_us",
        F.concat_ws(" ", F.concat_ws(" ", "values"), F.lit(END_OF_TEXT)).alias("sentence"),
    )


def token_vocabulary(events: DataFrame, ids: DataFrame) -> DataFrame:
    """Distinct item tokens in use; the items are made distinct before the join."""
    used = events.select("item_id").distinct()
    tokens = ids.join(used, "item_id", "left_semi").select(sid_token("semantic_id").alias("token"))
    return tokens.distinct()


def multi_token_labels(
    anchors: DataFrame, events: DataFrame, beta: float = 0.5, hours: int = 24
) -> DataFrame:
    """Future items of each anchor with weight exp(-beta * hours ahead) * reward."""
    ahead = future_events(anchors, events, hours)
    weight = F.exp(F.lit(-float(beta)) * F.col("hours_ahead")) * F.col("reward")
    return ahead.select("anchor_id", "user_id", "item_id", "hours_ahead", weight.alias("weight"))


def label_logits(labels: DataFrame, pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``labels`` with the dot product of their user's and item's vectors; without either they are dropped.

    ``pairs`` (user_id, item_id) are those that labels may hold. A user meets an
    item in many labels, so vectors are joined to distinct pairs and only the
    product to the labels. ``users`` and ``items`` have an ``embedding``.
    """
    used = pairs.select("user_id", "item_id").distinct()
    vectors = used.join(items.select("item_id", F.col("embedding").alias("_i")), "item_id")
    scored = vectors.join(users.select("user_id", F.col("embedding").alias("_u")), "user_id").select(
        "user_id", "item_id", dot("_u", "_i").alias("logit")
    )
    return labels.join(stored(scored, "pair-logits"), ["user_id", "item_id"])


def weighted_log_softmax_loss(labels: DataFrame, key: str = "anchor_id") -> DataFrame:
    """-sum(w * log_softmax(logit)) per key, the softmax over its labelled rows.

    ``labels`` (key, logit, weight). Two aggregations, so a key's rows are
    never brought together; the labels are stored, as both read them.
    """
    labels = stored(labels.select(key, "logit", "weight"), "label-logits")
    highest = labels.groupBy(key).agg(F.max("logit").alias("_m"))
    scaled = labels.join(highest, key)
    sums = scaled.groupBy(key).agg(
        F.max("_m").alias("_m"),
        F.sum(F.exp(F.col("logit") - F.col("_m"))).alias("_e"),
        F.sum("weight").alias("_w"),
        F.sum(F.col("weight") * F.col("logit")).alias("_wl"),
        F.count("*").alias("labels"),
    )
    loss = rounded(F.col("_w") * (F.col("_m") + F.log("_e")) - F.col("_wl"))
    return sums.select(key, "labels", F.when(loss == 0, F.lit(0.0)).otherwise(loss).alias("loss"))


def sample_negatives(
    targets: DataFrame, vocab_size: int, num_samples: int, seed: int = 42
) -> DataFrame:
    """Targets plus uniform draws with replacement up to ``num_samples`` rows.

    (position, item_id, is_target). A draw may hit a target. Draws follow from
    (seed, position), so they repeat; the vocabulary is below 2^31. The number of targets is counted once.
    """
    spark = targets.sparkSession
    chosen = targets.select(
        F.col("position").cast("bigint").alias("position"), "item_id", F.lit(True).alias("is_target")
    )
    batch = targets.count()
    draws = spark.range(batch, max(batch, num_samples)).select(
        F.col("id").alias("position"),
        (draw(seed, "id") % vocab_size).cast("bigint").alias("item_id"),
        F.lit(False).alias("is_target"),
    )
    return chosen.unionByName(draws)


def sampled_softmax_loss(hidden: DataFrame, embeddings: DataFrame, sample: DataFrame) -> DataFrame:
    """One row: mean cross-entropy of each row's target among the sampled ids.

    ``hidden`` (row_id, target_id, embedding), ``sample`` (item_id, may repeat).
    """
    vectors = embeddings.select("item_id", "embedding")
    drawn = sample.select("item_id").join(vectors, "item_id")
    lse = block_logsumexp(hidden.withColumnRenamed("row_id", "query_id"), drawn)
    target = vectors.select(F.col("item_id").alias("target_id"), F.col("embedding").alias("_t"))
    logits = hidden.join(target, "target_id").select(
        F.col("row_id").alias("query_id"), dot("embedding", "_t").alias("logit")
    )
    losses = logits.join(lse, "query_id").select((F.col("lse") - F.col("logit")).alias("loss"))
    return losses.agg(F.count("*").alias("rows"), rounded(F.avg("loss")).alias("loss"))
