"""Queries of the sessions, labels and sampled softmax."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.draws import draw_sql
from shelfwise.operators import sequences
from shelfwise.operators.ordering import rounded
from shelfwise.plans.catalog import query
from shelfwise.plans.files import SENTENCES_SQL, SESSIONS_SQL
from shelfwise.plans.joins import FUTURE_SQL, anchors, rewards
from shelfwise.plans.views import Views


def sessions_sql(gap: int) -> str:
    return "WITH " + SESSIONS_SQL.format(gap=gap) + """ SELECT user_id,
      min(event_us) AS session_us, array_to_string(list(item_id ORDER BY event_us, item_id), ',')
      AS items FROM v_s GROUP BY user_id, session_no"""


def listed(sessions: DataFrame) -> DataFrame:
    items = F.array_join(F.col("items").cast("array<string>"), ",").alias("items")
    return sessions.select("user_id", "session_us", items)


@query("j01_build_sessions", sessions_sql(30))
def sessions(v: Views) -> DataFrame:
    return listed(sequences.build_sessions(v.events, 30))


@query("j01_build_sessions_long", sessions_sql(720))
def long_sessions(v: Views) -> DataFrame:
    return listed(sequences.build_sessions(v.events, 720))


@query("j02_session_sentences", SENTENCES_SQL)
def sentences(v: Views) -> DataFrame:
    return sequences.session_sentences(v.events, v.ids, 720)


@query(
    "j03_token_vocabulary",
    """SELECT DISTINCT 'SID_' || c0 || '_' || c1 AS token FROM v_ids
         SEMI JOIN v_interactions USING (item_id)""",
)
def vocabulary(v: Views) -> DataFrame:
    return sequences.token_vocabulary(v.events, v.ids)


LABEL_SQL = f"""SELECT anchor_id, user_id, item_id, hours_ahead,
      exp(-0.5e0 * hours_ahead) * reward AS weight FROM ({FUTURE_SQL})"""


@query(
    "j04_multi_token_labels",
    f"""SELECT anchor_id, user_id, item_id, round(hours_ahead, 6) AS hours_ahead,
          round(weight, 6) AS weight FROM ({LABEL_SQL})""",
)
def labels(v: Views) -> DataFrame:
    found = sequences.multi_token_labels(anchors(v), rewards(v))
    return found.select(
        "anchor_id", "user_id", "item_id", rounded("hours_ahead").alias("hours_ahead"),
        rounded("weight").alias("weight"),
    )


@query(
    "j05_weighted_log_softmax_loss",
    f"""WITH v_l AS (SELECT anchor_id, weight, list_dot_product(p.embedding, u.embedding) AS logit
          FROM ({LABEL_SQL}) l JOIN v_profiles p USING (user_id) JOIN v_vectors u USING (item_id))
        SELECT anchor_id, labels, CASE WHEN loss = 0 THEN 0.0e0 ELSE loss END AS loss FROM (
          SELECT anchor_id, count(*) AS labels,
            round(sum(weight) * ln(sum(exp(logit))) - sum(weight * logit), 6) AS loss
          FROM v_l GROUP BY anchor_id)""",
)
def label_loss(v: Views) -> DataFrame:
    found = sequences.multi_token_labels(anchors(v), rewards(v))
    scored = sequences.label_logits(found, rewards(v), v.profiles, v.vectors)
    return sequences.weighted_log_softmax_loss(scored)


def targets(v: Views) -> DataFrame:
    """The newest item of every user, positions by user id."""
    newest = v.events.groupBy("user_id").agg(F.max(F.struct("event_us", "item_id")).alias("l"))
    return newest.select(F.col("user_id").alias("position"), F.col("l.item_id").alias("item_id"))


@query(
    "j06_sample_negatives",
    f"""WITH v_t AS (SELECT user_id, item_id FROM v_interactions QUALIFY row_number() OVER
           (PARTITION BY user_id ORDER BY event_us DESC, item_id DESC) = 1),
         v_b AS (SELECT (SELECT count(*) FROM v_t) AS lo, (SELECT count(*) FROM v_interactions) AS hi,
           (SELECT count(*) FROM v_vectors) AS n)
       SELECT user_id AS position, item_id, true AS is_target FROM v_t
       UNION ALL
       SELECT p AS position, {draw_sql(42, "p")} % n AS item_id, false AS is_target
       FROM (SELECT unnest(range(lo, greatest(lo, hi))) AS p, n FROM v_b)""",
)
def negatives(v: Views) -> DataFrame:
    """As many draws as there are interactions, from the whole vocabulary of vectors."""
    return sequences.sample_negatives(targets(v), v.vectors.count(), v.interactions.count())


@query(
    "j07_sampled_softmax_loss",
    """WITH v_t AS (SELECT user_id, item_id FROM v_interactions QUALIFY row_number() OVER
           (PARTITION BY user_id ORDER BY event_us DESC, item_id DESC) = 1),
         v_l AS (SELECT p.user_id, ln(sum(exp(list_dot_product(p.embedding, u.embedding)))) AS lse
           FROM v_profiles p CROSS JOIN v_vectors u GROUP BY p.user_id)
       SELECT count(*) AS rows,
         round(avg(lse - list_dot_product(p.embedding, u.embedding)), 6) AS loss
       FROM v_t JOIN v_profiles p USING (user_id) JOIN v_l USING (user_id)
       JOIN v_vectors u USING (item_id)""",
)
def softmax_loss(v: Views) -> DataFrame:
    """The sample is the whole vocabulary once."""
    wanted = targets(v).select(
        F.col("position").alias("row_id"), F.col("item_id").alias("target_id")
    )
    hidden = wanted.join(v.profiles.withColumnRenamed("user_id", "row_id"), "row_id")
    return sequences.sampled_softmax_loss(hidden, v.vectors, v.vectors.select("item_id"))
