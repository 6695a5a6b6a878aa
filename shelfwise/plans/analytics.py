"""Queries of the aggregates, windows and orderings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import epoch_micros
from shelfwise.operators import counts, ranking, semantic_ids, similarity
from shelfwise.operators.ordering import (
    history_lists, long_order, stable_order, top_k, user_history,
)
from shelfwise.plans.catalog import query
from shelfwise.plans.joins import RECENT_SQL
from shelfwise.plans.views import Views


@query("d01_item_counts", "SELECT * FROM v_counts")
def item_counts(v: Views) -> DataFrame:
    return counts.item_counts(v.interactions)


@query("d02_popularity", "SELECT * FROM v_popularity")
def popularity(v: Views) -> DataFrame:
    return counts.popularity(v.interactions)


def summary_sql(source: str) -> str:
    return f"""SELECT (SELECT count(DISTINCT user_id) FROM {source}) AS users,
      count(*) AS items, CAST(sum(n) AS BIGINT) AS interactions,
      round(avg(n), 6) AS mean_count, round(stddev_samp(n), 6) AS std_count,
      min(n) AS min_count, round(quantile_cont(n, 0.5), 6) AS p50,
      round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.95), 6) AS p95,
      round(quantile_cont(n, 0.99), 6) AS p99, max(n) AS max_count
      FROM (SELECT item_id, count(*) AS n FROM {source} GROUP BY item_id)"""


@query("d03_dataset_summary", summary_sql("v_interactions"))
def summary(v: Views) -> DataFrame:
    return counts.dataset_summary(v.interactions)


@query("d03_dataset_summary_purchases", summary_sql("v_purchases"))
def summary_purchases(v: Views) -> DataFrame:
    return counts.dataset_summary(v.purchases)


@query(
    "d04_tail_buckets",
    """SELECT count(*) FILTER (n = 1) AS exactly_1, count(*) FILTER (n >= 10) AS at_least_10,
         count(*) FILTER (n >= 100) AS at_least_100, count(*) FILTER (n >= 1000) AS at_least_1000
         FROM (SELECT item_id, count(*) AS n FROM v_purchases GROUP BY item_id)""",
)
def tail(v: Views) -> DataFrame:
    return counts.tail_buckets(counts.item_counts(v.purchases))


@query(
    "d05_head_share",
    """WITH v_r AS (SELECT n, row_number() OVER (ORDER BY n DESC, item_id) AS r,
           count(*) OVER () AS items, sum(n) OVER () AS total
         FROM (SELECT item_id, count(*) AS n FROM v_purchases GROUP BY item_id)),
       v_m AS (SELECT * FROM (VALUES ('top_1', 1.0), ('top_10', 10.0), ('top_0.01', 0.01),
         ('top_0.1', 0.1), ('top_0.5', 0.5)) AS t(head, m))
       SELECT head, round(CAST(coalesce(sum(n), 0) AS DOUBLE) / any_value(total), 6) AS share
       FROM v_m JOIN v_r ON r <= CASE WHEN m >= 1 THEN m ELSE floor(items * m) END
       GROUP BY head""",
)
def heads(v: Views) -> DataFrame:
    return counts.head_share(counts.item_counts(v.purchases))


@query(
    "d06_sparsity",
    """SELECT count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
         count(*) AS rows, round(1 - count(*) / (count(DISTINCT user_id) *
           count(DISTINCT item_id)), 6) AS sparsity FROM v_purchases""",
)
def sparse(v: Views) -> DataFrame:
    return counts.sparsity(v.purchases)


SHIFT_SQL = """SELECT c.*, late - early AS shift, title FROM (
      SELECT item_id, count(*) FILTER (event_us <= m) AS early,
        count(*) FILTER (event_us > m) AS late
      FROM (SELECT item_id, epoch_us(ts) AS event_us FROM {source}),
        (SELECT quantile_cont(epoch_us(ts), 0.5) AS m FROM {source})
      GROUP BY item_id) c LEFT JOIN v_items USING (item_id)"""


@query("d07_popularity_shift", SHIFT_SQL.format(source="v_interactions"))
def shift(v: Views) -> DataFrame:
    return counts.popularity_shift(v.events, v.items)


@query("d07_popularity_shift_purchases", SHIFT_SQL.format(source="v_purchases"))
def shift_purchases(v: Views) -> DataFrame:
    timed = v.purchases.withColumn("event_us", epoch_micros("ts"))
    return counts.popularity_shift(timed, v.items)


@query(
    "d08_volume_by_period",
    """SELECT CAST(epoch(p) AS BIGINT) AS period_s, coalesce(n, 0) AS volume FROM (
         SELECT unnest(generate_series(date_trunc('month', min(ts)), date_trunc('month', max(ts)),
           INTERVAL 1 MONTH)) AS p FROM v_purchases)
         LEFT JOIN (SELECT date_trunc('month', ts) AS p2, count(item_id) AS n FROM v_purchases
           GROUP BY 1) ON CAST(p AS DATE) = CAST(p2 AS DATE)""",
)
def volume(v: Views) -> DataFrame:
    months = counts.volume_by_period(v.purchases, "month")
    return months.select(F.unix_seconds(F.col("period").cast("timestamp")).alias("period_s"), "volume")


def histogram_sql(bins: int, x: str) -> str:
    return f"""WITH v_x AS (SELECT {x} AS x FROM (
          SELECT item_id, count(*) AS n FROM v_purchases GROUP BY item_id)),
        v_e AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM v_x),
        v_b AS (SELECT CAST(least(CASE WHEN w > 0 THEN floor((x - lo) / w) ELSE 0 END, {bins - 1})
          AS BIGINT) AS bin FROM v_x, v_e)
      SELECT b.bin, round(lo + b.bin * w, 6) AS bin_start,
        (SELECT count(*) FROM v_b WHERE v_b.bin = b.bin) AS items
      FROM (SELECT unnest(generate_series(0, {bins - 1})) AS bin) b, v_e"""


@query("d09_count_histogram", histogram_sql(40, "CAST(n AS DOUBLE)"))
def histogram(v: Views) -> DataFrame:
    return counts.count_histogram(counts.item_counts(v.purchases), 40)


@query("d09_count_histogram_log1p", histogram_sql(50, "ln(1 + n)"))
def histogram_log(v: Views) -> DataFrame:
    return counts.count_histogram(counts.item_counts(v.purchases), 50, log1p=True)


@query(
    "d10_long_tail_curve",
    """SELECT row_number() OVER (ORDER BY interactions DESC, item_id) AS rank, item_id,
         interactions FROM (SELECT item_id, count(*) AS interactions FROM v_purchases
         GROUP BY item_id)""",
)
def long_tail(v: Views) -> DataFrame:
    return counts.long_tail_curve(counts.item_counts(v.purchases))


@query("d11_user_item_counts", "SELECT * FROM v_ui")
def user_items(v: Views) -> DataFrame:
    return counts.user_item_counts(v.interactions)


POPULAR_SQL = """v_lists AS (SELECT c.user_id, p.item_id, p.popularity, row_number() OVER
      (PARTITION BY c.user_id ORDER BY p.popularity DESC, p.item_id) AS rank
      FROM (SELECT c_custkey AS user_id FROM customer) c CROSS JOIN (
        SELECT * FROM v_popularity ORDER BY popularity DESC, item_id LIMIT 1000) p
      ANTI JOIN v_history h ON h.user_id = c.user_id AND h.item_id = p.item_id
      QUALIFY rank <= 10)"""


def popular_lists(v: Views) -> DataFrame:
    return ranking.recommend_popular(v.requests, v.interactions, 10)


@query(
    "d12_genre_distribution",
    "WITH " + POPULAR_SQL + """ SELECT genre, count(*) AS recommended FROM v_lists JOIN
      (SELECT item_id, unnest(genres) AS genre FROM v_items) USING (item_id) GROUP BY genre""",
)
def genre_share(v: Views) -> DataFrame:
    return counts.genre_distribution(popular_lists(v), v.items)


@query(
    "d13_exposure_distribution",
    "WITH " + POPULAR_SQL + """ SELECT item_id, count(*) AS times,
      round(count(*) / (SELECT count(*) FROM v_lists), 6) AS share FROM v_lists GROUP BY item_id""",
)
def exposure(v: Views) -> DataFrame:
    return counts.exposure_distribution(popular_lists(v))


@query(
    "d14_list_overlap",
    "WITH " + POPULAR_SQL + """, v_top AS (SELECT c_custkey AS user_id, item_id FROM customer
        CROSS JOIN (SELECT item_id FROM v_popularity ORDER BY popularity DESC, item_id LIMIT 10))
      SELECT t.user_id, count(l.item_id) AS shared, 10 - count(l.item_id) AS changed
      FROM v_top t LEFT JOIN v_lists l ON l.user_id = t.user_id AND l.item_id = t.item_id
      GROUP BY t.user_id""",
)
def overlap(v: Views) -> DataFrame:
    plain = similarity.unseen_from_pool(
        v.requests.select("user_id"), counts.popular_items(v.interactions, 10),
        user_history(v.interactions).limit(0), 10, ["item_id", "popularity"],
    )
    return counts.list_overlap(plain, popular_lists(v), 10)


@query("d15_merge_by_max", "WITH " + RECENT_SQL.format(n=10) + " SELECT * FROM v_cand")
def max_merge(v: Views) -> DataFrame:
    near = similarity.similar_items(v.edges, None, 50)
    seeds = user_history(v.interactions, 10)
    found = seeds.join(near, "item_id").select(
        "user_id", F.col("other_id").alias("item_id"), "similarity"
    )
    return counts.merge_by_max(found)


SEEDS_SQL = (
    RECENT_SQL.format(n=5) + """, v_pool AS (
      SELECT item_id FROM v_popularity ORDER BY popularity DESC, item_id LIMIT 30),
    v_seeds AS (SELECT * FROM v_recent SEMI JOIN v_counts USING (item_id)),
    v_score AS (SELECT c.user_id, c.item_id,
        round(coalesce({agg}(CASE WHEN s.item_id = c.item_id THEN 1.0
          ELSE coalesce(e.similarity, 0.0) END), 0.0) + 1e-9, 6) AS seed_similarity
      FROM (SELECT u.user_id, p.item_id FROM (SELECT DISTINCT user_id FROM v_history) u
            CROSS JOIN v_pool p) c
      LEFT JOIN v_seeds s ON s.user_id = c.user_id
      LEFT JOIN v_edges e ON e.item_id = s.item_id AND e.other_id = c.item_id
      GROUP BY c.user_id, c.item_id)"""
)


def seed_candidates(v: Views) -> DataFrame:
    """The 30 most popular items for every user with a history."""
    users = v.interactions.select("user_id").distinct()
    nothing = user_history(v.interactions).limit(0)
    pool = counts.popular_items(v.interactions, 30)
    listed = similarity.unseen_from_pool(users, pool, nothing, 30, ["item_id"])
    return listed.select("user_id", "item_id")


def scored_seeds(v: Views, agg: str) -> DataFrame:
    seeds = user_history(v.interactions, 5)
    known = counts.item_counts(v.interactions)
    return counts.score_vs_seeds(seed_candidates(v), seeds, v.edges, known, agg)


@query("d16_score_vs_seeds_max", "WITH " + SEEDS_SQL.format(agg="max") + " SELECT * FROM v_score")
def seeds_max(v: Views) -> DataFrame:
    return scored_seeds(v, "max")


@query("d16_score_vs_seeds_mean", "WITH " + SEEDS_SQL.format(agg="avg") + " SELECT * FROM v_score")
def seeds_mean(v: Views) -> DataFrame:
    return scored_seeds(v, "mean")


RATES_SQL = """v_rates AS (SELECT time_bucket(INTERVAL '{interval}', ts) AS interval_start, item_id,
      count(*) AS impressions, count(*) FILTER (event_type = 'click') AS clicks,
      round(count(*) FILTER (event_type = 'click') / count(*), 6) AS rate
      FROM v_interactions WHERE event_type IN ('view', 'click') GROUP BY ALL)"""


@query(
    "d17_interval_response_rates",
    "WITH " + RATES_SQL.format(interval="10 minutes") + """ SELECT
      CAST(epoch(interval_start) AS BIGINT) AS start_s, item_id, impressions, clicks, rate
      FROM v_rates""",
)
def rates(v: Views) -> DataFrame:
    found = counts.interval_response_rates(v.events, "10 minutes")
    start = F.unix_seconds(F.col("interval_start").cast("timestamp")).alias("start_s")
    return found.select(start, "item_id", "impressions", "clicks", "rate")


@query(
    "d18_overall_response_rate",
    """SELECT count(*) FILTER (event_type = 'click') AS clicks, count(*) AS impressions,
         round(count(*) FILTER (event_type = 'click') / count(*), 6) AS rate
         FROM v_interactions WHERE event_type IN ('view', 'click')""",
)
def overall_rate(v: Views) -> DataFrame:
    return counts.overall_response_rate(counts.interval_response_rates(v.events))


@query(
    "d19_item_support",
    """SELECT i.item_id, coalesce(c.interactions, 0) AS interactions,
         coalesce(n.neighbours, 0) AS neighbours FROM v_items i LEFT JOIN v_counts c USING (item_id)
         LEFT JOIN (SELECT item_id, count(*) AS neighbours FROM v_edges GROUP BY item_id) n
         USING (item_id)""",
)
def support(v: Views) -> DataFrame:
    return counts.item_support(v.interactions, v.items, v.edges)


@query(
    "d20_median_activity_user",
    """SELECT user_id, interactions FROM (SELECT *, row_number() OVER
         (ORDER BY interactions, user_id) - 1 AS pos, count(*) OVER () AS n FROM (
         SELECT user_id, count(*) AS interactions FROM v_purchases GROUP BY user_id))
         WHERE pos = n // 2""",
)
def median_user(v: Views) -> DataFrame:
    return counts.median_activity_user(v.purchases)


@query("e01_user_history", "SELECT * FROM v_history")
def history(v: Views) -> DataFrame:
    return user_history(v.interactions)


@query(
    "e01_user_history_last",
    "WITH " + RECENT_SQL.format(n=5) + """ SELECT user_id,
      array_to_string(list(item_id ORDER BY item_id), ',') AS items FROM v_recent GROUP BY user_id""",
)
def last_history(v: Views) -> DataFrame:
    lists = history_lists(v.interactions, 5)
    return lists.select("user_id", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@query(
    "e02_top_k",
    """SELECT user_id, item_id, n, row_number() OVER (PARTITION BY user_id
         ORDER BY n DESC, item_id) AS rank FROM (SELECT user_id, item_id, count(*) AS n
         FROM v_purchases GROUP BY ALL) QUALIFY rank <= 5""",
)
def best_per_user(v: Views) -> DataFrame:
    return top_k(counts.user_item_counts(v.purchases), 5, by="n", per="user_id")


@query(
    "e02_top_k_overall",
    """SELECT user_id, item_id, n, row_number() OVER (ORDER BY n DESC, user_id, item_id) AS rank
         FROM (SELECT user_id, item_id, count(*) AS n FROM v_purchases GROUP BY ALL)
         QUALIFY rank <= 100""",
)
def best_overall(v: Views) -> DataFrame:
    return top_k(counts.user_item_counts(v.purchases), 100, by="n", tie=["user_id", "item_id"])


@query(
    "e03_leaf_numbers",
    """SELECT item_id, c0, c1, title, row_number() OVER (PARTITION BY c0, c1
         ORDER BY title NULLS LAST, item_id) - 1 AS leaf_id FROM v_ids JOIN v_items USING (item_id)""",
)
def leaves(v: Views) -> DataFrame:
    named = v.ids.join(v.items.select("item_id", "title"), "item_id")
    return semantic_ids.leaf_numbers(named).select(
        "item_id", F.col("semantic_id")[0].alias("c0"), F.col("semantic_id")[1].alias("c1"),
        "title", "leaf_id",
    )


@query(
    "e04_serving_plan",
    "WITH " + RATES_SQL.format(interval="1 hour") + """,
      v_grid AS (SELECT g.slot, i.item_id, coalesce(r.rate, 0.0) AS rate, i.n
        FROM (SELECT unnest(generate_series(min(interval_start), max(interval_start),
                INTERVAL 1 HOUR)) AS slot FROM v_rates) g
        CROSS JOIN (SELECT DISTINCT item_id, (SELECT count(DISTINCT item_id) FROM v_rates) AS n
                    FROM v_rates) i
        LEFT JOIN v_rates r ON r.interval_start = g.slot AND r.item_id = i.item_id),
      v_means AS (SELECT slot, item_id, n, round(avg(rate) OVER (PARTITION BY item_id ORDER BY slot
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS mean_rate,
          dense_rank() OVER (ORDER BY slot) - 1 AS interval FROM v_grid)
      SELECT interval, item_id, mean_rate,
        round(CASE WHEN interval = 0 THEN 1.0 / n ELSE CAST(1 AS DOUBLE) / 3 END, 6) AS share,
        CAST(floor(CASE WHEN interval = 0 THEN 1 / n ELSE 1 / 3 END * 200) AS BIGINT) AS planned
      FROM v_means QUALIFY interval = 0 OR row_number() OVER (PARTITION BY interval
        ORDER BY mean_rate DESC, item_id) <= 3""",
)
def serving(v: Views) -> DataFrame:
    hourly = counts.interval_response_rates(v.events, "1 hour")
    return counts.serving_plan(hourly, 1, 200, 3)


@query(
    "e05_rank_comparison",
    "WITH " + RECENT_SQL.format(n=10) + """,
      v_lists AS (SELECT w.name AS list, c.user_id, c.item_id, row_number() OVER
          (PARTITION BY w.name, c.user_id ORDER BY round(w.w * c.similarity
            + (1 - w.w) * p.popularity + 1e-9, 6) DESC, c.item_id) AS rank
        FROM v_cand c JOIN v_popularity p USING (item_id) CROSS JOIN (VALUES ('similarity',
          CAST(1 AS DOUBLE)), ('mixed', CAST(0.5 AS DOUBLE)), ('popularity', CAST(0 AS DOUBLE)))
          AS w(name, w) QUALIFY rank <= 10)
      SELECT user_id, item_id, max(rank) FILTER (list = 'similarity') AS similarity,
        max(rank) FILTER (list = 'mixed') AS mixed, max(rank) FILTER (list = 'popularity')
        AS popularity FROM v_lists GROUP BY user_id, item_id""",
)
def ranks(v: Views) -> DataFrame:
    near = similarity.similar_items(v.edges, None, 50)
    candidates = ranking.neighbours_of_recent(v.interactions, near, 10).join(v.popularity, "item_id")
    swept = ranking.weight_sweep(candidates, (1.0, 0.5, 0.0), 10)
    name = (
        F.when(F.col("weight") == 1.0, "similarity").when(F.col("weight") == 0.5, "mixed")
        .otherwise("popularity")
    )
    lists = swept.select("user_id", "item_id", "rank", name.alias("list"))
    return counts.rank_comparison(
        lists, ["similarity", "mixed", "popularity"], ["user_id", "item_id"]
    )


@query(
    "e06_stable_order",
    """SELECT item_id, popularity, row_number() OVER (ORDER BY popularity DESC, item_id) AS position
         FROM v_popularity""",
)
def ordered(v: Views) -> DataFrame:
    return long_order(stable_order(v.popularity, "popularity"), "popularity")
