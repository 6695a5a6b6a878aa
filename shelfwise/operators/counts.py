"""Popularity, long tail, activity, exposure and response-rate aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.joins import attach_metadata
from shelfwise.operators.ordering import global_position, ratio, rounded, rounded_blend, top_k
from shelfwise.operators.spread import spread_join
from shelfwise.operators.sweeps import SWEEP_ROWS, best_spans
from shelfwise.session import stored


def item_counts(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("item_id").isNotNull())
        .groupBy("item_id")
        .agg(F.count("*").alias("interactions"))
    )


def popularity(df: DataFrame) -> DataFrame:
    """Interactions divided by those of the most popular item."""
    counts = item_counts(df)
    most = counts.agg(F.max("interactions")).scalar()
    return counts.select("item_id", rounded(F.col("interactions") / most).alias("popularity"))


def popular_items(df: DataFrame, n: int = 1000) -> DataFrame:
    return top_k(popularity(df), n, by="popularity")


def trailing_window(df: DataFrame, ts: str = "ts", days: int = 365) -> DataFrame:
    newest = df.agg(F.max(ts)).scalar()
    return df.where(F.col(ts) >= newest - F.expr(f"INTERVAL {int(days)} DAYS"))


def count_of_counts(counts: DataFrame) -> DataFrame:
    """How many items have each interaction count: small however many items exist."""
    return counts.groupBy("interactions").agg(F.count("*").alias("items"))


def dataset_summary(df: DataFrame) -> DataFrame:
    """Users, items, interactions and the distribution of per-item counts."""
    n = F.col("interactions")
    freq = F.col("items")
    spread = count_of_counts(item_counts(df)).agg(
        F.sum(freq).alias("items"),
        F.sum(n * freq).alias("interactions"),
        F.sum((n * n).cast("double") * freq).alias("_squares"),
        F.min(n).alias("min_count"),
        F.max(n).alias("max_count"),
        *[
            rounded(F.percentile(n, F.lit(p / 100), freq)).alias(f"p{p}")
            for p in (50, 90, 95, 99)
        ],
    )
    users = df.select("user_id").distinct().agg(F.count("user_id"))
    mean = ratio("interactions", "items")
    var = ratio(F.col("_squares") - F.col("items") * mean * mean, F.col("items") - 1)
    return spread.select(
        users.scalar().alias("users"), "items", "interactions",
        rounded(mean).alias("mean_count"),
        rounded(F.sqrt(F.when(var > 0, var).when(var <= 0, F.lit(0.0)))).alias("std_count"),
        "min_count", "p50", "p90", "p95", "p99", "max_count",
    )


def tail_buckets(counts: DataFrame) -> DataFrame:
    n = F.col("interactions")
    return counts.agg(
        F.count_if(n == 1).alias("exactly_1"),
        *[F.count_if(n >= m).alias(f"at_least_{m}") for m in (10, 100, 1000)],
    )


def head_share(
    counts: DataFrame,
    fractions: Sequence[float] = (0.01, 0.1, 0.5),
    heads: Sequence[int] = (1, 10),
) -> DataFrame:
    """Share of interactions held by the most popular items: fixed heads and fractions.

    Works on the count-of-counts: items with equal counts are interchangeable,
    so no item has to be ranked.
    """
    everything = Window.partitionBy()
    down = Window.orderBy(F.col("interactions").desc())
    spread = count_of_counts(counts).select(
        "interactions",
        "items",
        (F.sum("items").over(down) - F.col("items")).alias("_before"),
        F.sum("items").over(everything).alias("_items"),
        F.sum(F.col("items") * F.col("interactions")).over(everything).alias("_total"),
    )
    wanted = F.array(
        *[F.struct(F.lit(f"top_{h}").alias("head"), F.lit(h).cast("bigint").alias("m"))
          for h in heads],
        *[F.struct(F.lit(f"top_{f:g}").alias("head"),
                   F.floor(F.col("_items") * F.lit(f)).cast("bigint").alias("m"))
          for f in fractions],
    )
    cut = spread.withColumn("_w", F.explode(wanted))
    taken = F.greatest(
        F.least(F.col("items"), F.col("_w.m") - F.col("_before")), F.lit(0).cast("bigint")
    )
    return cut.groupBy(F.col("_w.head").alias("head")).agg(
        rounded(F.sum(taken * F.col("interactions")) / F.max("_total")).alias("share")
    )


def sparsity(df: DataFrame) -> DataFrame:
    items = item_counts(df).agg(F.count("*").alias("items"), F.sum("interactions").alias("rows"))
    users = df.select("user_id").distinct().agg(F.count("user_id"))
    items = items.withColumn("users", users.scalar())
    density = ratio(F.col("rows"), F.col("users") * F.col("items"))
    return items.select(
        "users", "items", "rows", rounded(F.lit(1.0) - density).alias("sparsity")
    )


def exact_quantile(
    values: DataFrame, col: str, p: float, widths: Sequence[int] = (3_600_000_000, 1_000_000)
) -> DataFrame:
    """One row: the exact interpolated quantile of a BIGINT column, as ``quantile``.

    Counts per coarse slice find the slices that hold the two neighbouring
    ranks; only those are counted again at the next finer width, and at last by
    value. No task ever holds the values.
    """
    base = stored(values.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull()), "values")
    picks = None
    for width in [*widths, 1]:
        slice_of = F.floor(F.col("_v") / width).cast("bigint")
        if picks is None:
            sizes = base.groupBy(slice_of.alias("_s")).agg(F.count("*").alias("_n"))
            rank = F.col("_rank")
            ends = F.array(
                F.struct(F.lit(0).alias("end"), F.floor(rank).alias("r"), rank.alias("at")),
                F.struct(F.lit(1).alias("end"), F.ceil(rank).alias("r"), rank.alias("at")),
            )
            before = F.sum("_n").over(Window.orderBy("_s")) - F.col("_n")
            sizes = sizes.withColumns({
                "_rank": (F.sum("_n").over(Window.partitionBy()) - 1) * F.lit(p), "_b": before
            })
            cells = sizes.select("_s", "_n", "_b", F.explode(ends).alias("_e"))
            cells = cells.select("_s", "_n", "_b", "_e.end", "_e.r", "_e.at")
        else:
            inside = base.withColumn("_outer", F.floor(F.col("_v") / outer_width).cast("bigint"))
            inside = inside.join(F.broadcast(picks), "_outer")
            sizes = inside.groupBy("end", "r", "at", slice_of.alias("_s")).agg(
                F.count("*").alias("_n")
            )
            before = F.sum("_n").over(Window.partitionBy("end").orderBy("_s")) - F.col("_n")
            cells = sizes.select("_s", "_n", before.alias("_b"), "end", "r", "at")
        hit = (F.col("_b") <= F.col("r")) & (F.col("r") < F.col("_b") + F.col("_n"))
        picks = cells.where(hit).select(
            F.col("_s").alias("_outer"), "end", (F.col("r") - F.col("_b")).alias("r"), "at"
        )
        outer_width = width
    low = F.max(F.when(F.col("end") == 0, F.col("_outer")))
    high = F.max(F.when(F.col("end") == 1, F.col("_outer")))
    part = F.max("at") - F.floor(F.max("at"))
    return picks.agg((low + (high - low) * part).alias("quantile"))


def popularity_shift(df: DataFrame, items: DataFrame, us: str = "event_us") -> DataFrame:
    """Per-item counts up to and after the median event time, and their difference."""
    middle = exact_quantile(df, us, 0.5)
    timed = df.where(F.col("item_id").isNotNull() & F.col(us).isNotNull())
    counts = (
        timed.select("item_id", (F.col(us) > middle.scalar()).alias("_late"))
        .groupBy("item_id")
        .agg(F.count_if(~F.col("_late")).alias("early"), F.count_if("_late").alias("late"))
        .withColumn("shift", F.col("late") - F.col("early"))
    )
    return attach_metadata(counts, items, ["title"])


def volume_by_period(df: DataFrame, freq: str = "month", ts: str = "ts") -> DataFrame:
    """Rows with an item per calendar period; periods without any count 0."""
    period = F.to_date(F.date_trunc(freq, ts)).alias("period")
    counts = df.groupBy(period).agg(F.count("item_id").alias("n"))
    ends = counts.agg(F.min("period").alias("a"), F.max("period").alias("b"))
    step = F.expr(f"INTERVAL 1 {freq}")
    calendar = ends.select(F.explode(F.sequence("a", "b", step)).alias("period"))
    volume = F.coalesce("n", F.lit(0)).alias("volume")
    return calendar.join(counts, "period", "left").select("period", volume)


def count_histogram(counts: DataFrame, bins: int = 40, log1p: bool = False) -> DataFrame:
    """Equal-width histogram of the counts; every bin is listed, the last one is closed."""
    spread = count_of_counts(counts)
    x = F.log1p("interactions") if log1p else F.col("interactions").cast("double")
    spread = spread.select(x.alias("x"), "items")
    ends = spread.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    spread = spread.withColumn("_ends", ends.select(F.struct("lo", "hi")).scalar())
    spread = spread.select("x", "items", "_ends.lo", "_ends.hi")
    width = (F.col("hi") - F.col("lo")) / bins
    slot = F.when(width > 0, F.floor((F.col("x") - F.col("lo")) / width)).otherwise(F.lit(0))
    filled = (
        spread.groupBy(F.least(slot, F.lit(bins - 1)).cast("bigint").alias("bin"))
        .agg(F.sum("items").alias("n"))
    )
    edges = ends.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1))).alias("bin"), "lo", "hi"
    )
    return edges.join(filled, "bin", "left").select(
        "bin",
        rounded(F.col("lo") + F.col("bin") * width).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("items"),
    )


def long_tail_curve(counts: DataFrame) -> DataFrame:
    order = [F.col("interactions").desc(), F.col("item_id").asc()]
    return global_position(counts, order, "rank").select("rank", "item_id", "interactions")


def user_item_counts(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
        .groupBy("user_id", "item_id")
        .agg(F.count("*").alias("n"))
    )


def user_item_wide(counts: DataFrame, items: Sequence[int]) -> DataFrame:
    """Display form with one column per item of a given short list."""
    return counts.groupBy("user_id").pivot("item_id", list(items)).sum("n").na.fill(0)


def genre_distribution(recs: DataFrame, items: DataFrame) -> DataFrame:
    """Recommended items per genre; the list is counted per item before the join."""
    per_item = recs.groupBy("item_id").agg(F.count("*").alias("n"))
    tagged = items.select("item_id", F.explode("genres").alias("genre"))
    return per_item.join(tagged, "item_id").groupBy("genre").agg(F.sum("n").alias("recommended"))


def exposure_distribution(recs: DataFrame) -> DataFrame:
    counts = recs.groupBy("item_id").agg(F.count("*").alias("times"))
    total = counts.agg(F.sum("times")).scalar()
    return counts.select("item_id", "times", rounded(F.col("times") / total).alias("share"))


def list_overlap(a: DataFrame, b: DataFrame, k: int, key: str = "user_id") -> DataFrame:
    """Per request: items in both lists, and places of the k that changed.

    Rows of both lists are dealt by the request over a set number of parts and
    counted there: neither list is taken for small, and a part holds whole
    requests, so nothing is shuffled twice.
    """
    parts = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    rows = a.select(key, "item_id", one.alias("_a"), none.alias("_b")).unionByName(
        b.select(key, "item_id", none.alias("_a"), one.alias("_b"))
    )
    items = rows.repartition(parts, key).groupBy(key, "item_id").agg(
        F.sum("_a").alias("_a"), F.sum("_b").alias("_b")
    )
    met = F.when(F.col(key).isNotNull() & F.col("item_id").isNotNull(), F.col("_a") * F.col("_b"))
    kept = F.coalesce(F.sum(met), F.lit(0)).cast("bigint")
    return (
        items.groupBy(key).agg(F.sum("_a").alias("_a"), kept.alias("shared")).where(F.col("_a") > 0)
        .select(key, "shared", (F.lit(k) - F.col("shared")).cast("bigint").alias("changed"))
    )


def merge_by_max(candidates: DataFrame, signal: str = "similarity") -> DataFrame:
    return candidates.groupBy("user_id", "item_id").agg(F.max(signal).alias(signal))


def score_vs_seeds(
    candidates: DataFrame, seeds: DataFrame, edges: DataFrame, known: DataFrame, agg: str = "max"
) -> DataFrame:
    """Max or mean similarity of each candidate to all known seeds of its user.

    An absent edge is 0 and counts in the mean, an item is similar to itself
    with 1, an unknown candidate scores 0. Only existing edges to candidates are
    joined; the zeros enter through the number of seeds.
    """
    known_seeds = stored(seeds.select("user_id", "item_id").join(known.select("item_id"), "item_id"), "known-seeds")
    seed_counts = known_seeds.groupBy("user_id").agg(F.count("*").alias("_seeds"))
    wanted = candidates.select("user_id", "item_id").distinct()
    targets = wanted.select(F.col("item_id").alias("other_id")).distinct()
    block = edges.join(targets, "other_id", "left_semi")
    near = spread_join(known_seeds, block, "item_id").select(
        "user_id", F.col("other_id").alias("item_id"), "similarity"
    )
    near = near.unionByName(known_seeds.withColumn("similarity", F.lit(1.0)))
    sums = (
        near.join(wanted, ["user_id", "item_id"], "left_semi")
        .groupBy("user_id", "item_id")
        .agg(F.sum("similarity").alias("_sum"), F.max("similarity").alias("_max"))
    )
    score = F.col("_max") if agg == "max" else F.col("_sum") / F.col("_seeds")
    return (
        candidates.join(sums, ["user_id", "item_id"], "left")
        .join(seed_counts, "user_id", "left")
        .withColumn("seed_similarity", rounded_blend(F.coalesce(score, F.lit(0.0))))
        .drop("_sum", "_max", "_seeds")
    )


def interval_response_rates(events: DataFrame, interval: str = "10 minutes") -> DataFrame:
    """Per interval and item: impressions (views and clicks), clicks and their ratio."""
    seen = events.where(F.col("event_type").isin("view", "click"))
    counts = seen.groupBy(F.window("ts", interval).alias("_w"), "item_id").agg(
        F.count("*").alias("impressions"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
    )
    return counts.select(
        F.col("_w.start").alias("interval_start"), "item_id", "impressions", "clicks",
        response_rate("clicks", "impressions").alias("rate"),
    )


def response_rate(clicks: str, impressions: str) -> Column:
    return rounded(F.coalesce(ratio(clicks, impressions), F.lit(0.0)))


def overall_response_rate(rates: DataFrame) -> DataFrame:
    totals = rates.agg(F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions"))
    return totals.withColumn("rate", response_rate("clicks", "impressions"))


def item_support(df: DataFrame, items: DataFrame, edges: DataFrame) -> DataFrame:
    """Interactions and number of neighbours of every item; 0 for a cold item."""
    neighbours = edges.groupBy("item_id").agg(F.count("*").alias("_neighbours"))
    return (
        items.select("item_id").distinct()
        .join(item_counts(df), "item_id", "left")
        .join(neighbours, "item_id", "left")
        .select(
            "item_id",
            F.coalesce("interactions", F.lit(0)).alias("interactions"),
            F.coalesce("_neighbours", F.lit(0)).alias("neighbours"),
        )
    )


def median_activity_user(df: DataFrame) -> DataFrame:
    """The user in the middle (position n // 2) by ascending activity, then id."""
    activity = df.groupBy("user_id").agg(F.count("*").alias("interactions"))
    placed = global_position(
        activity, [F.col("interactions").asc(), F.col("user_id").asc()], "_place"
    )
    middle = placed.agg(F.floor(F.max("_place") / 2)).scalar()
    chosen = placed.where(F.col("_place") - 1 == middle)
    return chosen.select("user_id", "interactions")


def serving_plan(
    rates: DataFrame, interval_hours: int, visits: int, top: int = 3, group_rows: int = SWEEP_ROWS
) -> DataFrame:
    """Share of the visits each item gets per interval, from all earlier intervals.

    In the first interval every item gets 1/N; later the ``top`` items by mean
    earlier rate (an interval without data counts 0) get 1/top each. Rates are 0
    or more, a null rate counts 0, rows without item are left out, and several
    rows of an item in one interval count with their mean.

    Means of one interval share their denominator, so only changes of the sums
    are swept, see ``best_spans``; what is ranked is the few best of each group.
    """
    step = interval_hours * 3600
    slot = F.floor(F.unix_seconds(F.col("interval_start").cast("timestamp")) / step)
    rates = stored(
        rates.where(F.col("item_id").isNotNull())
        .groupBy(slot.alias("slot"), "item_id").agg(F.avg(F.coalesce("rate", F.lit(0.0))).alias("rate")),
        "slot-rates",
    )
    spans = best_spans(rates, top, group_rows)
    means = spans.select("item_id", "total", "_a", F.explode(F.sequence("since", "until")).alias("slot")).select(
        (F.col("slot") - F.col("_a")).alias("interval"), "item_id",
        rounded(F.col("total") / (F.col("slot") - F.col("_a"))).alias("mean_rate"),
    )
    later = top_k(means, top, by="mean_rate", per="interval").drop("rank")
    later = later.withColumn("_share", F.lit(1.0) / top)
    items = rates.select("item_id").distinct()
    first = items.select(
        F.lit(0).cast("long").alias("interval"), "item_id", F.lit(None).cast("double").alias("mean_rate"),
        (1.0 / items.agg(F.count("*")).scalar()).alias("_share"),
    )
    share = F.col("_share")
    return later.unionByName(first).select(
        "interval", "item_id", "mean_rate", rounded(share).alias("share"),
        F.floor(share * visits).cast("bigint").alias("planned"),
    )


def rank_comparison(lists: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per key and item with its rank in each named list, null when absent."""
    return lists.groupBy(*keys).pivot("list", list(names)).agg(F.min("rank"))
