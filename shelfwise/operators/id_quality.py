"""Codebook usage, clustering and coherence measures of semantic ids."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import vectors as V
from shelfwise.operators.blocks import LINES, QUERY_BLOCK, _matrix, block_distance_sums
from shelfwise.operators.ordering import ratio, rounded, top_k
from shelfwise.session import stored

# Thresholds of the reports.
USAGE_TARGET = 80.0
COLLAPSE_LIMIT = 0.05
COHERENCE_CUT = 0.5
# Numbers of a model of label moments: labels x dimensions^2, 64 MB.
MOMENTS = 1 << 23
BOUND_SLACK = 1e-9
GRADES = {
    "reconstruction": (0.9, 0.8),
    "silhouette": (0.4, 0.3),
    "coherence": (0.8, 0.6),
}


def code_histogram(ids: DataFrame) -> DataFrame:
    """Items per (level, code)."""
    codes = ids.select(F.posexplode("semantic_id").alias("level", "code"))
    return codes.groupBy(F.col("level").cast("bigint").alias("level"), "code").agg(
        F.count("*").alias("items")
    )


def _codebook_size(sizes: Sequence[int]) -> Column:
    return F.element_at(F.array(*[F.lit(int(s)) for s in sizes]), (F.col("level") + 1).cast("int"))


def codebook_usage(ids: DataFrame, sizes: Sequence[int]) -> DataFrame:
    share = F.col("used") * 100.0 / _codebook_size(sizes)
    return (
        code_histogram(ids).groupBy("level")
        .agg(
            F.count("*").alias("used"),
            F.min("items").alias("min_items"),
            F.max("items").alias("max_items"),
            rounded(F.avg("items")).alias("mean_items"),
        )
        .withColumn("used_pct", rounded(share))
        .withColumn("low_usage", F.col("used_pct") < USAGE_TARGET)
    )


def _entropy(ids: DataFrame) -> DataFrame:
    """(level, entropy) over used codes: ln n - sum(c ln c) / n, mergeable in one pass."""
    n = F.sum("items")
    weighted = F.sum(F.col("items") * F.log("items"))
    return code_histogram(ids).groupBy("level").agg((F.log(n) - weighted / n).alias("entropy"))


def code_perplexity(ids: DataFrame) -> DataFrame:
    return _entropy(ids).select("level", rounded(F.exp("entropy")).alias("perplexity"))


def usage_imbalance(ids: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Per level 1 - H / ln K and (ln K - H) squared; their sum is the diversity loss."""
    full = F.log(_codebook_size(sizes))
    gap = full - F.col("entropy")
    return _entropy(ids).select(
        "level",
        rounded(1 - F.col("entropy") / full).alias("imbalance"),
        rounded(gap * gap).alias("diversity_loss"),
    )


def collapse_check(ids: DataFrame, sizes: Sequence[int]) -> DataFrame:
    used = codebook_usage(ids, sizes).select(
        (F.col("used") / _codebook_size(sizes)).alias("share")
    )
    return used.agg(rounded(F.min("share")).alias("min_usage")).withColumn(
        "collapsed", F.col("min_usage") < COLLAPSE_LIMIT
    )


def reconstruction_metrics(pairs: DataFrame) -> DataFrame:
    """One row from (embedding, rebuilt): MSE, mean row cosine, correlation of all numbers.

    Every row is first reduced to its sums, so numbers are never exploded.
    """

    def total(name: str) -> Column:
        return F.aggregate(name, F.lit(0.0), lambda acc, x: acc + x)

    rows = pairs.select(
        F.size("embedding").alias("n"),
        V.sq_l2("embedding", "rebuilt").alias("se"),
        V.cosine("embedding", "rebuilt").alias("cosine"),
        total("embedding").alias("sx"),
        total("rebuilt").alias("sy"),
        V.dot("embedding", "embedding").alias("sxx"),
        V.dot("rebuilt", "rebuilt").alias("syy"),
        V.dot("embedding", "rebuilt").alias("sxy"),
    )
    sums = rows.agg(
        *[F.sum(c).alias(c) for c in ("n", "se", "sx", "sy", "sxx", "syy", "sxy")],
        F.avg("cosine").alias("cosine"),
    )
    n = F.col("n")
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / n
    var = (F.col("sxx") - F.col("sx") * F.col("sx") / n) * (
        F.col("syy") - F.col("sy") * F.col("sy") / n
    )
    return sums.select(
        rounded(F.col("se") / n).alias("mse"),
        rounded("cosine").alias("cosine"),
        rounded(F.when(var > 0, cov / F.sqrt(var))).alias("correlation"),
    )


def _label_sums(points: DataFrame, labels: np.ndarray, add: Callable, width: int) -> np.ndarray:
    """One row of ``width`` sums per label: ``add(rows, place)`` over all points of a label in a batch.

    Tasks send a row per label they saw; a label's rows are as many as tasks.
    """
    def partial(batches):
        total, seen = np.zeros((len(labels), width)), np.zeros(len(labels), dtype=bool)
        for batch in batches:
            if batch.num_rows:
                x, place = _matrix(pa.chunked_array([batch.column(0)])), np.searchsorted(labels, batch.column(1))
                for p in np.unique(place):
                    total[p] += add(x[place == p], p)
                    seen[p] = True
        place = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), pa.array(list(total[place]), pa.list_(pa.float64()))], names=["place", "sums"])

    def merge(table: pa.Table) -> pa.Table:
        return pa.table({"place": table["place"][:1],
                         "sums": pa.array([_matrix(table["sums"]).sum(axis=0)], pa.list_(pa.float64()))})

    schema = "place bigint, sums array<double>"
    merged = points.mapInArrow(partial, schema).groupBy("place").applyInArrow(merge, schema)
    total = np.zeros((len(labels), width))
    for r in merged.toLocalIterator():
        total[r["place"]] = r["sums"]
    return total


def near_labels(points: DataFrame, label: str = "label", bound: int = MOMENTS) -> DataFrame | None:
    """(query_id, embedding, cell): each point with its own label and those that may have the least mean distance.

    With mean m and variance w of the squared distances to a label's points,
    their mean distance lies between sqrt(m) * (1 - w / (2 m^2)) and sqrt(m),
    and is at least the distance to the centroid. Both moments follow exactly
    from the label's centroid, covariance and third and fourth moments, so a
    label whose lower bound is above another one's upper bound is left out.
    None if labels x dimensions^2 exceeds ``bound`` (the model travels to the tasks).
    """
    some = points.select(F.size("embedding").alias("dim")).first()
    if some is None:
        return None
    dim = some["dim"]
    most = bound // (dim * dim) if dim > 0 else 0
    sizes = points.groupBy(F.col(label).alias("l")).agg(F.count("*").alias("n")).limit(most + 1).collect()
    if len(sizes) > most:
        return None
    labels, n = (np.array(x) for x in zip(*sorted((r["l"], r["n"]) for r in sizes)))
    rows = points.select(V.as_doubles("embedding").alias("embedding"), F.col(label).cast("bigint").alias("l"))
    n = n[:, None].astype(np.float64)
    centres = _label_sums(rows, labels, lambda x, p: x.sum(axis=0), dim) / n

    def central(x: np.ndarray, p: int) -> np.ndarray:
        r = x - centres[p]
        square = (r * r).sum(axis=1)
        return np.concatenate([[square.sum(), square @ square], square @ r, (r.T @ r).ravel()])

    moments = _label_sums(rows, labels, central, 2 + dim + dim * dim) / n
    model = labels, centres, moments[:, 0], moments[:, 1], moments[:, 2:2 + dim], moments[:, 2 + dim:]
    shared = points.sparkSession.sparkContext.broadcast(model)

    def choose(batches):
        labels, centres, second, fourth, third, spread = shared.value
        # Few rows at a time: a row leaves once per label that is near.
        for batch in (b.slice(low, LINES) for b in batches for low in range(0, b.num_rows, LINES)):
            x, own = _matrix(pa.chunked_array([batch.column(1)])), np.searchsorted(labels, batch.column(2))
            low, high = np.empty((len(x), len(labels))), np.empty((len(x), len(labels)))
            for p in range(len(labels)):
                u = x - centres[p]
                away = (u * u).sum(axis=1)
                mean = away + second[p]
                w = 4 * ((u @ spread[p].reshape(dim, dim)) * u).sum(axis=1) - 4 * u @ third[p]
                w = np.maximum(w + fourth[p] - second[p] ** 2, 0.0)
                high[:, p] = np.sqrt(mean)
                part = np.divide(w, 2 * mean * mean, out=np.zeros(len(x)), where=mean > 0)
                low[:, p] = np.maximum(high[:, p] * (1 - part), np.sqrt(away))
            here = np.arange(len(x))
            high[here, own] = np.inf
            # Bounds are widened by more than their rounding; what is not a number is compared.
            near = ~(low * (1 - BOUND_SLACK) > high.min(axis=1, keepdims=True) * (1 + BOUND_SLACK))
            near[here, own] = True
            row, place = np.nonzero(near)
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(labels[place])],
                names=["query_id", "embedding", "cell"])

    ready = points.select("item_id", V.as_doubles("embedding").alias("embedding"), F.col(label).cast("bigint").alias("l"))
    return ready.mapInArrow(choose, "query_id bigint, embedding array<double>, cell bigint")


def silhouette(
    points: DataFrame, label: str = "label", bound: int = MOMENTS, whole: int = QUERY_BLOCK
) -> DataFrame:
    """One row: exact Euclidean silhouette; singletons count 0, fewer than 2 labels give -1.

    A point is compared with its own label and the labels that can be nearest
    (``near_labels``); a table of at most ``whole`` points, which is one block
    anyway, or with too many labels for that model, is compared as a whole, with
    the same result. Sums are exact, and only (point, label) sums are shuffled.
    Rows without label are left out.
    """
    points = stored(points.select("item_id", "embedding", label).where(F.col(label).isNotNull()), "points")
    sizes = points.groupBy(F.col(label).alias("other")).agg(F.count("*").alias("members"))
    own = points.select("item_id", F.col(label).alias("own"))
    probes = near_labels(points, label, bound) if points.count() > whole else None
    if probes is not None:
        probes = stored(probes, "near-labels")
    sums = block_distance_sums(points, label, probes=probes).join(sizes, "other").join(own, "item_id")
    same = F.col("other") == F.col("own")
    inner = F.max(F.when(same, ratio(F.col("distance"), F.col("members") - 1)))
    outer = F.min(F.when(~same, F.col("distance") / F.col("members")))
    alone = F.max(F.when(same, F.col("members"))) == 1
    scored = sums.groupBy("item_id").agg(
        F.when(alone, F.lit(0.0))
        .otherwise(F.coalesce(ratio(outer - inner, F.greatest(outer, inner)), F.lit(0.0)))
        .alias("s")
    )
    value = F.when(F.count("s") == 0, F.lit(-1.0)).otherwise(F.avg(F.coalesce("s", F.lit(0.0))))
    several = sizes.agg(F.count("*")).scalar()
    return scored.agg(value.alias("v")).select(
        rounded(F.when(several < 2, F.lit(-1.0)).otherwise(F.col("v"))).alias("silhouette")
    )


def calinski_harabasz(points: DataFrame, label: str = "label") -> DataFrame:
    """One row: (between / (k - 1)) / (within / (n - k)); fewer than 2 labels give 0.

    One pass of per-dimension sums per label.
    """
    cells = points.select(
        F.col(label).alias("_l"), F.posexplode(V.as_doubles("embedding")).alias("dim", "x")
    )
    per_label = cells.groupBy("_l", "dim").agg(
        F.count("*").alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q")
    )
    per_dim = per_label.groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("m"), F.count("*").alias("k"),
    )
    n, k = F.max("n"), F.max("k")
    within = F.sum(F.col("q") - F.col("m"))
    between = F.sum(F.col("m") - F.col("s") * F.col("s") / F.col("n"))
    score = ratio(ratio(between, k - 1), ratio(within, n - k))
    return per_dim.agg(
        rounded(F.when(k < 2, F.lit(0.0)).otherwise(score)).alias("calinski_harabasz")
    )


def id_match(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """Fraction of levels equal by position, per pair; unknown items give null."""
    a = ids.select(F.col("item_id").alias("item_a"), F.col("semantic_id").alias("_a"))
    b = ids.select(F.col("item_id").alias("item_b"), F.col("semantic_id").alias("_b"))
    equal = F.aggregate(
        F.zip_with("_a", "_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, e: s + e
    )
    match = rounded(equal / F.greatest(F.size("_a"), F.size("_b")))
    joined = pairs.join(a, "item_a", "left").join(b, "item_b", "left")
    known = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return joined.select(*pairs.columns, F.when(known, match).alias("match"))


def coherence(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """One row: pairs with both items known, how many behave as expected, and the rate."""
    high = (F.col("expected") == "high") & (F.col("match") >= COHERENCE_CUT)
    low = (F.col("expected") == "low") & (F.col("match") < COHERENCE_CUT)
    found = id_match(pairs, ids).where(F.col("match").isNotNull())
    totals = found.agg(F.count("*").alias("pairs"), F.count_if(high | low).alias("passed"))
    return totals.withColumn(
        "pass_rate",
        rounded(F.when(F.col("pairs") > 0, F.col("passed") / F.col("pairs"))),
    )


def id_report(
    reconstruction: DataFrame, silhouettes: DataFrame, coherent: DataFrame
) -> DataFrame:
    """Three graded measures and whether all of them pass, as rows (measure, value, grade)."""
    parts = {
        "reconstruction": reconstruction.select(F.col("cosine").alias("value")),
        "silhouette": silhouettes.select(F.col("silhouette").alias("value")),
        "coherence": coherent.select(F.col("pass_rate").alias("value")),
    }
    rows = None
    for measure, frame in parts.items():
        good, fair = GRADES[measure]
        value = F.col("value")
        grade = F.when(value > good, "good").when(value > fair, "acceptable").otherwise("poor")
        row = frame.select(F.lit(measure).alias("measure"), "value", grade.alias("grade"))
        rows = row if rows is None else rows.unionByName(row)
    bad = rows.agg(F.count_if(F.col("grade") == "poor")).scalar()
    return rows.withColumn("overall_pass", bad == 0)


def id_counts(ids: DataFrame) -> DataFrame:
    groups = ids.groupBy("semantic_id").agg(F.count("*").alias("n"))
    totals = groups.agg(F.sum("n").alias("items"), F.count("*").alias("distinct_ids"))
    return totals.select(
        "items", "distinct_ids",
        rounded(F.col("distinct_ids") * 100.0 / F.col("items")).alias("unique_pct"),
        rounded(F.col("items") / F.col("distinct_ids")).alias("mean_items"),
    )


def largest_group(ids: DataFrame) -> DataFrame:
    """The most frequent semantic id (ties: smallest id) with its size."""
    groups = ids.groupBy("semantic_id").agg(F.count("*").alias("members"))
    return top_k(groups, 1, by="members", tie="semantic_id").drop("rank")


def largest_group_members(ids: DataFrame, items: DataFrame) -> DataFrame:
    best = F.broadcast(largest_group(ids).select("semantic_id"))
    members = ids.join(best, "semantic_id", "left_semi")
    return members.select("item_id").join(items, "item_id")


def largest_group_genres(ids: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    genres = largest_group_members(ids, items).select(F.explode("genres").alias("genre"))
    counts = genres.groupBy("genre").agg(F.count("*").alias("items"))
    return top_k(counts, n, by="items", tie="genre")


def vector_stats(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """Mean, sample std, min and max of all numbers, from per-row sums."""
    rows = vectors.select(
        F.size(vec).alias("n"),
        F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x).alias("s"),
        V.dot(vec, vec).alias("q"),
        F.array_min(vec).alias("lo"),
        F.array_max(vec).alias("hi"),
    )
    t = rows.agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")],
                 F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    mean = F.col("s") / F.col("n")
    var = ratio(F.col("q") - F.col("s") * mean, F.col("n") - 1)
    return t.select(
        rounded(mean).alias("mean"), rounded(F.sqrt(var)).alias("std"),
        rounded("lo").alias("min"), rounded("hi").alias("max"),
    )


def mean_pair_distance(vectors: DataFrame, first: int = 100) -> DataFrame:
    """Mean Euclidean distance among the ``first`` lowest ids, zero diagonal included."""
    few = vectors.orderBy("item_id").limit(first).select(
        "item_id", V.as_doubles("embedding").alias("embedding"), F.lit(0).cast("bigint").alias("_g")
    )
    sums = block_distance_sums(few, "_g")
    n = F.count("*")
    return sums.agg(rounded(F.sum("distance") / (n * n)).alias("mean_distance"))
