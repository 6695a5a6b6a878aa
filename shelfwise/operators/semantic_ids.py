"""Residual quantization: codebooks per level, codes, semantic ids, codebook upkeep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import vectors as V
from shelfwise.functions.draws import normal
from shelfwise.operators.blocks import small_matrix
from shelfwise.operators.ordering import leaf_numbers, rounded
from shelfwise.operators.vector_index import (
    MODEL_CODES, first_k_codebook, kmeans_codebook, nearest_code, residual_codes, settle_codebook,
)
from shelfwise.session import stored

# Fixed values of the training rules.
MIN_SPREAD = 1e-6
EMA_DECAY = 0.9
EMA_EPSILON = 1e-5
USAGE_DECAY = 0.99
NOISE = 0.01
PICK_STEP = 7919


def assign_codes(vectors: DataFrame, codebook: DataFrame) -> DataFrame:
    return nearest_code(vectors, codebook)


def level_of(codebooks: DataFrame, level: int) -> DataFrame:
    return codebooks.where(F.col("level") == level).select("code", "embedding")


def with_centroid(coded: DataFrame, codebook: DataFrame) -> DataFrame:
    centroids = codebook.select("code", F.col("embedding").alias("centroid"))
    small = small_matrix(codebook, MODEL_CODES) is not None
    return coded.join(F.broadcast(centroids) if small else centroids, "code")


def vector_sums(vectors: DataFrame) -> DataFrame:
    """One row over all numbers: rows, count n, sum s and sum of squares q."""
    return vectors.select(
        F.size("embedding").alias("n"),
        F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x).alias("s"),
        V.dot("embedding", "embedding").alias("q"),
    ).agg(F.count("*").alias("rows"), *[F.sum(c).alias(c) for c in "nsq"])


def lloyd_step(vectors: DataFrame, codebook: DataFrame) -> DataFrame:
    """One K-means step; a code without members keeps its centroid."""
    means = V.mean_vectors(assign_codes(vectors, codebook), "code", dim=V.vector_dim(codebook))
    moved = codebook.join(means.withColumnRenamed("embedding", "_mean"), "code", "left")
    return moved.select("code", F.coalesce("_mean", "embedding").alias("embedding"))


def fit_codebooks(
    vectors: DataFrame, sizes: Sequence[int], init: str = "kmeans", iters: int = 2, seed: int = 42
) -> DataFrame:
    """(level, code, embedding): K-means on the residuals of the level before.

    ``init="first_k"`` starts from the K lowest ids and takes ``iters`` plain
    steps. A level whose input has no spread or fewer rows than codes is
    skipped. Residuals are written out between levels.
    """
    residuals = vectors.select("item_id", V.as_doubles("embedding").alias("embedding"))
    books = None
    for level, size in enumerate(sizes):
        if level:
            residuals = stored(residuals, "residuals")
        shape = vector_sums(residuals).select(
            "rows", (F.col("q") / F.col("n") - (F.col("s") / F.col("n")) ** 2).alias("variance")
        ).first()
        if shape["rows"] < size or shape["variance"] < MIN_SPREAD**2:
            continue
        if init == "kmeans":
            book = kmeans_codebook(residuals, size, seed)
        else:
            book = settle_codebook(first_k_codebook(residuals, size))
            for _ in range(iters):
                book = settle_codebook(lloyd_step(residuals, book))
        assigned = with_centroid(assign_codes(residuals, book), book)
        residuals = assigned.select(
            "item_id", V.minus("embedding", "centroid").alias("embedding")
        )
        book = book.select(F.lit(level).cast("bigint").alias("level"), "code", "embedding")
        books = book if books is None else books.unionByName(book)
    if books is None:
        raise ValueError("every level was skipped: too few or identical vectors")
    return books


def residual_quantize(vectors: DataFrame, codebooks: DataFrame, levels: int) -> DataFrame:
    """codes per level, the quantized sum and what is left, in one narrow pass.

    Also keeps ``inputs``: the vector each level quantized. Codebooks that fit a
    task give the codes of all levels at once; with a larger one the levels are searched one after another.
    """
    out = vectors.withColumn("embedding", V.as_doubles("embedding"))
    out = out.withColumns(
        {
            "original": F.col("embedding"),
            "codes": F.array().cast("array<bigint>"),
            "inputs": F.array().cast("array<array<double>>"),
        }
    )
    books = [level_of(codebooks, level) for level in range(levels)]
    together = residual_codes(out, books, "_codes")
    out = out if together is None else together
    for level, book in enumerate(books):
        coded = nearest_code(out, book) if together is None else out.withColumn("code", F.col("_codes")[level])
        # A skipped level has no centroids: its code is 0 and takes nothing away.
        out = with_centroid(coded, book) if not book.isEmpty() else coded.withColumn(
            "centroid", F.transform("embedding", lambda x: F.lit(0.0)))
        out = out.withColumns(
            {
                "codes": F.concat("codes", F.array("code")),
                "inputs": F.concat("inputs", F.array("embedding")),
                "embedding": V.minus("embedding", "centroid"),
            }
        ).drop("code", "centroid")
    return out.drop("_codes").withColumn("quantized", V.minus("original", "embedding")).withColumnsRenamed(
        {"embedding": "residual", "original": "embedding"}
    )


def reconstruct(codes: DataFrame, codebooks: DataFrame, levels: int) -> DataFrame:
    """(item_id, embedding): the sum of the chosen centroids; a skipped level adds nothing."""
    out = codes.select("item_id", "codes")
    total: Column | None = None
    for level in range(levels):
        if level_of(codebooks, level).isEmpty():
            continue
        keyed = out.withColumn("code", F.col("codes")[level])
        out = with_centroid(keyed, level_of(codebooks, level)).drop("code")
        out = out.withColumnRenamed("centroid", f"_c{level}")
        part = F.col(f"_c{level}")
        total = part if total is None else V.plus(total, part)
    return out.select("item_id", total.alias("embedding"))


def assign_semantic_ids(items: DataFrame, codes: DataFrame) -> DataFrame:
    """``semantic_id``, ``leaf_id`` inside it, and their unique concatenation ``final_id``."""
    named = codes.select("item_id", F.col("codes").alias("semantic_id")).join(
        items.select("item_id", "title"), "item_id"
    )
    return leaf_numbers(named).withColumn(
        "final_id", F.concat("semantic_id", F.array("leaf_id"))
    )


def quantization_loss(quantized: DataFrame, codebooks: DataFrame, levels: int,
                      commitment: float = 0.5) -> DataFrame:
    """Per level (1 + c) * mean squared error; level -1 is 0.01 * mean squared remainder."""
    per_level = []
    for level in range(levels):
        after = F.col("inputs")[level + 1] if level + 1 < levels else F.col("residual")
        square = V.dot(after, after)
        per_level.append((F.lit(level), F.sum(square), F.lit(1.0 + commitment)))
    per_level.append((F.lit(-1), F.sum(V.dot("residual", "residual")), F.lit(0.01)))
    cells = F.sum(F.size("residual"))
    rows = F.array(
        *[
            F.struct(l.cast("bigint").alias("level"), rounded(w * s / cells).alias("loss"))
            for l, s, w in per_level
        ]
    )
    return quantized.agg(rows.alias("_r")).select(F.explode("_r").alias("_r")).select("_r.*")


def variance_penalty(vectors: DataFrame) -> DataFrame:
    """One row: (mean over dimensions of the sample std - 1) squared."""
    per_dim = (
        vectors.select(F.posexplode("embedding").alias("dim", "x"))
        .groupBy("dim").agg(F.stddev_samp("x").alias("s"))
    )
    gap = F.avg("s") - 1
    return per_dim.agg(rounded(gap * gap).alias("penalty"))


def ema_update(
    codebook: DataFrame, batch: DataFrame, decay: float = EMA_DECAY, epsilon: float = EMA_EPSILON
) -> DataFrame:
    """Fold a batch (code, embedding) into (code, embedding, cluster_size, embed_avg)."""
    counts = batch.groupBy("code").agg(F.count("*").alias("_n"))
    sums = V.collect_vectors(
        batch.select("code", F.posexplode(V.as_doubles("embedding")).alias("dim", "x"))
        .groupBy("code", "dim").agg(F.sum("x").alias("x")),
        ["code"], "_sum",
    )
    folded = codebook.join(counts, "code", "left").join(sums, "code", "left")
    zeros = F.transform("embed_avg", lambda x: x * 0)
    total = F.coalesce("_sum", zeros)
    folded = folded.select(
        "code",
        (F.col("cluster_size") * decay + F.coalesce("_n", F.lit(0)) * (1 - decay)).alias(
            "cluster_size"
        ),
        F.zip_with("embed_avg", total, lambda a, s: a * decay + s * (1 - decay)).alias("embed_avg"),
    )
    everything = Window.partitionBy()
    n = F.sum("cluster_size").over(everything)
    codes = F.count("*").over(everything)
    smooth = (F.col("cluster_size") + epsilon) / (n + codes * epsilon) * n
    return folded.withColumn("_size", smooth).select(
        "code", F.transform("embed_avg", lambda x: x / F.col("_size")).alias("embedding"),
        "cluster_size", "embed_avg",
    )


def usage_ema(usage: DataFrame, batch: DataFrame, decay: float = USAGE_DECAY) -> DataFrame:
    """(code, usage) smoothed towards each code's share of the batch."""
    counts = batch.groupBy("code").agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    share = F.coalesce(F.col("_n") / total, F.lit(0.0))
    return usage.join(counts, "code", "left").select(
        "code", (F.col("usage") * decay + share * (1 - decay)).alias("usage")
    )


def reset_dead_codes(
    codebook: DataFrame, usage: DataFrame, threshold: float = 1.0, seed: int = 42,
    noise: float = NOISE,
) -> DataFrame:
    """Codes used less than ``threshold`` take a live centroid plus noise; their running counts start anew.

    Returns (code, embedding, dead, cluster_size, embed_avg): a code set anew has
    size 1 and its own vector as running sum. Other codes keep these columns of
    ``codebook``; where it has none, the size is the usage and the sum is the
    vector times the size. Without any live code all stay as they are. Which live
    code and which noise is drawn depends on code, dimension and seed only.
    """
    used = codebook.join(usage, "code", "left")
    count = F.coalesce("used", F.lit(0))
    size = F.col("cluster_size") if "cluster_size" in codebook.columns else count
    marked = used.select("code", "embedding", (count < threshold).alias("dead"), size.cast("double").alias("_size"),
                         *[c for c in ("embed_avg",) if c in codebook.columns])
    live = marked.where(~F.col("dead")).select(
        (F.row_number().over(Window.orderBy("code")) - 1).cast("bigint").alias("_place"),
        F.col("embedding").alias("_live"),
    )
    n_live = live.agg(F.count("*")).scalar()
    place = F.pmod(F.col("code") * PICK_STEP + seed, F.greatest(n_live, F.lit(1)))
    drawn = marked.withColumn("_place", place).join(live, "_place", "left")
    revived = F.col("dead") & F.col("_live").isNotNull()
    fresh = F.transform("_live", lambda x, i: x + F.lit(noise) * normal(seed, F.col("code"), i)) if noise else F.col("_live")
    reset = drawn.withColumn("_reset", revived).withColumn(
        "embedding", F.when(revived, fresh).otherwise(F.col("embedding"))
    ).withColumn("cluster_size", F.when(revived, F.lit(1.0)).otherwise(F.col("_size")))
    total = F.col("embed_avg") if "embed_avg" in codebook.columns else F.transform(
        "embedding", lambda x: x * F.col("cluster_size"))
    return reset.select(
        "code", "embedding", "dead", "cluster_size",
        F.when(F.col("_reset"), F.col("embedding")).otherwise(total).alias("embed_avg"),
    )
