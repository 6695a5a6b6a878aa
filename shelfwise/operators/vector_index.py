"""Vector indexes as tables: flat, clustered, product-quantized and hashed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions import vectors as V
from shelfwise.functions.checks import vector_dim_check
from shelfwise.functions.draws import normal_of
from shelfwise.operators.blocks import _matrix, _round, _scores, block_pairs, block_top_k, small_matrix
from shelfwise.operators.ordering import SCORE_DIGITS, ratio, rounded, top_k
from shelfwise.session import cut_lineage, stored

MODEL_CODES = 16_384
# Sub-codes of all parts together; parts times codes per part, both parameters.
PART_CODES = 1 << 20


def build_flat(vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """Unit vectors by item id; with ``dim`` the lengths are checked first."""
    if dim is not None:
        vector_dim_check(vectors, dim)
    return vectors.select("item_id", V.l2_normalize(V.as_doubles("embedding")).alias("embedding"))


def search_flat(index: DataFrame, queries: DataFrame, k: int = 500) -> DataFrame:
    """Exact top-k by inner product of unit vectors; a query's own item may appear."""
    unit = queries.select("query_id", V.l2_normalize(V.as_doubles("embedding")).alias("embedding"))
    return block_top_k(unit, index, k)


def search_by_item(index: DataFrame, requests: DataFrame, k: int = 100) -> DataFrame:
    """Items nearest to each request's seed item by squared distance, the seed included.

    Every distinct seed is searched once, however many requests name it.
    """
    asked = requests.where(F.col("seed_item_id").isNotNull()).select("request_id", "seed_item_id")
    seeds = index.join(
        asked.select(F.col("seed_item_id").alias("item_id")).distinct(), "item_id", "left_semi"
    ).withColumnRenamed("item_id", "query_id")
    found = block_top_k(seeds, index, k, metric="l2").withColumnsRenamed(
        {"query_id": "seed_item_id", "score": "distance"}
    )
    return asked.join(found, "seed_item_id")


def evaluated_once(udf: Callable) -> Callable:
    """The function as one that Spark does not repeat.

    A join on its result, or an explode of it, adds a filter that Spark moves below the
    function; the function then runs twice, in a second Python worker per core.
    """
    return udf.asNondeterministic()


def nearest_code(vectors: DataFrame, codebook: DataFrame, code: str = "code") -> DataFrame:
    """Add the code of the nearest centroid (squared distance, lowest code on ties).

    A codebook of at most ``MODEL_CODES`` rows travels to the tasks; a larger
    one is searched block by block, by the same distances. Without any centroid
    every vector has code 0.
    """
    model = small_matrix(codebook, MODEL_CODES)
    if model is not None and not len(model[0]):
        return vectors.withColumn(code, F.lit(0).cast("bigint"))
    if model is None:
        centroids = codebook.select(F.col("code").cast("bigint").alias("item_id"), "embedding")
        queries = vectors.select(F.col("item_id").alias("query_id"), "embedding")
        near = block_top_k(queries, centroids, 1, metric="l2", digits=None).select(
            F.col("query_id").alias("item_id"), F.col("item_id").alias(code)
        )
        return vectors.join(near, "item_id", "left")
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("bigint")
    def nearest(embedding: pd.Series) -> pd.Series:
        codes, centroids = shared.value
        x = np.array(embedding.tolist(), dtype=np.float64).reshape(-1, centroids.shape[1])
        return pd.Series(codes[_scores(x, centroids, "l2").argmin(axis=1)])

    return vectors.withColumn(code, evaluated_once(nearest)(V.as_doubles("embedding")))


def residual_codes(vectors: DataFrame, codebooks: Sequence[DataFrame], codes: str = "codes") -> DataFrame | None:
    """Add the codes of all levels, each found in what the centroids before leave, by one Python worker per core.

    A level without centroids has code 0 and takes nothing away. None if a
    level is larger than ``MODEL_CODES``, or none has any centroid.
    """
    models = [small_matrix(book, MODEL_CODES) for book in codebooks]
    if any(m is None for m in models) or not any(len(m[0]) for m in models):
        return None
    shared = vectors.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("array<bigint>")
    def nearest(embedding: pd.Series) -> pd.Series:
        levels = shared.value
        width = max(centroids.shape[1] for _, centroids in levels)
        left = np.array(embedding.tolist(), dtype=np.float64).reshape(-1, width)
        out = np.zeros((len(left), len(levels)), dtype=np.int64)
        for level, (names, centroids) in enumerate(levels):
            if len(names):
                place = _scores(left, centroids, "l2").argmin(axis=1)
                out[:, level] = names[place]
                left = left - centroids[place]
        return pd.Series(list(out))

    return vectors.withColumn(codes, evaluated_once(nearest)(V.as_doubles("embedding")))


def kmeans_codebook(
    vectors: DataFrame, k: int, seed: int = 42, max_iter: int = 20
) -> DataFrame:
    """(code, embedding) centroids by distributed K-means."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    points = vectors.select(array_to_vector(V.as_doubles("embedding")).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter).fit(points)
    centers = np.array(model.clusterCenters())
    return local_codebook(vectors.sparkSession, np.arange(len(centers)), centers)


def local_codebook(spark: SparkSession, codes: np.ndarray, centroids: np.ndarray) -> DataFrame:
    table = pa.table({
        "code": pa.array(np.asarray(codes, dtype=np.int64)),
        "embedding": pa.array(list(np.asarray(centroids, dtype=np.float64))),
    })
    return spark.createDataFrame(table)


def settle_codebook(codebook: DataFrame) -> DataFrame:
    """The same codebook without its lineage: as local rows when small, else checkpointed."""
    model = small_matrix(codebook, MODEL_CODES)
    if model is None:
        return cut_lineage(codebook)
    return local_codebook(codebook.sparkSession, *model)


def first_k_codebook(vectors: DataFrame, k: int) -> DataFrame:
    """The k vectors with the lowest ids as centroids."""
    first = vectors.orderBy("item_id").limit(k)
    code = (F.row_number().over(Window.orderBy("item_id")) - 1).cast("bigint")
    return first.select(code.alias("code"), V.as_doubles("embedding").alias("embedding"))


def default_nlist(vectors: DataFrame) -> int:
    """About the square root of the number of vectors."""
    return max(1, round(vectors.count() ** 0.5))


def ivf_build(
    vectors: DataFrame, nlist: int | None = None, centroids: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(index with a ``cell`` per vector, centroids): each vector goes to its nearest centroid."""
    unit = build_flat(vectors)
    if centroids is None:
        centroids = kmeans_codebook(unit, nlist or default_nlist(unit))
    return nearest_code(unit, centroids, "cell"), centroids


def probed_cells(queries: DataFrame, centroids: DataFrame, nprobe: int) -> DataFrame:
    """(query_id, embedding, cells): the cells of the nprobe nearest centroids of each query, nearest first.

    Nearest by the rounded squared distance, lowest code on ties. Centroids
    that fit a task travel to the queries, which then are read once and not shuffled.
    """
    model = small_matrix(centroids, MODEL_CODES)
    if model is None:
        cells = block_top_k(
            queries, centroids.select(F.col("code").alias("item_id"), "embedding"), nprobe, metric="l2"
        )
        lists = cells.groupBy("query_id").agg(
            F.sort_array(F.collect_list(F.struct("rank", "item_id")))["item_id"].alias("cells"))
        return queries.select("query_id", "embedding").join(lists, "query_id")
    if not len(model[0]):
        return queries.select("query_id", "embedding", F.array(F.lit(0).cast("bigint")).alias("cells"))
    shared = queries.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<bigint>")
    def nearest(embedding: pd.Series) -> pd.Series:
        codes, points = shared.value
        x = np.array(embedding.tolist(), dtype=np.float64).reshape(-1, points.shape[1])
        distance = _round(_scores(x, points, "l2"), 10.0**SCORE_DIGITS)
        return pd.Series(list(codes[np.argsort(distance, axis=1, kind="stable")[:, :nprobe]]))

    return queries.select("query_id", "embedding", evaluated_once(nearest)("embedding").alias("cells"))


def nearest_cells(queries: DataFrame, centroids: DataFrame, nprobe: int) -> DataFrame:
    """(query_id, embedding, cell): each query once per cell of its nprobe nearest centroids."""
    return probed_cells(queries, centroids, nprobe).select("query_id", "embedding", F.explode("cells").alias("cell"))


def ivf_search(
    index: DataFrame, centroids: DataFrame, queries: DataFrame, k: int, nprobe: int = 50
) -> DataFrame:
    """Exact top-k inside the nprobe nearest cells of each query."""
    unit = queries.select("query_id", V.l2_normalize(V.as_doubles("embedding")).alias("embedding"))
    return block_top_k(probed_cells(unit, centroids, nprobe), index, k)


def sub_vectors(vectors: DataFrame, m: int, dim: int, key: str = "item_id") -> DataFrame:
    """(key, sub, embedding): the vector cut into m equal parts."""
    if dim % m:
        raise ValueError(f"{m} parts do not divide {dim} dimensions")
    width = dim // m
    parts = F.array(*[F.slice("embedding", 1 + i * width, width) for i in range(m)])
    return vectors.select(key, F.posexplode(parts).alias("sub", "embedding"))


def pq_first_k_codebooks(vectors: DataFrame, m: int, dim: int, bits: int = 8) -> DataFrame:
    """(sub, code, embedding): sub-vectors of the lowest ids, 2**bits per part."""
    first = vectors.orderBy("item_id").limit(2**bits)
    code = (F.row_number().over(Window.orderBy("item_id")) - 1).cast("bigint").alias("item_id")
    return sub_vectors(
        first.select(code, V.as_doubles("embedding").alias("embedding")), m, dim
    ).withColumnRenamed("item_id", "code")


def pq_kmeans_codebooks(
    vectors: DataFrame, m: int, dim: int, bits: int = 8, seed: int = 42
) -> DataFrame:
    """One K-means per part (m is a small parameter)."""
    books = None
    parts = sub_vectors(build_flat(vectors), m, dim)
    for sub in range(m):
        book = kmeans_codebook(parts.where(F.col("sub") == sub), 2**bits, seed)
        book = book.select(F.lit(sub).alias("sub"), "code", "embedding")
        books = book if books is None else books.unionByName(book)
    return books


def _pq_model(codebooks: DataFrame) -> np.ndarray:
    """The (m, codes, width) array of the sub-codebooks, checked to be small."""
    flat = codebooks.select(
        (F.col("sub").cast("bigint") * F.lit(1 << 20) + F.col("code")).alias("code"), "embedding"
    )
    model = small_matrix(flat, PART_CODES)
    if model is None or not len(model[0]):
        raise ValueError("no sub-codebooks, or beyond the model bound; use fewer bits")
    keys, rows = model
    parts = int(keys.max() >> 20) + 1
    return rows.reshape(parts, -1, rows.shape[1])


def pq_encode(vectors: DataFrame, codebooks: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(item_id, codes) and the kept columns: the nearest sub-centroid of every part."""
    shared = vectors.sparkSession.sparkContext.broadcast(_pq_model(codebooks))

    @F.pandas_udf("array<int>")
    def encode(embedding: pd.Series) -> pd.Series:
        books = shared.value
        parts, _, width = books.shape
        x = np.array(embedding.tolist(), dtype=np.float64).reshape(-1, parts, width)
        codes = [_scores(x[:, p], books[p], "l2").argmin(axis=1) for p in range(parts)]
        return pd.Series(list(np.stack(codes, axis=1).astype(np.int32)))

    return vectors.select("item_id", *keep, encode(V.as_doubles("embedding")).alias("codes"))


def pq_decode(codes: DataFrame, codebooks: DataFrame) -> DataFrame:
    """(item_id, embedding): the sub-centroids put together."""
    shared = codes.sparkSession.sparkContext.broadcast(_pq_model(codebooks))

    @F.pandas_udf("array<double>")
    def decode(column: pd.Series) -> pd.Series:
        books = shared.value
        picked = np.array(column.tolist(), dtype=np.int64).reshape(-1, books.shape[0])
        whole = np.concatenate([books[p][picked[:, p]] for p in range(books.shape[0])], axis=1)
        return pd.Series(list(whole))

    return codes.select("item_id", decode("codes").alias("embedding"))


def pq_lloyd_codebooks(
    vectors: DataFrame, m: int, dim: int, bits: int = 8, iters: int = 2
) -> DataFrame:
    """(sub, code, embedding): plain K-means of all parts at once, from the lowest ids.

    A step is one pass: tasks send sums per part and code, whose number is a
    parameter. A code without members keeps its place.
    """
    spark = vectors.sparkSession
    width = dim // m
    points = vectors.select(V.as_doubles("embedding").alias("embedding"))
    books = _pq_model(pq_first_k_codebooks(vectors, m, dim, bits))
    for _ in range(iters):
        shared = spark.sparkContext.broadcast(books)

        def add(batches):
            model = shared.value
            parts, codes, width = model.shape
            n, total = np.zeros((parts, codes)), np.zeros(model.shape)
            for batch in batches:
                if batch.num_rows:
                    x = _matrix(pa.chunked_array([batch.column(0)])).reshape(-1, parts, width)
                    for p in range(parts):
                        near = _scores(x[:, p], model[p], "l2").argmin(axis=1)
                        n[p] += np.bincount(near, minlength=codes)
                        np.add.at(total[p], near, x[:, p])
            sub, code = np.nonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sub), pa.array(code), pa.array(n[sub, code]), pa.array(list(total[sub, code]), pa.list_(pa.float64()))],
                names=["sub", "code", "n", "total"])

        sums = points.mapInArrow(add, "sub long, code long, n double, total array<double>")
        means = ", ".join(f"sum(total[{i}]) / sum(n)" for i in range(width))
        books = books.copy()
        for r in sums.groupBy("sub", "code").agg(F.expr(f"array({means})").alias("mean")).collect():
            books[r["sub"], r["code"]] = r["mean"]
    parts, codes, _ = books.shape
    table = pa.table({
        "sub": np.repeat(np.arange(parts), codes), "code": np.tile(np.arange(codes), parts),
        "embedding": pa.array(list(books.reshape(parts * codes, -1)), pa.list_(pa.float64()))})
    return spark.createDataFrame(table)


def cell_residuals(vectors: DataFrame, centroids: DataFrame, key: str = "item_id") -> DataFrame:
    """(key, cell, embedding): vectors with a cell, less the centroid of the cell."""
    middle = centroids.select(F.col("code").alias("cell"), F.col("embedding").alias("_c"))
    small = small_matrix(centroids, MODEL_CODES) is not None
    joined = vectors.join(F.broadcast(middle) if small else middle, "cell")
    return joined.select(key, "cell", V.minus("embedding", "_c").alias("embedding"))


def ivfpq_build(vectors: DataFrame, centroids: DataFrame, codebooks: DataFrame) -> DataFrame:
    """(item_id, cell, codes): cell lists that hold the codes of what the centroid leaves."""
    inside = cell_residuals(nearest_code(build_flat(vectors), centroids, "cell"), centroids)
    return pq_encode(inside, codebooks, keep=["cell"])


def _coded_top_k(
    queries: DataFrame, index: DataFrame, codebooks: DataFrame, k: int, centroids: DataFrame | None = None
) -> DataFrame:
    """Top-k by the sum over parts of distances between a query's part and the sub-centroids.

    ``queries`` (query_id, embedding[, cells]), ``index`` (item_id, codes[, cell]).
    Items are codes from end to end; a task puts the sub-centroids (and the
    centroid of the cell) of one tile together, and the distance to that vector is the sum over its parts.
    """
    spark = queries.sparkSession
    books = spark.sparkContext.broadcast(_pq_model(codebooks))
    middle = None if centroids is None else small_matrix(centroids, MODEL_CODES)
    if centroids is not None and middle is None:
        index = index.join(centroids.select(F.col("code").alias("cell"), F.col("embedding").alias("_c")), "cell")
    cells = spark.sparkContext.broadcast(middle)

    def decode(rows: pa.RecordBatch) -> np.ndarray:
        parts, _, width = books.value.shape
        codes = _matrix(rows.column("codes")).astype(np.int64)
        out = np.concatenate([books.value[p][codes[:, p]] for p in range(parts)], axis=1)
        if "_c" in rows.schema.names:
            out += _matrix(rows.column("_c"))
        elif cells.value is not None and len(cells.value[0]):
            names, points = cells.value
            out += points[np.searchsorted(names, rows.column("cell").to_numpy())]
        return out

    return block_top_k(queries, index, k, metric="l2", decode=decode)


def pq_search(codes: DataFrame, codebooks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Top-k over all codes by the distance between the query and the item's sub-centroids."""
    return _coded_top_k(queries.select("query_id", "embedding"), codes.select("item_id", "codes"), codebooks, k)


def ivfpq_search(
    index: DataFrame, centroids: DataFrame, codebooks: DataFrame, queries: DataFrame, k: int, nprobe: int = 50
) -> DataFrame:
    """Top-k by codes inside the nprobe nearest cells of each query; only their lists are compared."""
    unit = queries.select("query_id", V.l2_normalize(V.as_doubles("embedding")).alias("embedding"))
    return _coded_top_k(probed_cells(unit, centroids, nprobe), index, codebooks, k, centroids)


def rerank_exact(found: DataFrame, vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best of the found (query_id, item_id) by the inner product of the unit vectors themselves."""
    asked = queries.select("query_id", V.l2_normalize(V.as_doubles("embedding")).alias("embedding"))
    items = found.groupBy("query_id").agg(F.collect_list("item_id").alias("items"))
    scored = block_pairs(asked.join(items, "query_id"), build_flat(vectors))
    return top_k(scored.withColumn("score", rounded("score")), k, per="query_id")


def hash_buckets(
    vectors: DataFrame, dim: int, tables: int = 8, bits: int = 6, seed: int = 42,
    key: str = "item_id", explode: bool = True,
) -> DataFrame:
    """One row per hash table with the vector's bucket as ``cell``, or one row with all of them as ``cells``.

    A bucket is the sign pattern against ``bits`` random hyperplanes, whose
    numbers are draws by (plane, dimension), so that SQL has the same planes.
    """
    planes = np.array([[normal_of(seed, b, d) for d in range(dim)] for b in range(tables * bits)])
    shared = vectors.sparkSession.sparkContext.broadcast(planes)

    @F.pandas_udf("array<bigint>")
    def buckets(embedding: pd.Series) -> pd.Series:
        x = np.array(embedding.tolist(), dtype=np.float64).reshape(-1, dim)
        signs = (x @ shared.value.T > 0).reshape(len(x), tables, bits)
        cells = (signs * (1 << np.arange(bits))).sum(axis=2) + (np.arange(tables) << bits)
        return pd.Series(list(cells.astype(np.int64)))

    cells = buckets("embedding")
    return vectors.select(key, "embedding", F.explode(cells).alias("cell") if explode else cells.alias("cells"))


def lsh_search(
    index: DataFrame, queries: DataFrame, k: int, dim: int, tables: int = 8, bits: int = 6,
    seed: int = 42,
) -> DataFrame:
    """Approximate top-k: exact search inside the shared hash buckets.

    A hot bucket is tiled like a hot cell; every stored vector is compared, none
    is capped, and an item met in several tables counts once.
    """
    unit = queries.select("query_id", V.l2_normalize(V.as_doubles("embedding")).alias("embedding"))
    probes = hash_buckets(unit, dim, tables, bits, seed, key="query_id", explode=False)
    return block_top_k(probes, hash_buckets(index, dim, tables, bits, seed), k)


def recall_at_k(
    approximate: DataFrame, exact: DataFrame, sample: int | None = None
) -> DataFrame:
    """One row: hits, expected and their ratio over all queries, or the ``sample`` lowest ids."""
    if sample is not None:
        first = exact.select("query_id").distinct().orderBy("query_id").limit(sample)
        exact = exact.join(first, "query_id", "left_semi")
    found = approximate.select("query_id", "item_id").distinct().withColumn("_hit", F.lit(1))
    joined = exact.select("query_id", "item_id").join(found, ["query_id", "item_id"], "left")
    totals = joined.agg(F.count("_hit").alias("hits"), F.count("*").alias("expected"))
    return totals.withColumn("recall", rounded(ratio("hits", "expected")))


def add_items(
    index: DataFrame, new_vectors: DataFrame, centroids: DataFrame | None = None
) -> DataFrame:
    """Upsert: new vectors replace rows of the same id, cells are not rebuilt.

    Of several new rows of one id the largest vector (by its numbers in order) stays.
    """
    fresh = build_flat(new_vectors.groupBy("item_id").agg(F.max("embedding").alias("embedding")))
    if centroids is not None:
        fresh = nearest_code(fresh, centroids, "cell")
    kept = index.join(fresh.select("item_id"), "item_id", "left_anti")
    return kept.select(*fresh.columns).unionByName(fresh)
