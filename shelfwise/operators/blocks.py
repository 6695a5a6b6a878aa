"""Blocked vector search: queries against an index, tile by tile.

The index lies in the shared folder, ordered by cell. A task holds some queries
with their best rows so far and reads the tiles of their cells one after
another: a matrix product of a few hundred queries and at most ``TILE`` rows,
of which only scores that reach a query's k-th best are looked at. Neither side
is repeated or shuffled per block, and k rows per query leave a task. A hot
cell is simply more tiles. Without cells there is a single one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.ordering import SCORE_DIGITS, top_k
from shelfwise.session import scratch_path, shared_file, stored

TILE = 4096
QUERY_BLOCK = 2048
COLUMN_BLOCK = 512
#: Queries that a task holds at once, queries of a product, and rows of a file of tiles.
HELD, LINES, FILE_ROWS = 8192, 512, 16384


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists as a 2-D array."""
    rows = len(column)
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = pa.concat_arrays([c.flatten() for c in chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(rows, -1)


def _scores(queries: np.ndarray, vectors: np.ndarray, metric: str) -> np.ndarray:
    product = queries @ vectors.T
    if metric == "ip":
        return product
    q2 = (queries * queries).sum(axis=1)[:, None]
    v2 = (vectors * vectors).sum(axis=1)[None, :]
    return np.maximum(q2 + v2 - 2.0 * product, 0.0)


def _round(scores: np.ndarray, unit: float) -> np.ndarray:
    """Half away from zero, as Spark's ``round``."""
    return np.copysign(np.floor(np.abs(scores) * unit + 0.5), scores) / unit


class Best:
    """The k best (score descending, id ascending) found so far of each of n lines."""

    def __init__(self, n: int, k: int, unique: bool = True):
        self.k, self.unique = k, unique
        self.scores, self.others = np.full((n, k), -np.inf), np.zeros((n, k), np.int64)
        self.floors = np.full(n, -np.inf)

    def add(self, rows: np.ndarray, others: np.ndarray, scores: np.ndarray) -> None:
        """Take in scores; unless they are unique, an id that comes again counts once."""
        if not len(rows):
            return
        named, line, often = np.unique(rows, return_inverse=True, return_counts=True)
        if self.unique and often.max() <= self.k:
            self._add_few(named, line, often, others, scores)
            return
        at, place = np.nonzero(self.scores[named] > -np.inf)
        line = np.concatenate([at, line])
        others = np.concatenate([self.others[named[at], place], others])
        scores = np.concatenate([self.scores[named[at], place], scores])
        if not self.unique:
            order = np.lexsort((-scores, others, line))
            line, others, scores = line[order], others[order], scores[order]
            new = np.append(True, (line[1:] != line[:-1]) | (others[1:] != others[:-1]))
            line, others, scores = line[new], others[new], scores[new]
        order = np.lexsort((others, -scores, line))
        line, others, scores = line[order], others[order], scores[order]
        place = np.arange(len(line)) - np.searchsorted(line, np.arange(len(named)))[line]
        near = place < self.k
        line, place = named[line[near]], place[near]
        self.others[line, place], self.scores[line, place] = others[near], scores[near]
        self.floors[named] = self.scores[named, -1]

    def _add_few(self, named, line, often, others, scores) -> None:
        """Sort every list with its few new ones on its own, which is less work than all of them together."""
        order = np.argsort(line, kind="stable")
        at = line[order], self.k + np.arange(len(line)) - np.repeat(np.cumsum(often) - often, often)
        ids = np.zeros((len(named), self.k + often.max()), np.int64)
        score = np.full(ids.shape, -np.inf)
        ids[:, :self.k], score[:, :self.k] = self.others[named], self.scores[named]
        ids[at], score[at] = others[order], scores[order]
        near = np.lexsort((ids, -score), axis=1)[:, :self.k]
        self.others[named] = np.take_along_axis(ids, near, 1)
        self.scores[named] = np.take_along_axis(score, near, 1)
        self.floors[named] = self.scores[named, -1]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(line, place in its list, id, score)"""
        line, place = np.nonzero(self.scores > -np.inf)
        return line, place, self.others[line, place], self.scores[line, place]


#: A file of tiles: path, lowest and highest cell.
Tiles = list[tuple[str, int, int]]
Meeting = Callable[[np.ndarray, int, pa.RecordBatch], None]


def stored_tiles(index: DataFrame) -> Tiles:
    """The index (item_id, ..., cell) as files in the shared folder, by cell and id."""
    spark = index.sparkSession
    path = scratch_path(spark, "tiles")
    # Stored first: finding the ranges reads the rows twice, and vectors may be dear to compute.
    ready = stored(index, "index").where("cell is not null")
    if "embedding" in index.columns:
        ready = ready.where("embedding is not null")
    ordered = ready.repartitionByRange("cell", F.xxhash64("item_id"))
    ordered.sortWithinPartitions("cell", "item_id").write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    files = spark.read.schema(ordered.schema).parquet(path).groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.min("cell").alias("low"), F.max("cell").alias("high"))
    return sorted((r["path"], r["low"], r["high"]) for r in files.collect())


_last_file: dict[str, list[pa.RecordBatch]] = {}


def _tiles_of(path: str, tile: int) -> list[pa.RecordBatch]:
    """The tiles of a file; the last file stays at hand."""
    key = f"{path} {tile}"
    if key not in _last_file:
        _last_file.clear()
        _last_file[key] = list(shared_file(path).iter_batches(batch_size=tile))
    return _last_file[key]


def _meet(cells: pa.Array | None, n: int, files: Tiles, tile: int, meet: Meeting) -> None:
    """Call ``meet(lines, cell, rows)`` for the queries of every cell and the rows of every tile in it.

    ``cells`` are lists of cells per query, or None: every query meets every cell.
    """
    if cells is not None:
        line = np.repeat(np.arange(n), np.diff(cells.offsets.to_numpy()))
        flat = cells.flatten().to_numpy()
        order = np.lexsort((line, flat))
        line, flat = line[order], flat[order]
    everyone = np.arange(n)
    for path, low, high in files:
        if cells is not None and np.searchsorted(flat, low) == np.searchsorted(flat, high, "right"):
            continue
        for batch in _tiles_of(path, tile):
            held = batch.column("cell").to_numpy()
            starts = np.append(0, np.flatnonzero(held[1:] != held[:-1]) + 1)
            for start, end in zip(starts, np.append(starts[1:], len(held))):
                cell = int(held[start])
                lines = everyone
                if cells is not None:
                    lines = line[np.searchsorted(flat, cell):np.searchsorted(flat, cell, "right")]
                if len(lines):
                    meet(lines, cell, batch.slice(start, end - start))


def over_tiles(queries: DataFrame, files: Tiles, search: Callable, schema: str, block: int) -> tuple[DataFrame, bool]:
    """Run ``search(queries, files)`` over blocks of queries; also whether a query meets all its rows in one block.

    Queries go to tasks by their first cell, so those of a block need the same
    files. If there are fewer blocks than tasks can run, blocks are repeated for slices of the files.
    """
    spark, queries = queries.sparkSession, stored(queries, "queries").where("embedding is not null")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    slices = 1
    if len(files) > 1:
        slices = min(len(files), max(1, tasks // -(-max(queries.count(), 1) // min(block, QUERY_BLOCK))))
    first = [F.element_at("cells", 1)] if "cells" in queries.columns else []
    if slices > 1:
        queries = queries.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        first = ["_slice", *first]
    spread = queries.repartitionByRange(tasks, *first, F.xxhash64("query_id"))
    if first:
        spread = spread.sortWithinPartitions(*first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("_slice").to_numpy() if slices > 1 else np.zeros(batch.num_rows, int)
            for s in np.unique(number):
                rows = np.flatnonzero(number == s)
                for low in range(0, len(rows), block):
                    part = batch.slice(rows[low], min(block, len(rows) - low))
                    yield from search(part, files[s::slices])

    return spread.mapInArrow(run, schema), slices == 1


def _batch(values: dict[str, np.ndarray], out: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Columns as batches of bounded size."""
    n = len(next(iter(values.values())))
    for low in range(0, n, out):
        yield pa.RecordBatch.from_arrays([pa.array(v[low:low + out]) for v in values.values()], names=list(values))


def _banned(lines: np.ndarray, ids: np.ndarray, skip: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in ``lines``, place in ``ids``) that are left out; ids are sorted, pairs by item."""
    none = np.zeros(0, np.int64)
    if skip is None:
        return none, none
    line, item = skip
    part = slice(np.searchsorted(item, ids[0]), np.searchsorted(item, ids[-1], "right"))
    line, item = line[part], item[part]
    at = np.minimum(np.searchsorted(lines, line), len(lines) - 1)
    here = lines[at] == line
    at, item = at[here], item[here]
    start = np.searchsorted(ids, item)
    often = np.searchsorted(ids, item, "right") - start
    place = np.arange(often.sum()) + np.repeat(start - (np.cumsum(often) - often), often)
    return np.repeat(at, often), place


def block_top_k(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    metric: str = "ip",
    skip_self: bool = False,
    positive_only: bool = False,
    exclude: DataFrame | None = None,
    tile: int = TILE,
    query_block: int = HELD,
    digits: int | None = SCORE_DIGITS,
    decode: Callable[[pa.RecordBatch], np.ndarray] | None = None,
) -> DataFrame:
    """Exact top-k of every query over the index, or over the cells it names.

    ``queries`` (query_id, embedding[, cells or cell]) and ``index`` (item_id,
    embedding[, cell]); ``cells`` lists the cells of a query, ``cell`` is one, with a row per cell. ``metric`` is
    "ip" (inner product, highest first) or "l2" (squared distance, lowest
    first). Rows (query_id, item_id) of ``exclude`` are left out; a query may
    exclude any number of items. Returns (query_id, item_id, score, rank),
    scores rounded to ``digits`` (not at all if None) and ties by item id. An
    item that is in several cells of a query counts once. A vector with a number that is not one is nobody's
    neighbour. With ``decode`` the index holds other columns, which it turns into the vectors of a tile.
    """
    ascending = metric == "l2"
    unit = None if digits is None else 10.0**digits
    slack = 0.0 if digits is None else 10.0**-digits
    celled = "cell" in index.columns
    several = celled and "cells" in queries.columns
    q = queries.select(
        "query_id", F.col("embedding").cast("array<double>").alias("embedding"),
        *(["cells"] if several else [F.array(F.col("cell").cast("bigint")).alias("cells")] if celled else []))
    if celled and not several:
        q = q.where(F.element_at("cells", 1).isNotNull())
    x = index.withColumn("cell", F.col("cell").cast("bigint") if celled else F.lit(0).cast("bigint"))
    if decode is None:
        x = x.select("item_id", F.col("embedding").cast("array<double>").alias("embedding"), "cell")
    skipping = exclude is not None
    if skipping:
        skipped = exclude.where("item_id is not null").groupBy("query_id").agg(F.collect_list("item_id").alias("_skip"))
        q = q.join(skipped, "query_id", "left").withColumn(
            "_skip", F.coalesce("_skip", F.array().cast("array<bigint>")))

    def search(part: pa.RecordBatch, files: Tiles) -> Iterator[pa.RecordBatch]:
        query_ids, points = part.column("query_id").to_numpy(), _matrix(part.column("embedding"))
        best = Best(len(query_ids), k, not several)
        skip = None
        if skipping:
            lists = part.column("_skip")
            line = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            item = lists.flatten().to_numpy()
            order = np.argsort(item, kind="stable")
            skip = line[order], item[order]

        def meet(lines: np.ndarray, cell: int, rows: pa.RecordBatch) -> None:
            ids = rows.column("item_id").to_numpy()
            vectors = decode(rows) if decode else _matrix(rows.column("embedding"))
            for low in range(0, len(lines), LINES):
                some = lines[low:low + LINES]
                scores = _scores(points[some], vectors, metric)
                if ascending:
                    np.negative(scores, out=scores)
                if np.isnan(scores.sum()):
                    scores[np.isnan(scores)] = -np.inf
                if skip_self:
                    scores[query_ids[some][:, None] == ids[None, :]] = -np.inf
                scores[_banned(some, ids, skip)] = -np.inf
                floors = best.floors[some]
                least = floors - slack
                fresh = np.flatnonzero(floors == -np.inf)
                if len(fresh) and k < scores.shape[1]:
                    # The k-th best of a row bounds a list that is not full.
                    last = scores.shape[1] - k
                    least[fresh] = np.partition(scores[fresh], last, axis=1)[:, last] - slack
                at, place = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
                score = scores[at, place]
                if unit is not None:
                    score = _round(score, unit)
                fit = score >= floors[at]
                if positive_only:
                    fit &= score > 0
                best.add(some[at[fit]], ids[place[fit]], score[fit])

        _meet(part.column("cells") if celled else None, len(query_ids), files, tile, meet)
        line, place, others, score = best.found()
        yield from _batch({"query_id": query_ids[line], "item_id": others,
                           "score": 0.0 - score if ascending else score, "rank": place + 1})

    found, whole = over_tiles(
        q, stored_tiles(x), search, "query_id bigint, item_id bigint, score double, rank bigint", query_block)
    if whole and (several or not celled):
        return found
    if several:  # slices may share an item
        found = found.groupBy("query_id", "item_id").agg((F.min if ascending else F.max)("score").alias("score"))
    return top_k(found.select("query_id", "item_id", "score"), k, per="query_id", ascending=ascending)


def block_pairs(queries: DataFrame, index: DataFrame, tile: int = TILE) -> DataFrame:
    """(query_id, item_id, score): inner products of the queries (query_id, embedding, items) with their items."""
    x = index.select(
        "item_id", F.col("embedding").cast("array<double>").alias("embedding"), F.lit(0).cast("bigint").alias("cell"))
    q = queries.select("query_id", F.col("embedding").cast("array<double>").alias("embedding"), "items")

    def search(part: pa.RecordBatch, files: Tiles) -> Iterator[pa.RecordBatch]:
        query_ids, points = part.column("query_id").to_numpy(), _matrix(part.column("embedding"))
        line = np.repeat(np.arange(part.num_rows), part.column("items").value_lengths().to_numpy())
        item = part.column("items").flatten().to_numpy()
        order = np.argsort(item, kind="stable")
        pairs = line[order], item[order]
        out = []

        def meet(lines: np.ndarray, cell: int, rows: pa.RecordBatch) -> None:
            ids, vectors = rows.column("item_id").to_numpy(), _matrix(rows.column("embedding"))
            at, place = _banned(lines, ids, pairs)
            for low in range(0, len(at), TILE):
                a, b = at[low:low + TILE], place[low:low + TILE]
                out.append((a, ids[b], np.einsum("ij,ij->i", points[a], vectors[b])))

        _meet(None, part.num_rows, files, tile, meet)
        if out:
            at, ids, score = (np.concatenate(c) for c in zip(*out))
            yield from _batch({"query_id": query_ids[at], "item_id": ids, "score": score})

    return over_tiles(q, stored_tiles(x), search, "query_id bigint, item_id bigint, score double", QUERY_BLOCK)[0]


def block_distance_sums(
    points: DataFrame, label: str, tile: int = QUERY_BLOCK, probes: DataFrame | None = None
) -> DataFrame:
    """Per point and label: the sum of Euclidean distances to the label's points.

    ``points`` (item_id, embedding, label). Only sums leave a block, never pairs.
    With ``probes`` (query_id, embedding, cell) only those labels (cell) of each point.
    """
    index = points.select("item_id", F.col("embedding").cast("array<double>").alias("embedding"),
                          F.col(label).cast("bigint").alias("cell"))
    queries = index.select(F.col("item_id").alias("query_id"), "embedding")
    probed = probes is not None
    if probed:
        queries = probes.select("query_id", F.col("embedding").cast("array<double>").alias("embedding"),
                                F.array(F.col("cell").cast("bigint")).alias("cells"))

    def search(part: pa.RecordBatch, files: Tiles) -> Iterator[pa.RecordBatch]:
        query_ids, vectors = part.column("query_id").to_numpy(), _matrix(part.column("embedding"))
        cells = part.column("cells") if probed else None
        label, total = None, np.zeros(len(query_ids))
        held = []

        def ready() -> None:
            if label is not None:
                met = np.flatnonzero(total > -1)
                held.append((query_ids[met], np.full(len(met), label), total[met]))

        def meet(lines: np.ndarray, cell: int, rows: pa.RecordBatch) -> None:
            nonlocal label
            if cell != label:  # cells come in order, so a label is done when the next one begins
                ready()
                label, total[:] = cell, -2.0
            ids, x = rows.column("item_id").to_numpy(), _matrix(rows.column("embedding"))
            for low in range(0, len(lines), LINES):
                some = lines[low:low + LINES]
                distance = np.sqrt(_scores(vectors[some], x, "l2"))
                distance[query_ids[some][:, None] == ids[None, :]] = 0.0
                total[some] = np.maximum(total[some], 0.0) + distance.sum(axis=1)

        for one in files:
            _meet(cells, len(query_ids), [one], tile, meet)
            ready()
            label = None
            for item_id, other, distance in held:
                yield from _batch({"item_id": item_id, "other": other, "distance": distance})
            held.clear()

    partial, _ = over_tiles(queries, stored_tiles(index), search, "item_id bigint, other bigint, distance double", HELD)
    return partial.groupBy("item_id", "other").agg(F.sum("distance").alias("distance"))


def small_matrix(
    df: DataFrame, max_rows: int, vec: str = "embedding"
) -> tuple[np.ndarray, np.ndarray] | None:
    """Rows (code, vector) as a driver-side matrix, or None when over ``max_rows`` rows.

    An empty table is a matrix without rows.

    Only for models whose size is a parameter (codebooks, centroids). One row
    more than allowed is asked for, so a larger table is noticed, not fetched.
    """
    rows = df.select("code", F.col(vec).cast("array<double>").alias("v"))
    rows = rows.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros((0, 0))
    rows.sort(key=lambda r: r["code"])
    return (
        np.array([r["code"] for r in rows], dtype=np.int64),
        np.array([r["v"] for r in rows], dtype=np.float64),
    )


def block_products(
    cells: DataFrame, members: int = QUERY_BLOCK, columns: int = COLUMN_BLOCK
) -> DataFrame:
    """(a, b, product) with a < b: products of the member rows of a sparse matrix.

    ``cells`` (column, member, weight). The members are cut into blocks and the
    columns into chunks; a task multiplies two member blocks over one chunk and
    returns the pairs that share a column there, whatever their weights;
    repeated cells add up. The pair sums of the chunks remain to be added up.
    """
    sizes = cells.agg(
        F.struct(
            F.ceil(F.approx_count_distinct("member") / members).cast("int").alias("m"),
            F.ceil(F.approx_count_distinct("column") / columns).cast("int").alias("c"),
        )
    ).scalar()
    placed = cells.withColumn("_s", sizes).select(
        "column", "member", F.col("weight").cast("double").alias("weight"),
        F.pmod(F.xxhash64("column"), F.col("_s.c")).cast("int").alias("_chunk"),
        F.pmod(F.xxhash64("member"), F.col("_s.m")).cast("int").alias("_block"),
        (F.col("_s.m") - 1).alias("_last"),
    )
    later = F.explode(F.sequence(F.col("_block"), F.col("_last")))
    earlier = F.explode(F.sequence(F.lit(0), F.col("_block")))
    fields = ["_chunk", "_i", "_j", "column", "member", "weight"]
    left = placed.withColumn("_j", later).withColumnRenamed("_block", "_i").select(*fields)
    right = placed.withColumn("_i", earlier).withColumnRenamed("_block", "_j")
    right = right.select(*[F.col(f).alias(f) for f in fields])
    keys = ["_chunk", "_i", "_j"]
    kind = cells.schema["member"].dataType.simpleString()
    none = pa.array([], pa.string() if kind == "string" else pa.int64())
    empty = pa.table({"a": none, "b": none, "product": pa.array([], pa.float64())})

    def multiply(one: pa.Table, two: pa.Table) -> pa.Table:
        if one.num_rows == 0 or two.num_rows == 0:
            return empty
        width = np.unique(np.concatenate([t["column"].to_numpy() for t in (one, two)]))
        sides = []
        for t in (one, two):
            ids, line = np.unique(t["member"].to_numpy(), return_inverse=True)
            dense = np.zeros((len(ids), len(width)))
            held = np.zeros(dense.shape, dtype=np.float32)
            at = line, np.searchsorted(width, t["column"].to_numpy())
            np.add.at(dense, at, t["weight"].to_numpy())
            held[at] = 1
            sides.append((ids, dense, held))
        (ids_a, x, in_a), (ids_b, y, in_b) = sides
        shared = in_a @ in_b.T > 0
        if one["_i"][0] == one["_j"][0]:
            shared &= ids_a[:, None] < ids_b[None, :]
        rows, cols = np.nonzero(shared)
        first, second = ids_a[rows], ids_b[cols]
        return pa.table({
            "a": pa.array(np.minimum(first, second), none.type),
            "b": pa.array(np.maximum(first, second), none.type),
            "product": (x @ y.T)[rows, cols],
        })

    return (
        left.groupBy(*keys).cogroup(right.groupBy(*keys))
        .applyInArrow(multiply, f"a {kind}, b {kind}, product double")
    )


def block_logsumexp(queries: DataFrame, sample: DataFrame, tile: int = TILE) -> DataFrame:
    """(query_id, lse): log of the summed exp of inner products with every sample row.

    ``sample`` (item_id, embedding) may repeat ids. A block returns its maximum
    and scaled sum, which are merged per query.
    """
    q = queries.select("query_id", F.col("embedding").cast("array<double>").alias("embedding"))
    x = sample.select("item_id", F.col("embedding").cast("array<double>").alias("embedding"),
                      F.lit(0).cast("bigint").alias("cell"))

    def search(part: pa.RecordBatch, files: Tiles) -> Iterator[pa.RecordBatch]:
        query_ids, points = part.column("query_id").to_numpy(), _matrix(part.column("embedding"))
        top, total = np.full(len(query_ids), -np.inf), np.zeros(len(query_ids))

        def meet(lines: np.ndarray, cell: int, rows: pa.RecordBatch) -> None:
            vectors = _matrix(rows.column("embedding"))
            for low in range(0, len(lines), LINES):
                some = lines[low:low + LINES]
                scores = points[some] @ vectors.T
                high = np.maximum(top[some], scores.max(axis=1))
                total[some] = total[some] * np.exp(top[some] - high) + np.exp(scores - high[:, None]).sum(axis=1)
                top[some] = high

        _meet(None, len(query_ids), files, tile, meet)
        if (total > 0).any():
            yield from _batch({"query_id": query_ids, "top": top, "total": total})

    partial, _ = over_tiles(q, stored_tiles(x), search, "query_id bigint, top double, total double", HELD)
    highest = F.max("top")
    packed = F.collect_list(F.struct("top", "total"))
    merged = partial.groupBy("query_id").agg(highest.alias("_m"), packed.alias("_p"))
    scaled = F.aggregate(
        "_p", F.lit(0.0), lambda acc, p: acc + p["total"] * F.exp(p["top"] - F.col("_m"))
    )
    return merged.select("query_id", (F.col("_m") + F.log(scaled)).alias("lse"))
