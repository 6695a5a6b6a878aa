"""Near-duplicate vectors through an inverted multi-index.

The two halves of the unit vectors have codebooks of their own, fitted on a
bounded sample; a pair of codes is a cell of the product grid, and every vector
lies in one. A vector visits cells in the order of a lower bound of its
distance to anything inside them (the sum of a bound per half, the larger of
the distance to the bisecting plane and that to the code's ball). A cosine is a
distance between unit vectors, so the traversal ends when the bound passes that
distance: the recall is complete and ``target_recall`` below 1 shortens the
radius. What meets in a cell is verified by exact cosines in double precision,
as matrix products of blocks.

Equal vectors are one class with a weight, so copies never meet each other. A
cell is cut into tiles of vectors and visitors, so a crowded cell is many tasks.
Blocks pass on counts and a spanning forest of their links, never all pairs.

Defined results: a null, zero or not finite vector, or one without label, links
with nothing and is its own component; only vectors of equal length and label
are compared; repeated rows are vectors of their own; a null id gives a null
component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.llm.shared import deal_out, stored

#: Classes the codebooks are fitted on, and rounds of fitting.
SAMPLE = 4096
STEPS = 8
TILE = 1024
VISITORS = 2048
#: Task groups for cells that need no tiles.
GROUPS = 1024


def codebook(rows: np.ndarray, k: int, steps: int) -> np.ndarray:
    """Lloyd's algorithm from rows spread evenly over the sample."""
    centres = rows[np.linspace(0, len(rows) - 1, min(k, len(rows))).astype(int)].copy()
    for _ in range(steps):
        owner = nearest(rows, centres).argmin(1)
        size = np.bincount(owner, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, rows)
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return np.unique(centres, axis=0)


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows x centres."""
    return np.maximum((rows * rows).sum(1)[:, None] + (centres * centres).sum(1) - 2 * rows @ centres.T, 0)


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def bounds(rows: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Squared lower bounds of the distance of each row to the members of each code."""
    square = nearest(rows, centres)
    own = square.argmin(1)
    gap = np.sqrt(nearest(centres, centres))[own]
    plane = (square - square[np.arange(len(rows)), own][:, None]) / (2 * np.where(gap > 0, gap, np.inf))
    ball = np.sqrt(square) - radius
    return np.maximum(np.maximum(plane, ball), 0) ** 2


def traverse(first: np.ndarray, second: np.ndarray, limit: float) -> Iterator[tuple[float, int, int]]:
    """Cells (bound, i, j) by ascending sum of both halves' bounds, until the limit.

    The frontier of the multi-sequence walk holds, for each code of the first
    half, the next code of the second.
    """
    import heapq

    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap = [(float(first[a[0]] + second[b[0]]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        if bound > limit:
            return
        yield bound, int(a[i]), int(b[j])
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (float(first[a[i + 1]] + second[b[0]]), i + 1, 0))
        if j + 1 < len(b):
            heapq.heappush(heap, (float(first[a[i]] + second[b[j + 1]]), i, j + 1))


def classes_of(vectors: DataFrame) -> DataFrame:
    """(id, label, v, node) with node null where the vector cannot link."""
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    whole = F.coalesce(F.col("label").isNotNull() & (F.size("v") > 0) & good & some, F.lit(False))
    return vectors.withColumn("node", F.when(whole, F.xxhash64("label", F.size("v"), "v")))


def fit(classes: DataFrame, total: int, sample: int = SAMPLE) -> dict:
    """Per vector length the two codebooks; the codes grow with the fourth root of the classes."""
    rows = classes.orderBy("node").limit(sample).select("v").collect()  # at most ``sample``; node is a hash
    k = int(np.clip(2 * total ** 0.25, 4, 256))
    found = {}
    for dim in {len(r["v"]) for r in rows}:
        data = unit(np.array([r["v"] for r in rows if len(r["v"]) == dim], float))
        cut = dim // 2
        found[dim] = [codebook(np.ascontiguousarray(h), k, STEPS) for h in (data[:, :cut], data[:, cut:])]
    return found


def _books(model: dict, dim: int) -> list[np.ndarray]:
    """The codebooks of a length; one code for everything where the sample had none."""
    return model.get(dim) or [np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2))]


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) for each vector length of a batch."""
    lists = batch.column(batch.num_columns - 1)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        flat = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield at, unit(flat.reshape(len(at), dim).astype(float))


def assigned(classes: DataFrame, model: dict) -> DataFrame:
    """Classes with their cell, packed unit vector and distances to their codes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows in _by_dim(batch):
                cut, codes, apart = rows.shape[1] // 2, [], []
                for half, book in zip((rows[:, :cut], rows[:, cut:]), _books(model, rows.shape[1])):
                    square = nearest(half, book)
                    codes.append(square.argmin(1))
                    apart.append(np.linalg.norm(half - book[codes[-1]], axis=1))
                out = batch.take(pa.array(at)).select(range(batch.num_columns - 1))
                for name, values in (
                        ("dim", np.full(len(at), rows.shape[1])), ("c1", codes[0]), ("c2", codes[1]),
                        ("r1", apart[0]), ("r2", apart[1])):
                    out = out.append_column(name, pa.array(values))
                yield out.append_column("unit", pa.array([r.tobytes() for r in rows], pa.binary()))

    label = classes.schema["label"].dataType.simpleString()
    return classes.select("node", "label", "n", F.col("v").cast("array<double>").alias("v")).mapInArrow(
        build, f"node long, label {label}, n long, dim long, c1 long, c2 long, r1 double, r2 double, unit binary")


def visits(cells: DataFrame, model: dict, radii: dict, limit: float) -> DataFrame:
    """(node, label, dim, c1, c2, own): the cells each class visits, its own and those after it."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, c1, c2 = (batch.column(c).to_numpy() for c in ("dim", "c1", "c2"))
            units = batch.column("unit").to_pylist()
            take, to1, to2 = [], [], []
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                rows = np.frombuffer(b"".join(units[i] for i in at)).reshape(len(at), dim)
                books, cut = _books(model, dim), dim // 2
                first, second = (
                    bounds(half, book, np.array([radii.get((int(dim), h, c), 0.0) for c in range(len(book))]))
                    for h, (half, book) in enumerate(zip((rows[:, :cut], rows[:, cut:]), books)))
                for r, i in enumerate(at):
                    for _, a, b in traverse(first[r], second[r], limit):
                        if (a, b) >= (c1[i], c2[i]):
                            take.append(i), to1.append(a), to2.append(b)
            take = np.array(take, np.int64)
            out = batch.take(pa.array(take)).select(["node", "label", "dim"])
            to1, to2 = np.array(to1, np.int64), np.array(to2, np.int64)
            for name, values in (("c1", to1), ("c2", to2), ("own", (to1 == c1[take]) & (to2 == c2[take]))):
                out = out.append_column(name, pa.array(values))
            yield out

    label = cells.schema["label"].dataType.simpleString()
    return cells.select("node", "label", "dim", "c1", "c2", "unit").mapInArrow(
        build, f"node long, label {label}, dim long, c1 long, c2 long, own boolean")


def forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Links (node, smallest node of its part) that join what a block of links joins."""
    rows, cols = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
    linked, a, b = linked[np.ix_(rows, cols)], left[rows].copy(), right[cols].copy()
    most = np.iinfo(np.int64).max
    while True:
        a2 = np.minimum(a, np.where(linked, b[None, :], most).min(1, initial=most))
        b2 = np.minimum(b, np.where(linked, a2[:, None], most).min(0, initial=most))
        if (a2 == a).all() and (b2 == b).all():
            break
        a, b = a2, b2
    pairs = np.concatenate([np.stack([left[rows], a], 1), np.stack([right[cols], b], 1)])
    return pairs[pairs[:, 0] != pairs[:, 1]]


def met(placed: DataFrame, least: float) -> DataFrame:
    """(node, n, other): linked weight of each class by block, and links of the blocks' forests."""

    def meet(key, table):
        cell, tile, turn = (table[c].to_numpy() for c in ("cell", "tile", "turn"))
        order = np.lexsort((turn, tile, cell))
        cell, tile, turn = cell[order], tile[order], turn[order]
        node, n = (table[c].to_numpy()[order] for c in ("node", "n"))
        visitor, own = (table[c].to_numpy(zero_copy_only=False).astype(bool)[order] for c in ("visitor", "own"))
        units = table["unit"].take(pa.array(order)).to_pylist()
        new = np.ones(len(cell), bool)
        new[1:] = (cell[1:] != cell[:-1]) | (tile[1:] != tile[:-1]) | (turn[1:] != turn[:-1])
        cuts = np.append(np.flatnonzero(new), len(cell))
        counts, links = [np.zeros((0, 2), np.int64)], [np.zeros((0, 2), np.int64)]
        for s, e in zip(cuts[:-1], cuts[1:]):
            at = np.arange(s, e)
            come, here = at[visitor[s:e]], at[~visitor[s:e]]
            if not len(come) or not len(here):
                continue
            x, y = (np.frombuffer(b"".join(units[i] for i in k)).reshape(len(k), -1) for k in (come, here))
            linked = (x @ y.T >= least) & (node[come][:, None] != node[here][None, :])
            if not linked.any():
                continue
            counts.append(np.stack([node[come], linked @ n[here]], 1))
            counts.append(np.stack([node[here], (linked & ~own[come][:, None]).T @ n[come]], 1))
            links.append(forest(linked, node[come], node[here]))
        counts, links = np.concatenate(counts), np.concatenate(links)
        counts = counts[counts[:, 1] > 0]
        return pa.table({
            "node": np.concatenate([counts[:, 0], links[:, 0]]),
            "n": np.concatenate([counts[:, 1], np.zeros(len(links), np.int64)]),
            "other": pa.array([*[None] * len(counts), *links[:, 1].tolist()], pa.int64())})

    return placed.groupBy("task").applyInArrow(meet, "node long, n long, other long")


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 least: float = 0.98, target_recall: float = 1.0) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector."""
    rows = stored(classes_of(deal_out(vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")))), "vectors")
    classes = stored(rows.where("node is not null").groupBy("node", "label").agg(
        F.min("id").alias("first_id"), F.count("*").alias("n"), F.first("v").alias("v")), "vector-classes")
    model = fit(classes, classes.count())
    cells = stored(assigned(classes, model), "cells")
    radii = {}
    for h, (c, r) in enumerate((("c1", "r1"), ("c2", "r2"))):
        for row in cells.groupBy("dim", c).agg(F.max(r).alias("r")).collect():  # one row per code
            radii[(row["dim"], h, row[c])] = row["r"] + 1e-9
    limit = 2 * (1 - least) * target_recall ** 2 + 1e-9
    place = ["label", "dim", "c1", "c2"]
    visit = stored(visits(cells, model, radii, limit), "visits")
    sizes = stored(
        cells.groupBy(*place).agg(F.count("*").alias("members")).join(
            visit.groupBy(*place).agg(F.count("*").alias("visitors")), place)
        .select(*place, F.ceil(F.col("members") / TILE).cast("int").alias("tiles"),
                F.ceil(F.col("visitors") / VISITORS).cast("int").alias("turns")), "cell-sizes")
    spread = lambda of: F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    members = (cells.select("node", "n", "unit", *place).join(sizes, place)
               .withColumn("tile", spread("tiles")).withColumn("turn", every("turns"))
               .withColumn("visitor", F.lit(False)).withColumn("own", F.lit(True)))
    come = (visit.join(sizes, place).join(cells.select("node", "n", "unit"), "node")
            .withColumn("turn", spread("turns")).withColumn("tile", every("tiles")).withColumn("visitor", F.lit(True)))
    cell = F.xxhash64(*place)
    task = F.when((F.col("tiles") > 1) | (F.col("turns") > 1), F.xxhash64("cell", "tile", "turn")).otherwise(
        F.pmod("cell", F.lit(GROUPS)))
    columns = ["task", "cell", "tile", "turn", "visitor", "own", "node", "n", "unit"]
    both = [s.withColumn("cell", cell).withColumn("task", task).select(*columns) for s in (members, come)]
    found = stored(met(both[0].union(both[1]), least), "vector-links")
    parts = stored(components(found.where("other is not null"), "node", "other"), "vector-parts")
    named = classes.select("node", "first_id", "n").join(parts, "node", "left").withColumn(
        "component", F.coalesce("component", "node")).join(
        found.groupBy("node").agg(F.sum("n").alias("links")), "node", "left")
    named = stored(named, "vector-named")
    smallest = stored(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "vector-smallest")
    result = stored(named.join(smallest, "component").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "vector-result")
    return rows.select("id", "node").join(result, "node", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"))
