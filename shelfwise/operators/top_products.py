"""Exact top-k by inner product of sparse rows with positive weights, without scoring all pairs.

Rows (members) are packed into blocks: inverted lists over the block's columns
with the largest weight per column. A block first compares its members with one
another, which gives each member a k-th best score that is a lower bound of its
final one. The product of the largest weights of two blocks (and of their
largest norms) bounds every score between them, so a pair of blocks is visited
only if the bound reaches the lowest k-th score on either side; inside a visit,
a member's own bound against the other block decides whether it is multiplied
at all, and only scores that reach its k-th best leave the task.

Blocks are cut in an order that makes bounds tight: by norm, so that pairs of
small rows are skipped, or by the nearest of a few sampled rows and by length, so
that a block has few heavy columns and near rows have found one another early. Blocks lie in the shared folder, and a task reads
those it visits one by one; nothing is shuffled per visit, and k rows per member leave a task. Members with very many entries are left out of the
blocks; their scores come from a join on the column, whose output is bounded by
their small number times the entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.blocks import Best, _round
from shelfwise.operators.ordering import SCORE_DIGITS, top_k
from shelfwise.session import shared_file, stored

#: Members of a block at most and at least, and entries of a block.
BLOCK, LEAST_BLOCK, BLOCK_ENTRIES = 4096, 256, 1 << 20
#: Members with more entries than this are joined by column instead.
HOT_ENTRIES = 1 << 18
#: Sampled rows that order unit rows, and their heaviest columns.
PIVOTS, PIVOT_COLUMNS = 64, 256
#: A product of two single entries costs as much as so many of a matrix (of one in single precision); so many are
#: made at once.
PAIR_COST, PLAIN_PAIR_COST, PAIRS = 200, 2000, 1 << 20
#: Columns multiplied at once.
WIDTH = 1024
#: Members that a task searches for at once, blocks per task, and rows it gives back at once.
HELD, TASK_BLOCKS, OUT_ROWS = 16384, 8, 1 << 18
#: Rounding and summation may lift a score over its bound by this much, relative to the bound.
SLACK = 1e-9
#: Weights whose products neither vanish nor overflow in single precision; exact products made pair by pair at
#: once, unless they are more than one in ``MANY`` of a matrix.
SMALL, LARGE, EXACT, MANY = 1e-15, 1e15, 512, 128

PACKED = ("block long, least double, norm double, columns array<long>, largest array<double>, ids binary, at binary, "
          "place binary, weights binary, floors binary, rows binary, others binary, scores binary")
FOUND = "member long, other long, score double"
_FOUND = pa.schema([("member", pa.int64()), ("other", pa.int64()), ("score", pa.float64())])


class Block:
    """Members (by id) of a block as sparse rows over its sorted columns."""

    def __init__(self, ids, at, place, weights, columns, floors):
        self.ids, self.at, self.place, self.weights = ids, at, place, weights
        self.columns, self.floors = columns, floors
        self.row = np.repeat(np.arange(len(ids)), np.diff(at))

    @classmethod
    def of(cls, ids, sizes, columns, weights, wanted) -> Block:
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        entry = np.argsort(np.repeat(rank, sizes), kind="stable")
        named, place = np.unique(columns[entry], return_inverse=True)
        at = np.concatenate([[0], np.cumsum(sizes[order])])
        return cls(ids[order], at, place, weights[entry], named, np.where(wanted[order], 0.0, np.inf))

    @classmethod
    def read(cls, one: dict) -> Block:
        read = lambda c, t: np.frombuffer(one[c], t)
        return cls(read("ids", np.int64), read("at", np.int64), read("place", np.int32), read("weights", np.float64),
                   np.asarray(one["columns"], np.int64), read("floors", np.float64).copy())

    @classmethod
    def together(cls, blocks: list[Block]) -> Block:
        """Several blocks as one; the members stay in the order of the blocks."""
        if len(blocks) == 1:
            return blocks[0]
        columns = np.unique(np.concatenate([b.columns for b in blocks]))
        shift = np.cumsum([0] + [len(b.weights) for b in blocks])
        return cls(np.concatenate([b.ids for b in blocks]),
                   np.concatenate([b.at[:-1] + n for b, n in zip(blocks, shift)] + [shift[-1:]]),
                   np.concatenate([np.searchsorted(columns, b.columns)[b.place] for b in blocks]),
                   np.concatenate([b.weights for b in blocks]), columns, np.concatenate([b.floors for b in blocks]))

    @cached_property
    def largest(self) -> np.ndarray:
        out = np.zeros(len(self.columns))
        np.maximum.at(out, self.place, self.weights)
        return out

    @cached_property
    def norms(self) -> np.ndarray:
        return np.sqrt(np.bincount(self.row, self.weights ** 2, minlength=len(self.ids)))

    @cached_property
    def plain(self) -> bool:
        """Whether single precision gives every product up to a relative error, as all weights are above 0."""
        return bool(len(self.weights)) and SMALL <= self.weights.min() and self.weights.max() <= LARGE

    @cached_property
    def by_column(self) -> tuple[np.ndarray, np.ndarray]:
        """The entries by column, and where each column starts."""
        order = np.argsort(self.place, kind="stable")
        return order, np.searchsorted(self.place[order], np.arange(len(self.columns) + 1))

    def shared(self, other: Block) -> tuple[np.ndarray, np.ndarray]:
        """The places of the common columns, here and there."""
        at = np.minimum(np.searchsorted(self.columns, other.columns), max(len(self.columns) - 1, 0))
        theirs = np.flatnonzero(self.columns[at] == other.columns) if len(self.columns) else at[:0]
        return at[theirs], theirs

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(line, entry) of the entries of some members."""
        n = self.at[rows + 1] - self.at[rows]
        line = np.repeat(np.arange(len(rows)), n)
        return line, np.arange(len(line)) + np.repeat(self.at[rows] - (np.cumsum(n) - n), n)

    def dense(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Rows as a matrix over some of the block's columns (given by place)."""
        to = np.full(len(self.columns), -1)
        to[columns] = np.arange(len(columns))
        line, entry = self.entries(rows)
        column = to[self.place[entry]]
        held = column >= 0
        out = np.zeros((len(rows), len(columns)))
        np.add.at(out, (line[held], column[held]), self.weights[entry[held]])
        return out

    def reach(self, other: Block, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Members whose bound against the other block reaches their floor."""
        largest = np.zeros(len(self.columns))
        largest[common[0]] = other.largest[common[1]]
        bound = np.bincount(self.row, self.weights * largest[self.place], minlength=len(self.ids))
        bound = np.minimum(bound, self.norms * other.norms.max(initial=0.0))
        return np.flatnonzero((bound > 0) & (bound * (1 + SLACK) + 10.0**-SCORE_DIGITS >= self.floors))

    def products(self, rows: np.ndarray, other: Block,
                 common: tuple[np.ndarray, np.ndarray] | None = None,
                 facing: np.ndarray | None = None) -> np.ndarray | tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inner products of some members with all of another block.

        A matrix, or, where few members share a column, (lines, places, products) of the pairs that share one.
        ``facing`` is the other block over the common columns, if it is at hand.
        """
        mine, theirs = self.shared(other) if common is None else common
        if facing is None:
            if self.meetings(rows, other, (mine, theirs)).sum() * PAIR_COST < len(rows) * len(other.ids) * len(mine):
                return self._pairs(rows, mine, theirs, other)
        elif len(mine) <= WIDTH:
            return self.dense(rows, mine) @ facing.T
        everyone = np.arange(len(other.ids))
        out = np.zeros((len(rows), len(everyone)))
        for low in range(0, len(mine), WIDTH):
            part = slice(low, low + WIDTH)
            out += self.dense(rows, mine[part]) @ other.dense(everyone, theirs[part]).T
        return out

    def meetings(self, rows: np.ndarray, other: Block, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """How many entries of the other block lie in the columns of each of some members."""
        there = np.zeros(len(self.columns), np.int64)
        there[common[0]] = np.bincount(other.place, minlength=len(other.columns))[common[1]]
        line, entry = self.entries(rows)
        return np.bincount(line, there[self.place[entry]], minlength=len(rows)).astype(np.int64)

    def _pairs(self, rows, mine, theirs, other) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shared = np.full(len(self.columns), -1)
        shared[mine] = theirs
        line, held = self.entries(rows)
        common = shared[self.place[held]] >= 0
        line, held = line[common], held[common]
        by_column, starts = other.by_column
        column = shared[self.place[held]]
        often = starts[column + 1] - starts[column]
        ends = np.cumsum(often)
        codes, sums = np.zeros(0, np.int64), np.zeros(0)
        first = 0
        while first < len(held):
            done = ends[first] - often[first]
            end = max(first + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
            part = slice(first, end)
            one = np.repeat(np.arange(first, end), often[part])
            two = by_column[np.arange(len(one)) - np.repeat(ends[part] - often[part] - done, often[part]) + starts[column[one]]]
            code = line[one] * len(other.ids) + other.row[two]
            weight = self.weights[held[one]] * other.weights[two]
            codes, place = np.unique(np.concatenate([codes, code]), return_inverse=True)
            sums = np.bincount(place, np.concatenate([sums, weight]), minlength=len(codes))
            first = end
        return codes // len(other.ids), codes % len(other.ids), sums


class Lists(Best):
    """The k best found so far of each member of a block; the last of a full list is the member's floor."""

    def __init__(self, block: Block, k: int, digits: tuple[int, float] | None):
        super().__init__(len(block.ids), k)
        self.block, self.digits = block, digits

    def add(self, rows: np.ndarray, others: np.ndarray, scores: np.ndarray) -> None:
        """Take in scores above 0 that reach the members' floors."""
        super().add(rows, others, scores)
        named = np.unique(rows)
        named = named[self.floors[named] > -np.inf]
        self.block.floors[named] = self.floors[named]

    def visit(self, other: Block) -> None:
        """Meet all members of another block (or of the own one) that can enter a list, some rows at a time."""
        mine = self.block
        common = mine.shared(other)
        rows = mine.reach(other, common)
        if not len(rows):
            return
        meetings = mine.meetings(rows, other, common)
        rough = None
        plain = len(common[0]) <= WIDTH and mine.plain and other.plain
        cost = PLAIN_PAIR_COST if plain else PAIR_COST
        few = meetings.sum() * cost < len(rows) * len(other.ids) * len(common[0])
        facing = None
        if few:
            ends = np.cumsum(meetings)
        else:
            ends = np.arange(1, len(rows) + 1) * len(other.ids)
            # One matrix for all rows, if it is small enough; an empty one asks for a part after another.
            facing = other.dense(np.arange(len(other.ids)), common[1][:0 if len(common[0]) > WIDTH else None])
            if plain:
                rough = facing.astype(np.float32)
        first = 0
        while first < len(rows):
            done = ends[first - 1] if first else 0
            end = max(first + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
            part = rows[first:end]
            if rough is not None:
                exact = mine.dense(part, common[0])
                self._take(part, other, exact.astype(np.float32) @ rough.T, (exact, facing))
            else:
                products = mine._pairs(part, *common, other) if few else mine.products(part, other, common, facing)
                self._take(part, other, products)
            first = end

    def _take(self, rows: np.ndarray, other: Block, products, exact: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        """Take in products. With ``exact``, the rows of both sides, they are in single precision.

        Single precision then only tells which pairs can reach a floor, up to its largest relative error; the
        products of these are made anew.
        """
        floor = self.block.floors[rows]
        if isinstance(products, tuple):
            at, place, score = products
        else:
            error = 0.0 if exact is None else 2.0**-22 * (exact[0].shape[1] + 4)
            least = floor[:, None]
            open_rows = np.flatnonzero(floor == 0)
            # Without a floor yet, the k-th best of the row is one; the member itself may be among them.
            if len(open_rows) and self.k + 1 < products.shape[1]:
                least = least.copy()
                last = products.shape[1] - self.k - 1
                least[open_rows, 0] = np.maximum(
                    np.partition(products[open_rows], last, axis=1)[:, last].astype(float) * (1 - error), 0.0)
            least = (least - 10.0**-SCORE_DIGITS) * (1 - error)
            if exact is None:
                at, place = np.nonzero((products >= least) & (products > 0))
                score = products[at, place]
            else:
                # The next number below in single precision, or the smallest above 0: one comparison will do.
                least = np.maximum(np.nextafter(least.astype(np.float32), np.float32(0)), np.finfo(np.float32).tiny)
                at, place = np.divmod(np.flatnonzero(products >= least), products.shape[1])
                if len(at) * MANY > products.size:
                    score = (exact[0] @ exact[1].T)[at, place]
                else:
                    score = np.concatenate([np.zeros(0), *[
                        np.einsum("ij,ij->i", exact[0][at[low:low + EXACT]], exact[1][place[low:low + EXACT]])
                        for low in range(0, len(at), EXACT)]])
        score = _rounded(score, self.digits)
        fit = (score >= floor[at]) & (score > 0) & (self.block.ids[rows][at] != other.ids[place])
        self.add(rows[at[fit]], other.ids[place[fit]], score[fit])


def _rounded(scores: np.ndarray, digits: tuple[int, float] | None) -> np.ndarray:
    return scores if digits is None else _round(scores + digits[1], 10.0**digits[0])


def _packed(number: int, block: Block, k: int, digits: tuple[int, float] | None) -> dict:
    """A block after its members have met one another: their floors are the k-th best scores so far."""
    lists = Lists(block, k, digits)
    lists.visit(block)
    rows, _, others, scores = lists.found()
    return {
        "block": number, "least": block.floors.min(initial=np.inf), "norm": block.norms.max(initial=0.0),
        "columns": block.columns, "largest": block.largest, "ids": block.ids.tobytes(), "at": block.at.tobytes(),
        "place": block.place.astype(np.int32).tobytes(), "weights": block.weights.tobytes(),
        "floors": block.floors.tobytes(),
        "rows": rows.astype(np.int32).tobytes(), "others": others.tobytes(), "scores": scores.tobytes()}


def _pack(members: DataFrame, k: int, digits: tuple[int, float] | None, size: int, entries: int) -> DataFrame:
    """One row per block from ordered partitions of (id, wanted, columns, weights, group).

    A block that is a quarter full ends where the group changes.
    """
    kinds = {"block": pa.int64(), "least": pa.float64(), "norm": pa.float64(), "columns": pa.list_(pa.int64()),
             "largest": pa.list_(pa.float64())}

    def row(held: list, number: int) -> pa.RecordBatch:
        ids, sizes, columns, weights, wanted = (np.concatenate(x) for x in zip(*held))
        values = _packed(number, Block.of(ids, sizes, columns, weights, wanted), k, digits)
        return pa.RecordBatch.from_arrays(
            [pa.array([v], kinds.get(c, pa.binary())) for c, v in values.items()], names=list(values))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, n, m, group = [], 0, 0, None
        for batch in batches:
            ids, groups = batch.column(0).to_numpy(), batch.column(4).to_numpy()
            turns = np.append(np.flatnonzero(groups[1:] != groups[:-1]) + 1, len(ids))
            wanted = batch.column(1).to_numpy(zero_copy_only=False)
            sizes = batch.column(2).value_lengths().to_numpy().astype(np.int64)
            columns, weights = (batch.column(i).flatten().to_numpy() for i in (2, 3))
            at = np.concatenate([[0], np.cumsum(sizes)])
            first = 0
            while first < len(ids):
                if n >= size // 4 and groups[first] != group:
                    yield row(held, number)
                    held, n, m, number = [], 0, 0, number + 1
                group = groups[first]
                room = int(np.searchsorted(at, at[first] + entries - m, "right")) - 1
                turn = int(turns[np.searchsorted(turns, first, "right")])
                end = min(max(room, first + (n == 0)), first + size - n, turn)
                if end > first:
                    cut = slice(first, end), slice(at[first], at[end])
                    held.append((ids[cut[0]], sizes[cut[0]], columns[cut[1]], weights[cut[1]], wanted[cut[0]]))
                    n, m = n + end - first, m + at[end] - at[first]
                if end < turn:  # the block is full
                    yield row(held, number)
                    held, n, m, number = [], 0, 0, number + 1
                first = end
        if n:
            yield row(held, number)

    return members.mapInArrow(build, PACKED)


def _grouped(members: DataFrame, pivots: int) -> DataFrame:
    """Add the group of each member: the sampled row (a bounded number) with which it has the largest product.

    Groups only decide which members share a block; any choice gives the same result.
    """
    heavy = members.orderBy(F.xxhash64("member"), "member").limit(pivots).select(
        F.slice("columns", 1, PIVOT_COLUMNS).alias("c"), F.slice("weights", 1, PIVOT_COLUMNS).alias("w")).collect()
    columns = np.unique(np.concatenate([np.array(r["c"], np.int64) for r in heavy] or [np.zeros(0, np.int64)]))
    matrix = np.zeros((len(columns) + 1, max(len(heavy), 1)))  # the last line is for all other columns
    for i, r in enumerate(heavy):
        matrix[np.searchsorted(columns, r["c"]), i] = r["w"]
    shared = members.sparkSession.sparkContext.broadcast((columns, matrix))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, matrix = shared.value
        for batch in batches:
            at = np.concatenate([[0], np.cumsum(batch.column(2).value_lengths().to_numpy().astype(np.int64))])
            held, weights = (batch.column(i).flatten().to_numpy() for i in (2, 3))
            line = np.minimum(np.searchsorted(columns, held), max(len(columns) - 1, 0))
            line = np.where(columns[line] == held, line, len(columns)) if len(columns) else line
            near = np.zeros(batch.num_rows, np.int64)
            first = 0
            while first < batch.num_rows:
                end = max(first + 1, int(np.searchsorted(at, at[first] + (1 << 16), "right")) - 1)
                part = slice(at[first], at[end])
                sums = np.add.reduceat(weights[part, None] * matrix[line[part]], at[first:end] - at[first])
                near[first:end] = sums.argmax(1)
                first = end
            yield batch.append_column("group", pa.array(near))

    return members.mapInArrow(build, "member long, wanted boolean, columns array<long>, weights array<double>, group long")


def visits(blocks: DataFrame) -> DataFrame:
    """Pairs i < j of blocks with a score that can reach a floor, from the largest weights they have in common."""
    tops = blocks.select("block", "least", "norm", F.explode(F.arrays_zip("columns", "largest")).alias("_c"))
    a = tops.select(F.col("block").alias("i"), F.col("least").alias("_li"), F.col("norm").alias("_ni"),
                    "_c.columns", F.col("_c.largest").alias("_wi"))
    b = tops.select(F.col("block").alias("j"), F.col("least").alias("_lj"), F.col("norm").alias("_nj"),
                    "_c.columns", F.col("_c.largest").alias("_wj"))
    bounds = a.join(b, "columns").where("i < j").groupBy("i", "j").agg(
        F.sum(F.col("_wi") * F.col("_wj")).alias("_sum"), F.first(F.col("_ni") * F.col("_nj")).alias("_norms"),
        F.first(F.least("_li", "_lj")).alias("_least"))
    bound = F.least("_sum", "_norms") * (1 + SLACK) + 10.0**-SCORE_DIGITS
    return bounds.where(bound >= F.col("_least")).select("i", "j")


def _blocks_of(path: str, wanted: set[int], columns: list[str]) -> Iterator[dict]:
    """Some blocks of a file of the stored table, one at a time."""
    for batch in shared_file(path).iter_batches(batch_size=1, columns=["block", *columns]):
        if batch.column(0)[0].as_py() in wanted:
            one = {c: batch.column(c)[0].as_buffer() for c in columns if c != "columns"}
            yield {"columns": batch.column("columns").flatten().to_numpy()} | one


def _searched(blocks: DataFrame, pairs: DataFrame, k: int, digits: tuple[int, float] | None) -> DataFrame:
    """The k best of every wanted member: what its block found at home and in the blocks to visit.

    A task holds some blocks with the lists of their members and reads the others from the shared folder one
    by one, near ones first, so lists fill early, floors rise from visit to visit, and only full lists leave it.
    """
    where = blocks.select("block", F.col("_metadata.file_path").alias("path"))
    ways = pairs.select("i", "j").unionByName(pairs.select(F.col("j").alias("i"), F.col("i").alias("j")))
    there = where.select(F.col("block").alias("j"), F.col("path").alias("_at"))
    others = ways.join(there, "j").groupBy(F.col("i").alias("block")).agg(
        F.collect_list(F.struct(F.abs(F.col("j") - F.col("i")).alias("away"), "j", F.col("_at").alias("path"))).alias("others"))
    asked = where.join(others, "block", "left")
    spark = blocks.sparkSession
    n = blocks.count()
    tasks = max(1, min(n, 2 * spark.sparkContext.defaultParallelism), -(-n // TASK_BLOCKS))
    asked = asked.repartitionByRange(tasks, "block").sortWithinPartitions("block")
    fields = ["columns", "ids", "at", "place", "weights", "floors"]

    def search(held: list) -> Iterator[pa.RecordBatch]:
        block = Block.together([h[0] for h in held])
        lists, first = Lists(block, k, digits), 0
        for one, home, _ in held:
            rows, others, scores = (np.frombuffer(home[c], t) for c, t in (
                ("rows", np.int32), ("others", np.int64), ("scores", np.float64)))
            lists.add(first + rows.astype(np.int64), others, scores)
            first += len(one.ids)
        numbers = {h[2]["block"] for h in held}
        to_see: dict[str, dict[int, int]] = {}
        for _, _, row in held:
            for o in row["others"] or []:
                seen = to_see.setdefault(o["path"], {})
                seen[o["j"]] = min(o["away"], seen.get(o["j"], o["away"]))
        for path in sorted(to_see, key=lambda p: min(to_see[p].values())):
            for other in _blocks_of(path, set(to_see[path]) - numbers, fields):
                lists.visit(Block.read(other))
        # The blocks held together have not met either; each meets the others alone, as its own members are done.
        if len(held) > 1:
            ends = np.cumsum([len(h[0].ids) for h in held])
            for (one, _, _), end in zip(held, ends):
                inside = slice(end - len(one.ids), end)
                floors = block.floors[inside].copy()
                block.floors[inside] = np.inf
                lists.visit(one)
                block.floors[inside] = floors
        rows, _, others, scores = lists.found()
        for low in range(0, max(len(rows), 1), OUT_ROWS):
            part = slice(low, low + OUT_ROWS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids[rows[part]]), pa.array(others[part]), pa.array(scores[part])], schema=_FOUND)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, members, entries = [], 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                one = next(_blocks_of(row["path"], {row["block"]}, [*fields, "rows", "others", "scores"]))
                block = Block.read(one)
                if not np.isfinite(block.floors).any():
                    continue  # nobody here is asked for
                if held and (members + len(block.ids) > HELD or entries + len(block.weights) > BLOCK_ENTRIES):
                    yield from search(held)
                    held, members, entries = [], 0, 0
                held.append((block, {c: one[c] for c in ("rows", "others", "scores")}, row))
                members, entries = members + len(block.ids), entries + len(block.weights)
        if held:
            yield from search(held)

    return asked.mapInArrow(build, FOUND)


def _by_column(rows: DataFrame, hot: DataFrame, digits: tuple[int, float] | None) -> DataFrame:
    """Scores of the few very long members with every member, both ways."""
    a = rows.join(hot.select("member"), "member", "left_semi").select(
        F.col("member").alias("a"), "column", F.col("weight").alias("_wa"))
    b = rows.select(F.col("member").alias("b"), "column", F.col("weight").alias("_wb"), "wanted")
    score = F.sum(F.col("_wa") * F.col("_wb"))
    sums = a.join(b, "column").where("a <> b").groupBy("a", "b").agg(
        (score if digits is None else F.round(score + digits[1], digits[0])).alias("score"))
    both = F.explode(F.array(F.struct(F.col("a").alias("member"), F.col("b").alias("other")),
                             F.struct(F.col("b").alias("member"), F.col("a").alias("other"))))
    # A pair of two long members is found from either side.
    return sums.select(both.alias("_e"), "score").select("_e.*", "score").distinct()


def top_products(
    rows: DataFrame, k: int, order: str = "norm", digits: int | None = SCORE_DIGITS, wanted: DataFrame | None = None,
    nudge: float = 0.0, block: int | None = None, entries: int = BLOCK_ENTRIES, hot: int = HOT_ENTRIES,
) -> DataFrame:
    """(member, other, score, rank): of every member the k others of the largest product, above 0.

    ``rows`` (member, column, weight): one row per member and column, whole
    numbers as ids, weights above 0; other rows are ignored. Scores plus ``nudge`` are
    rounded to ``digits`` (None: neither), ties go to the lower id. With ``wanted`` (member) only these get
    lists. ``order`` "norm" suits rows of different length, "columns" unit rows.
    """
    rounding = None if digits is None else (digits, nudge)
    asked = F.lit(True)
    rows = rows.select("member", F.col("column").cast("bigint"), F.col("weight").cast("double")).where(
        "member is not null and column is not null and weight > 0")
    if wanted is not None:
        named = wanted.select("member").distinct().withColumn("wanted", F.lit(True))
        rows, asked = rows.join(named, "member", "left"), F.coalesce("wanted", F.lit(False))
    rows = stored(rows.withColumn("wanted", asked), "product-rows")
    sizes = rows.groupBy("member").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n").alias("n"), F.count("*").alias("m"), F.max("n").alias("most")).first()
    long = stored(sizes.where(F.col("n") > hot), "long-members") if (total["most"] or 0) > hot else None
    spark = rows.sparkSession
    if block is None:
        block = min(BLOCK, max(LEAST_BLOCK, -(-total["m"] // spark.sparkContext.defaultParallelism)))
    entry = F.collect_list(F.struct(F.col("weight").alias("w"), F.col("column").alias("c")))
    short = rows if long is None else rows.join(long.select("member"), "member", "left_anti")
    packed = short.groupBy("member").agg(
        F.sort_array(entry, False).alias("e"), F.first("wanted").alias("wanted"))
    slices = max(1, -(-total["m"] // block), -(-(total["n"] or 0) // entries))
    members = packed.select("member", "wanted", F.col("e.c").alias("columns"), F.col("e.w").alias("weights"))
    if order == "norm":
        norm = F.aggregate("weights", F.lit(0.0), lambda acc, w: acc + w * w)
        members, by = members.withColumn("group", F.lit(0).cast("bigint")), norm.desc()
    else:
        members, by = _grouped(stored(members, "members"), min(PIVOTS, 2 * slices)), F.size("columns")
    ordered = stored(members, "grouped").repartitionByRange(slices, "group", by, "member")
    blocks = stored(_pack(ordered.sortWithinPartitions("group", by, "member"), k, rounding, block, entries), "blocks")
    found = _searched(blocks, stored(visits(blocks), "visits"), k, rounding)
    if long is not None:
        joined = _by_column(rows, long, rounding)
        if wanted is not None:
            joined = joined.join(wanted.select("member").distinct(), "member", "left_semi")
        found = found.unionByName(joined.where("score > 0"))
    return top_k(found, k, per="member", tie="other")
