"""Ranked lexical search by dense blocked matrix products in whole numbers held exactly by doubles.

The score of a document for an item is a sum over the item's terms of weight
times impact. Items are taken in blocks whose terms have a bounded number; a
block's distinct terms are its compact vocabulary, cut into tiles. A task turns
its documents into tiles (documents x vocabulary) of impacts and multiplies
them by the block's (vocabulary x items) counts. All entries are whole numbers,
and a vocabulary tile ends before a partial sum could reach 2^53 (a term that
an item repeats too often is spread over tiles), so a product is exact in
whatever order BLAS adds; tiles are added up in 64-bit integers.

A task keeps the k best of each item over all its tiles, ordered by (score, id),
so ties at the edge are decided as in the final ranking; these few rows per task
are cut again per group of tasks and then per item. Statistics (documents,
terms, documents per term) are sums over all documents.

Defined results: a null or empty text has no terms and no score; an item
without terms, or whose terms no document has, gets no rows. Ids of documents are whole numbers; a
document without id is counted and ranked, after equal scores with an id.
Repeated documents are ranked one by one. Repeated items (and items without id)
are ranked one by one, each with its own rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.shared import deal_out, stored
from shelfwise.llm.texts import coded_words, pieces

K = 20
#: Partial sums stay below this, so doubles hold them exactly.
EXACT = 1 << 53
#: Impacts are below this: (10^9 tf) div (1000 tf + 12 m), m > 0.
IMPACT = 1_000_000
#: Terms (with repeats) of the items of one block; a block is a pass over the documents.
BLOCK_TERMS = 1 << 18
#: Shape of the dense tiles.
TILE_TERMS, TILE_DOCS, TILE_ITEMS = 1024, 512, 1024
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Bytes of terms with A-Z lower-cased, every other byte a space.
TERM = np.where(_WORD, np.arange(256), 32).astype(np.uint8)
TERM[65:91] += 32
LAST = np.iinfo(np.int64).max


def terms_of(data: np.ndarray, at: np.ndarray, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and vocabulary places of the words that the vocabulary has, and all words per row."""
    distinct, codes, _, _, rows = coded_words(TERM[data], at)
    place = pc.index_in(distinct, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    place = place[codes] if len(codes) else codes
    return rows[place >= 0], place[place >= 0], np.bincount(rows, minlength=len(at) - 1)


def counted_terms(rows: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, place) and how often each occurs."""
    flat, n = np.unique(rows * size + place, return_counts=True)
    return flat // size, flat % size, n


def statistics(docs: DataFrame, text_col: str, vocabulary: pa.Array) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and documents per term of the vocabulary."""
    size = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size + 2, np.int64)
        for batch in batches:
            for _, _, data, at in pieces(batch.column(0)):
                rows, place, n = terms_of(data, at, vocabulary)
                held[:size] += np.bincount(counted_terms(rows, place, size)[1] if size else place, minlength=size)
                held[size:] += [np.count_nonzero(n), n.sum()]
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=["at", "n"])

    out = np.zeros(size + 2, np.int64)
    for r in docs.select(text_col).mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]  # one row per term of the vocabulary at most
    return int(out[size]), int(out[size + 1]), out[:size]


def weights(documents: int, held: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * held + 1))).astype(np.int64)


def vocabulary_tiles(item: np.ndarray, place: np.ndarray, n: np.ndarray, weight: np.ndarray,
                     most: int = TILE_TERMS, exact: int = EXACT) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Tiles of (terms, and the items, columns and counts of their entries).

    No item's sum of count x weight x largest impact in a tile reaches ``exact``.
    """
    tiles = []
    order = np.lexsort((item, place))
    item, place, n = item[order], place[order], n[order].copy()
    while len(n):
        # Terms in order; a term joins the tile while every item that has it stays below the bound.
        columns = np.cumsum(np.concatenate([[1], place[1:] != place[:-1]])) - 1
        part = np.minimum(n, (exact - 1) // np.maximum(weight[place] * IMPACT, 1))
        if (part < 1).any():
            raise ValueError("a single term outweighs what a double holds exactly")
        near = np.flatnonzero(columns < most)
        near = near[np.argsort(item[near], kind="stable")]
        # At most 1,024 values below 2^53 an item: its sums fit 64 bits, and those over all items may wrap around.
        worth = part[near] * weight[place[near]] * IMPACT
        sums = np.cumsum(worth)
        head = np.concatenate([[True], item[near][1:] != item[near][:-1]])
        sums -= (sums - worth)[np.flatnonzero(head)][np.cumsum(head) - 1]
        end = int(columns[near][sums >= exact].min(initial=most))
        inside = columns < end
        terms = place[inside][np.concatenate([[True], place[inside][1:] != place[inside][:-1]])]
        tiles.append((terms, item[inside], columns[inside], part[inside]))
        n = n - np.where(inside, part, 0)
        item, place, n = item[n > 0], place[n > 0], n[n > 0]
    return tiles


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 12 m) of each entry, where m follows from the document's number of terms."""
    if 25 * int(n.max(initial=0)) * documents < 1 << 63:
        share = 25 * n * documents // max(terms, 1)
    else:
        share = np.array([25 * int(x) * documents // terms for x in n], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 12 * (75 + share))


class Best:
    """The k best (score, id) of each item so far; null ids have the largest place."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score = np.zeros((items, k), np.int64)
        self.id = np.full((items, k), LAST)

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of (documents x items from ``first``), merged with what is held."""
        span = slice(first, first + scores.shape[1])
        floor = self.score[span, -1]
        reach = scores >= np.maximum(floor, 1)
        for j in np.flatnonzero(reach.any(0)):
            s, i = scores[reach[:, j], j], ids[reach[:, j]]
            s, i = np.concatenate([self.score[first + j], s]), np.concatenate([self.id[first + j], i])
            order = np.lexsort((i, -s))[:self.k]
            self.score[first + j], self.id[first + j] = s[order], i[order]


def block_scores(docs: DataFrame, id_col: str, text_col: str, model: dict, k: int) -> DataFrame:
    """(item, id, score, task): the k best documents of each task for each item of a block."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the terms of a block

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        size, items = len(m["vocabulary"]), m["items"]
        best = Best(items, k)
        for batch in batches:
            ids_here = batch.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
            for start, end, data, at in pieces(batch.column(1)):
                rows, place, n = terms_of(data, at, m["vocabulary"])
                rows, place, tf = counted_terms(rows, place, size)
                value = impacts(tf, n[rows], m["documents"], m["terms"]) * m["weight"][place]
                for low in range(0, end - start, TILE_DOCS):
                    high = min(low + TILE_DOCS, end - start)
                    here = slice(*np.searchsorted(rows, [low, high]))
                    if here.start == here.stop:
                        continue
                    held = np.unique(rows[here])
                    tile = np.searchsorted(held, rows[here])
                    for left in range(0, items, TILE_ITEMS):
                        scores = _product(tile, place[here], value[here], len(held), size,
                                          m["tiles"], left, min(left + TILE_ITEMS, items))
                        best.add(left, scores, ids_here[start:end][held])
        item, rank = np.nonzero(best.score)
        ids = best.id[item, rank]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(ids, mask=ids == LAST), pa.array(best.score[item, rank])], names=["item", "id", "score"])

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        build, "item long, id long, score long")
    return out.withColumn("task", F.spark_partition_id())


def _product(row: np.ndarray, place: np.ndarray, value: np.ndarray, rows: int, size: int, tiles: list,
             left: int, right: int) -> np.ndarray:
    """Scores (rows x items left to right): one exact product per vocabulary tile, of the terms that occur here."""
    scores = np.zeros((rows, right - left), np.int64)
    column = np.full(size, -1)
    for terms, item, at, n in tiles:
        mine = (item >= left) & (item < right)
        wanted = np.zeros(len(terms), bool)
        wanted[at[mine]] = True
        column[:] = -1
        column[terms[wanted]] = 0
        seen = np.unique(place[column[place] == 0])
        if not len(seen):
            continue
        column[:] = -1
        column[seen] = np.arange(len(seen))
        to = column[place]
        documents = np.zeros((rows, len(seen)))
        documents[row[to >= 0], to[to >= 0]] = value[to >= 0]
        counts = np.zeros((len(seen), right - left))
        to = column[terms[at]]
        mine &= to >= 0
        counts[to[mine], item[mine] - left] = n[mine]
        scores += (documents @ counts).astype(np.int64)
    return scores


def top_k(found: DataFrame, k: int) -> DataFrame:
    """(item, rank, id, score): the k best rows of each item, by way of the k best per group of tasks."""
    order = [F.desc("score"), F.asc_nulls_last("id")]
    groups = max(isqrt(found.rdd.getNumPartitions()), 1)
    near = found.withColumn("group", F.col("task") % groups)
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("item", "group").orderBy(*order)))
    near = near.where(F.col("rank") <= k)
    final = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return final.where(F.col("rank") <= k).select("item", "rank", "id", "score")


def rank_documents(documents: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item, rank, document, score): the k documents of the highest score above 0 for each item."""
    spark = documents.sparkSession
    docs = deal_out(documents.select(id_col, text_col))
    words = F.regexp_extract_all(F.translate(F.col("__text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                                 F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    asked = items.select(F.col(item_col).alias("__item"), F.col(item_text_col).alias("__text")).withColumn("__words", words)
    asked = stored(asked.where(F.size("__words") > 0).select("__item", "__words"), "items")
    total = asked.agg(F.sum(F.size("__words"))).first()[0] or 0
    blocks = -(-total // block_terms)
    spread = F.pmod(F.xxhash64("__item", "__words"), F.lit(max(blocks, 1)))
    results, said = [], asked.schema["__item"].dataType.simpleString()
    for b in range(blocks):
        block = asked.where(spread == b).collect()  # bounded by the terms of a block (one longer item is a block's only excess)
        if not block:
            continue
        names = pa.array(sorted({w for r in block for w in r["__words"]}), pa.string())
        vocabulary = names.cast(pa.large_binary())
        number = {w: i for i, w in enumerate(names.to_pylist())}
        size = len(names)
        flat = np.concatenate([np.array([number[w] for w in r["__words"]], np.int64) + i * size for i, r in enumerate(block)])
        flat, n = np.unique(flat, return_counts=True)
        count, terms, held = statistics(docs, text_col, vocabulary)
        weight = weights(count, held)
        model = {"vocabulary": vocabulary, "weight": weight, "documents": count, "terms": terms, "items": len(block),
                 "tiles": vocabulary_tiles(flat // size, flat % size, n.astype(np.int64), weight)}
        best = top_k(block_scores(docs, id_col, text_col, model, k), k)
        ids = spark.createDataFrame([(i, r["__item"]) for i, r in enumerate(block)], f"item long, __item {said}")
        results.append(best.join(F.broadcast(ids), "item").select(  # no more rows than the block has items
            F.col("__item").alias(item_col), F.col("rank"), F.col("id").alias(id_col), F.col("score")))
    if not results:
        return spark.createDataFrame([], f"`{item_col}` {said}, rank int, `{id_col}` long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.union(more)
    return out
