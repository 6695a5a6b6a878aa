"""Count features of whole texts and bounded labelled samples, for the three classifiers.

All features come from byte arrays (see ``texts``): n-grams of letters for
languages, n-grams of character classes and repetition for quality. A text of any length gives one row of counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.texts import LOWER, U, as_bytes, code_counts, hashed_words, pieces

# The character classes, in the order of their numbers.
CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n",
           ".", ",", "!", "|", "#", "*", "%", "&", "$", "<>{}[]()/=_\\;:+-"]
_CLASS_OF = np.full(256, len(CLASSES), np.uint8)
for _number, _chars in enumerate(CLASSES):
    _CLASS_OF[list(_chars.encode())] = _number
_CLASS_OF[128:] = 0

LETTER = np.where(np.isin(np.arange(256), [*range(97, 123), *range(128, 256)]), np.arange(256), 32).astype(np.uint8)

LETTER_DIMS = 4096
CLASS_DIMS = 4096
LEVELS = 16
LEVEL_WEIGHT = 12
SHAPE_DIMS = CLASS_DIMS + 3 * LEVELS


def _row_of_byte(at: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))


def letter_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashed counts of 1-, 2- and 3-grams of lower-cased letters; anything else is one space."""
    letters = LETTER[LOWER[data]].astype(np.uint32)
    rows, n = _row_of_byte(at), len(at) - 1
    total = np.zeros((n, LETTER_DIMS), np.int64)
    for size in (1, 2, 3):
        if len(letters) < size:
            break
        code = np.zeros(len(letters) - size + 1, np.uint32)
        for i in range(size):
            code = code * np.uint32(257) + letters[i: len(letters) - size + 1 + i]
        code = (code * np.uint32(2654435761) + np.uint32(size * 40503)) >> np.uint32(20)
        one_row = rows[: len(code)] == rows[size - 1:]
        # A row's n-grams of spaces alone say nothing.
        told = one_row & (letters[: len(code)] + letters[size - 1:] != 64)
        total += code_counts(rows[: len(code)][told], code[told], n, LETTER_DIMS)
    return total


def shape_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of 3-grams of character classes, and how repetitive and how long the text is as levels."""
    n = len(at) - 1
    out = np.zeros((n, SHAPE_DIMS), np.int64)
    classes, rows = _CLASS_OF[data].astype(np.int32), _row_of_byte(at)
    if len(classes) >= 3:
        code = classes[:-2] * 256 + classes[1:-1] * 16 + classes[2:]
        inside = rows[:-2] == rows[2:]
        out[:, :CLASS_DIMS] = code_counts(rows[:-2][inside], code[inside], n, CLASS_DIMS)
    words, of = hashed_words(data, at)
    n_words = np.bincount(of, minlength=n)
    twice = np.zeros(len(words), bool)
    twice[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
    distinct = np.unique(words ^ (of.astype(U) * U(0x9E3779B97F4A7C15)), return_index=True)[1]
    shares = [np.bincount(of[twice], minlength=n) / np.maximum(n_words, 1),
              1 - np.bincount(of[distinct], minlength=n) / np.maximum(n_words, 1)]
    levels = [np.minimum((s * LEVELS).astype(int), LEVELS - 1) for s in shares]
    levels.append(np.minimum(np.log2(n_words + 1).astype(int), LEVELS - 1))
    for k, level in enumerate(levels):
        out[np.arange(n), CLASS_DIMS + k * LEVELS + level] = LEVEL_WEIGHT
    return out


Counter = Callable[[np.ndarray, np.ndarray], np.ndarray]


def sample_ids(df: DataFrame, id_col: str, label_cols: list[str], bound: int) -> DataFrame:
    """At most ``bound`` ids with their labels, in equal parts per label, picked by a hash of the id.

    Only ids and labels are ranked, and each task keeps its best few per label
    before anything is shuffled. With more labels than ``bound``, the most
    frequent ones are kept.
    """
    spark = df.sparkSession
    pairs = df.select(F.col(id_col).alias("id"), *label_cols).where(F.col("id").isNotNull())
    for c in label_cols:
        pairs = pairs.where(F.col(c).isNotNull())
    labels = pairs.groupBy(*label_cols).count().orderBy(F.desc("count"), *label_cols).limit(bound).collect()
    each = max(1, bound // max(1, len(labels)))
    # Only hashes low enough to be among the first few of their label go into the ranking.
    share = [(*[r[c] for c in label_cols], min(1.0, 2 * (each + 16) / r["count"])) for r in labels]
    cuts = spark.createDataFrame(share, pairs.select(*label_cols).schema.add("cut", "double"))
    pairs = pairs.withColumn("h", F.xxhash64("id")).join(F.broadcast(cuts), label_cols).where(
        F.col("h").cast("double") / 2.0 ** 64 + 0.5 <= F.col("cut"))
    ranked = pairs.withColumn("r", F.row_number().over(
        Window.partitionBy(*label_cols).orderBy("h", "id"))).where(F.col("r") <= each)
    picked = ranked.select("id", *label_cols).collect()[:bound]  # at most ``bound`` ids
    schema = pairs.select("id", *label_cols).schema
    return spark.createDataFrame([tuple(r) for r in picked], schema)


def counted(df: DataFrame, text_col: str, keep: list[str], counter: Counter) -> DataFrame:
    """The kept columns and the features of each text as 16-bit counts (capped at 65,535), packed."""
    schema = df.select(*keep).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            for first, end, data, at in pieces(texts):
                table = np.minimum(counter(data, at), 65535).astype(np.uint16)
                rows = batch.slice(first, end - first).select(keep)
                yield rows.append_column("features", pa.array([t.tobytes() for t in table], pa.binary()))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
    return df.select(*keep, text_col).mapInArrow(count, ", ".join([*fields, "features binary"]))


def unpack(rows: list, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(r["features"]) for r in rows), np.uint16).reshape(len(rows), dims)


def document_frequencies(texts: DataFrame, text_col: str, counter: Counter, dims: int) -> tuple[int, np.ndarray]:
    """Rows and, for each feature, the rows that hold it; every task sends one partial sum."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(dims, np.int64), 0
        for batch in batches:
            for first, end, data, at in pieces(batch.column(0)):
                held += (counter(data, at) > 0).sum(0)
                n += end - first
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dims + 1)), pa.array(np.append(held, n))], names=["feature", "n"])

    sums = texts.select(text_col).mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = np.zeros(dims + 1, np.int64)
    for r in sums.collect():
        found[r["feature"]] = r["n"]
    return int(found[dims]), found[:dims]


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one: (1 + log tf) * idf; an empty row stays zero."""
    w = counts.astype(np.float32)
    np.log1p(w, out=w)
    w *= idf.astype(np.float32)
    norm = np.sqrt(np.einsum("ij,ij->i", w, w))[:, None]
    w /= np.where(norm > 0, norm, 1)
    return w


def smooth_idf(n: int, held: np.ndarray) -> np.ndarray:
    return np.log((1 + n) / (1 + held)) + 1


__all__ = ["as_bytes", "counted", "document_frequencies", "letter_counts", "sample_ids", "shape_counts",
           "smooth_idf", "unpack", "weighted"]
