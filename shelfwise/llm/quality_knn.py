"""Quality by nearest-neighbour voting among latent-semantic vectors.

A bounded labelled sample spans the latent space: TF-IDF rows of character
class n-grams and repetition levels, reduced by a truncated singular value
decomposition. The labelled vectors are broadcast (``SAMPLE`` x ``RANK``
numbers); every document is folded in and its cosines to all of them are exact
matrix products in blocks. The nearest labels vote, weighted by similarity.

Defined results: a null or empty text is a document without words and gets the
vote of its nearest neighbours as any other; without labels the score is 0.
Repeated rows are kept; of repeated labels of a document the lowest counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.features import (
    SHAPE_DIMS, counted, document_frequencies, sample_ids, shape_counts, smooth_idf, unpack, weighted,
)
from shelfwise.llm.shared import by_crc, deal_out
from shelfwise.llm.texts import pieces

#: Labelled documents that span the space and vote, both labels together.
SAMPLE = 4096
RANK = 64
NEIGHBOURS = 25
#: Documents per block of cosines: 1024 x SAMPLE numbers.
BLOCK = 1024
ACCEPT = 0.7


def latent_space(rows: np.ndarray, rank: int, steps: int = 6) -> np.ndarray:
    """The leading right singular vectors (features x rank), by subspace iteration.

    Beside the rows only matrices of ``rank`` + 16 columns are held.
    """
    width = min(rank + 16, *rows.shape)
    basis = np.random.RandomState(0).standard_normal((rows.shape[1], width)).astype(rows.dtype)
    for _ in range(steps):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    _, values, right = np.linalg.svd(rows @ basis, full_matrices=False)
    kept = values[:rank] > 1e-3 * max(values.max(initial=0), 1e-12)
    return basis @ right[:rank][kept].T


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit_voters(texts: DataFrame, labelled: DataFrame, id_col: str, text_col: str, label_col: str,
               bound: int = SAMPLE, rank: int = RANK) -> dict:
    """Model from training texts and labels (one row per id): idf of all texts, space and vectors of the sample.

    Only ids meet the labels in a join; texts are fetched for the sample alone.
    """
    n, held = document_frequencies(deal_out(texts), text_col, shape_counts, SHAPE_DIMS)
    idf = smooth_idf(n, held)
    here = labelled.join(texts.select(id_col).distinct(), id_col, "left_semi")
    ids = sample_ids(here, id_col, [label_col], bound)
    picked = deal_out(texts).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(ids), "id")
    rows = counted(picked, "text", ["id", label_col], shape_counts).orderBy("id").collect()[:bound]
    if not rows:
        return {"idf": idf, "space": np.zeros((SHAPE_DIMS, 0), np.float32), "voters": np.zeros((0, 0), np.float32),
                "labels": np.zeros(0)}
    vectors = weighted(unpack(rows, SHAPE_DIMS), idf)
    space = latent_space(vectors, rank).astype(np.float32)
    return {"idf": idf, "space": space, "voters": _unit(vectors @ space),
            "labels": np.array([float(r[label_col]) for r in rows])}


def vote(vectors: np.ndarray, model: dict, k: int) -> np.ndarray:
    """Similarity-weighted share of label 1 among the k nearest voters, exact, in blocks."""
    voters, labels = model["voters"], model["labels"]
    k, out = min(k, len(voters)), np.zeros(len(vectors))
    if not k:
        return out
    folded = _unit(vectors @ model["space"])
    for at in range(0, len(folded), BLOCK):
        cos = folded[at: at + BLOCK] @ voters.T
        near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cos, near, 1).astype(float), 1e-9) ** 4
        out[at: at + BLOCK] = (weight * labels[near]).sum(1) / weight.sum(1)
    return np.clip(out, 0, 1)


def score_quality(df: DataFrame, text_col: str, model: dict, keep: list[str], k: int = NEIGHBOURS) -> DataFrame:
    """The kept columns with score and predicted."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for first, end, data, at in pieces(batch.column(batch.num_columns - 1)):
                share = vote(weighted(shape_counts(data, at), m["idf"]), m, k)
                out = batch.slice(first, end - first).select(range(batch.num_columns - 1))
                out = out.append_column("score", pa.array(share))
                yield out.append_column("predicted", pa.array((share >= ACCEPT).astype(np.int32)))

    return df.select(*keep, F.col(text_col).alias("__text")).mapInArrow(
        score, ", ".join([*fields, "score double", "predicted int"]))


def quality_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document; labels are learned where crc32(doc_id) mod 4 is not 2."""
    docs = documents.select("doc_id", "text").withColumn("held_out", by_crc("doc_id", 4) == 2)
    told = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where(by_crc("doc_id", 4) != 2)
    model = fit_voters(docs.where(~F.col("held_out")), told, "doc_id", "text", "quality")
    return score_quality(deal_out(docs), "text", model, ["doc_id", "held_out"])
