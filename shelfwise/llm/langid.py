"""Language identification by nearest centroids.

Texts are normalised TF-IDF vectors of letter n-grams. Document frequencies
count all training texts; the centroids (several per language, by spherical
k-means) are fitted on a bounded sample. A text goes to the language of the
centroid with the highest cosine; one that is far from all of them is rejected.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and rejected; without any training row everything is ``und``. A tie goes to the
first language in sort order. Repeated rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.features import (
    LETTER_DIMS, counted, document_frequencies, letter_counts, sample_ids, smooth_idf, unpack, weighted,
)
from shelfwise.llm.shared import by_crc, deal_out
from shelfwise.llm.texts import pieces

#: Training texts that the centroids are fitted on, all languages together.
SAMPLE = 2048
CENTROIDS = 4
STEPS = 12
#: Lowest cosine to a centroid that is accepted.
LEAST = 0.08


def spherical_kmeans(rows: np.ndarray, k: int, steps: int) -> np.ndarray:
    """At most k unit centroids; starts from rows spread by farthest-first order, no randomness."""
    chosen = [int(np.argmax(rows @ rows.mean(0)))]
    nearest = rows @ rows[chosen[0]]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, rows @ rows[chosen[-1]])
    centres = rows[chosen].copy()
    for _ in range(steps):
        owner = np.argmax(rows @ centres.T, axis=1)
        for c in range(len(centres)):
            if (owner == c).any():
                mean = rows[owner == c].mean(0)
                centres[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return centres


def fit_centroids(train: DataFrame, id_col: str, text_col: str, label_col: str,
                  bound: int = SAMPLE, k: int = CENTROIDS) -> dict:
    """The model: idf, centroids and the language of each centroid."""
    told = deal_out(train.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()))
    n, held = document_frequencies(told, text_col, letter_counts, LETTER_DIMS)
    idf = smooth_idf(n, held)
    ids = sample_ids(told, id_col, [label_col], bound)
    picked = told.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(ids), "id").dropDuplicates(["id"])
    rows = counted(picked, "text", ["id", label_col], letter_counts).orderBy("id").collect()  # at most ``bound``
    labels = [r[label_col] for r in rows]
    centres, langs = [], []
    if rows:
        vectors = weighted(unpack(rows, LETTER_DIMS), idf)
        for lang in sorted(set(labels)):
            own = vectors[[label == lang for label in labels]]
            found = spherical_kmeans(own, k, STEPS)
            centres.append(found)
            langs += [lang] * len(found)
    return {"idf": idf, "centres": np.concatenate(centres) if centres else np.zeros((0, LETTER_DIMS), np.float32),
            "langs": langs}


def identify(df: DataFrame, text_col: str, model: dict, keep: list[str], least: float = LEAST) -> DataFrame:
    """The kept columns with lang_pred, score (best cosine, 0 to 1) and rejected; these names replace kept ones."""
    keep = [c for c in keep if c not in ("lang_pred", "score", "rejected")]
    shared = df.sparkSession.sparkContext.broadcast(model)  # centroids per language times 4096 numbers
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        langs = np.array([*m["langs"], "und"], object)
        for batch in batches:
            letters = batch.column(len(keep)).to_numpy(zero_copy_only=False).astype(bool)
            for first, end, data, at in pieces(batch.column(batch.schema.get_field_index(text_col))):
                best, cos = np.full(end - first, len(langs) - 1), np.zeros(end - first)
                if len(m["langs"]):
                    close = weighted(letter_counts(data, at), m["idf"]) @ m["centres"].T.astype(np.float32)
                    best = np.argmax(close, 1)
                    cos = close[np.arange(len(best)), best].astype(float)
                some = letters[first:end] & (len(m["langs"]) > 0)
                best, cos = np.where(some, best, len(langs) - 1), np.where(some, np.clip(cos, 0, 1), 0.0)
                out = batch.slice(first, end - first).select(range(len(keep)))
                out = out.append_column("lang_pred", pa.array(langs[best], pa.string()))
                out = out.append_column("score", pa.array(cos))
                yield out.append_column("rejected", pa.array(~some | (cos < least)))

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("__letters")
    return df.select(*keep, letters, *([] if text_col in keep else [text_col])).mapInArrow(
        score, ", ".join([*fields, "lang_pred string", "score double", "rejected boolean"]))


def language_report(documents: DataFrame) -> DataFrame:
    """Predicted language of every document, learned from those with crc32(doc_id) mod 4 other than 2."""
    held_out = by_crc("doc_id", 4) == 2
    docs = documents.select("doc_id", "text", "lang").withColumn("held_out", held_out)
    model = fit_centroids(docs.where(~F.col("held_out")), "doc_id", "text", "lang")
    return identify(deal_out(docs), "text", model, ["doc_id", "held_out"])
