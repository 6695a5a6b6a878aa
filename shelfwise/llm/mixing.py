"""Mixing by soft membership: rates per document whose expected domain totals match target weights.

A classifier learned from a labelled table gives every document posteriors over
the domains. The rates solve a nonnegative least-squares problem, one variable
per document: the expected tokens of each domain (rate x tokens x posterior)
shall be its target. It is solved by distributed projected gradients: from the
rate 1, a step takes a multiple of the gradient (posterior times the domains'
misses) from every rate and projects it on 0 to the bound. Each pass tries
several steps at once, of spectral and fixed lengths and with the misses scaled
by the curvature of the rates that are not at a bound, and takes the one that
comes nearest to the targets; it ends when every total is within ``CLOSE`` of
its target, or no step comes nearer. A step is one number per domain, so a
task replays the steps taken so far on its rows; nothing per document is
stored between them, and a lost task repeats them.

Defined results: a null or empty text has no tokens and the classifier's view
of an empty text; a domain without target has target 0; an unreachable target
leaves the nearest mix and a warning; equal rows have equal rates, and rows that
occur more than once draw their copies one by one; without labels every
rate is 1. Of repeated labels of a document the lowest counts, of the texts of a
repeated id the one with the lowest hash is learned from.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.features import (
    LETTER, SHAPE_DIMS, document_frequencies, sample_ids, shape_counts, smooth_idf, weighted,
)
from shelfwise.llm.shared import deal_out, stored
from shelfwise.llm.texts import LOWER, U, hashed_words, pieces, word_bounds

#: Labelled documents the classifier is fitted on, all domains together.
SAMPLE = 3072
FIT_STEPS = 600
#: Gradient steps after which a fit ends, with a warning where a target is not met.
STEPS = 100
#: Largest difference between a domain's total and its target, as a share of the target, at which the steps end.
CLOSE = 1e-4
#: A step must bring the distance down by this share, or the steps end.
GAIN = 1e-7
#: Lengths tried in a pass: of the plain gradient, over its largest curvature, and of the scaled ones.
LENGTHS, SCALED = (1.0, 4.0, 16.0, 64.0), (1.0, 0.5, 0.2)
#: Rounding error of a rate: one this near below a whole number is that number of copies.
NOISE = 1e-6
#: Hash buckets of words, the level at which one is told from chance (over all buckets), and the weight of its presence.
WORD_BITS = 15
LEVEL = 0.01
WORD_WEIGHT = 3
#: Size of a fitting step and the pull of the classifier's weights towards 0.
FIT_RATE = 0.05
SHRINK = 1e-3


def word_buckets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct words of each row, letters only."""
    words, of = hashed_words(LETTER[LOWER[data]], at)
    flat = np.unique((of.astype(np.int64) << WORD_BITS) | (words >> U(64 - WORD_BITS)).astype(np.int64))
    return flat >> WORD_BITS, flat & ((1 << WORD_BITS) - 1)


def held_buckets(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, buckets): the distinct words of each id's text, packed; of repeated ids the least counts."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in pieces(batch.column(1)):
                rows, bucket = word_buckets(data, at)
                ends = np.searchsorted(rows, np.arange(end - first + 1)) * 2
                packed = pa.Array.from_buffers(pa.large_binary(), end - first, [
                    None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(bucket.astype(np.uint16).tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), packed.cast(pa.binary())], names=["id", "buckets"])

    kind = texts.schema[id_col].dataType.simpleString()
    rows = texts.where(F.col(id_col).isNotNull()).select(id_col, text_col)
    return rows.mapInArrow(build, f"id {kind}, buckets binary").groupBy("id").agg(F.min("buckets").alias("buckets"))


def told_words(texts: DataFrame, here: DataFrame, id_col: str, text_col: str, domains: list) -> np.ndarray:
    """The buckets whose presence in the labelled texts depends on the domain (chi-squared, at ``LEVEL``).

    All labelled rows count; packed words, not texts, meet the labels.
    """
    k, size = len(domains), 1 << WORD_BITS
    number = {d: i for i, d in enumerate(domains)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            label = np.array([number[d] for d in batch.column(1).to_pylist()], np.int64)
            packed = [np.frombuffer(b, np.uint16) for b in batch.column(0).to_pylist()]
            flat = np.repeat(label, [len(b) for b in packed]) * size + np.concatenate(packed)
            # The last place of a domain counts its rows.
            where, n = np.unique(np.concatenate([flat, k * size + label]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(n)], names=["at", "n"])

    told = held_buckets(texts, id_col, text_col).join(
        here.select(F.col(id_col).alias("id"), "domain").where(F.col("domain").isin(domains)), "id")
    sums = told.select("buckets", "domain").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    held = np.zeros(k * size + k)
    sums = sums.toArrow()  # one row per domain and bucket at most
    held[sums["at"].to_numpy()] = sums["n"].to_numpy()
    shares, held = held[k * size:], held[:k * size].reshape(k, size)
    expected = shares[:, None] * held.sum(0) / max(shares.sum(), 1)
    absent = shares[:, None] - expected
    chi = ((held - expected) ** 2 * (1 / np.maximum(expected, 1e-9) + 1 / np.maximum(absent, 1e-9))).sum(0)
    # The quantile of chi-squared by Wilson and Hilferty.
    spread = 2 / (9 * max(k - 1, 1))
    least = max(k - 1, 1) * (1 - spread + NormalDist().inv_cdf(1 - LEVEL / size) * np.sqrt(spread)) ** 3
    return np.flatnonzero((held.sum(0) > 0) & (chi > least))


def sampled_features(picked: DataFrame, chosen: np.ndarray, idf: np.ndarray) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Labels of the sampled texts, their shapes as weights, and rows and places of the chosen words they hold."""
    place = np.full(1 << WORD_BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in pieces(batch.column(2)):
                shapes = np.minimum(shape_counts(data, at), 65535).astype(np.uint16)
                rows, bucket = word_buckets(data, at)
                rows, bucket = rows[place[bucket] >= 0], place[bucket[place[bucket] >= 0]]
                ends = np.searchsorted(rows, np.arange(end - first + 1))
                out = batch.slice(first, end - first).select([0, 1])
                out = out.append_column("shapes", pa.array([x.tobytes() for x in shapes], pa.binary()))
                yield out.append_column("words", pa.array([bucket[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.select("id", "domain").schema]
    # At most ``bound`` rows: an array of shapes each, and the few words that were chosen.
    held = picked.select("id", "domain", "text").mapInArrow(count, ", ".join([*fields, "shapes binary", "words binary"])).toArrow()
    held = held.sort_by("id")
    rows = np.zeros((held.num_rows, SHAPE_DIMS), np.float32)
    words = []
    at = 0
    for batch in held.to_batches(max_chunksize=256):
        counts = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(batch.num_rows, SHAPE_DIMS)
        rows[at:at + batch.num_rows] = weighted(counts, idf)
        words += [np.frombuffer(w, np.int32) for w in batch.column(3).to_pylist()]
        at += batch.num_rows
    of = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return held["domain"].to_pylist(), rows, of, np.concatenate([*words, np.zeros(0, np.int32)]).astype(np.int64)


def scores(data: np.ndarray, at: np.ndarray, m: dict) -> np.ndarray:
    """What the model says of each text, before softmax; words are added one by one, without a column each."""
    w = m["weights"]
    out = (weighted(shape_counts(data, at), m["idf"]) @ w[:SHAPE_DIMS] + w[-1] + m["shift"]).astype(float)
    place = np.full(1 << WORD_BITS, -1)
    place[m["chosen"]] = np.arange(len(m["chosen"]))
    rows, bucket = word_buckets(data, at)
    rows, bucket = rows[place[bucket] >= 0], place[bucket[place[bucket] >= 0]]
    for c in range(out.shape[1]):
        out[:, c] += np.bincount(rows, WORD_WEIGHT * w[SHAPE_DIMS + bucket, c], minlength=len(out))
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_softmax(rows: np.ndarray, label: np.ndarray, k: int, steps: int = FIT_STEPS, rate: float = FIT_RATE,
                shrink: float = SHRINK, of: np.ndarray | None = None, word: np.ndarray | None = None, n_words: int = 0) -> np.ndarray:
    """Weights (features + words + 1 x classes) of a softmax regression, by gradient steps with momentum.

    ``of`` and ``word`` are the rows and numbers of the words that rows hold;
    words and the constant have no columns, so memory is that of ``rows``.
    """
    none = np.zeros(0, np.int64)
    of, word = (none, none) if of is None else (of, word)
    n, dims = rows.shape

    def forward(w: np.ndarray) -> np.ndarray:
        out = rows @ w[:dims] + w[-1]
        for c in range(w.shape[1]):
            out[:, c] += np.bincount(of, WORD_WEIGHT * w[dims + word, c], minlength=n)
        return out

    def back(error: np.ndarray) -> np.ndarray:
        out = np.zeros((dims + n_words + 1, error.shape[1]), np.float32)
        out[:dims] = rows.T @ error
        for c in range(error.shape[1]):
            out[dims:-1, c] = np.bincount(word, WORD_WEIGHT * error[of, c], minlength=n_words)
        out[-1] = error.sum(0)
        return out

    truth = np.eye(k, dtype=np.float32)[label]
    # Half the largest eigenvalue of the mean outer product bounds the curvature; a step beyond 1 / it can diverge.
    along = np.ones((dims + n_words + 1, 1), np.float32)
    for _ in range(20):
        along = back(forward(along / max(float(np.linalg.norm(along)), 1e-12)).astype(np.float32)) / max(n, 1)
    rate = min(rate, 2 / max(1.1 * float(np.linalg.norm(along)), 1e-9))
    w = np.zeros((dims + n_words + 1, k), np.float32)
    v = np.zeros_like(w)
    for _ in range(steps):
        ahead = w + np.float32(0.9) * v
        slope = back((softmax(forward(ahead)) - truth).astype(np.float32)) / np.float32(max(n, 1))
        v = np.float32(0.9) * v - np.float32(rate) * (slope + np.float32(shrink) * ahead)
        w = w + v
    return w


def fit_domains(texts: DataFrame, labelled: DataFrame, id_col: str, text_col: str, domain_col: str,
                bound: int = SAMPLE) -> dict:
    """The classifier: fitted on equal parts per domain, its posteriors corrected to the domains' shares.

    Document frequencies count all texts, shares all labels and word statistics
    all labelled texts; only ids and packed words meet the labels in a join,
    texts are fetched for the sample alone.
    """
    here = labelled.where(F.col(domain_col).isNotNull()).select(id_col, F.col(domain_col).alias("domain")).join(
        texts.select(id_col).distinct(), id_col, "left_semi")
    here = stored(here, "labelled-ids")
    shares = {r["domain"]: r["count"] for r in here.groupBy("domain").count().orderBy(
        F.desc("count"), "domain").limit(bound).collect()}
    domains = sorted(shares)
    if not domains:
        return {"domains": []}
    prior = np.array([shares[d] for d in domains], float)
    n, held = document_frequencies(deal_out(texts), text_col, shape_counts, SHAPE_DIMS)
    idf = smooth_idf(n, held)
    ids = sample_ids(here, id_col, ["domain"], bound)
    picked = deal_out(texts).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    # One text per id: of repeated ids that with the lowest hash. Tasks keep one each before the shuffle.
    picked = stored(picked.groupBy("id", "domain").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t")).select(
        "id", "domain", "t.text"), "labelled-texts")
    chosen = told_words(deal_out(texts), here, id_col, text_col, domains)
    named, rows, of, word = sampled_features(picked, chosen, idf)
    label = np.array([domains.index(d) for d in named], np.int64)
    weights = fit_softmax(rows, label, len(domains), of=of, word=word, n_words=len(chosen))
    fitted = np.bincount(label, minlength=len(domains)) / len(label)
    return {"domains": domains, "idf": idf, "chosen": chosen, "weights": weights,
            "shift": np.log(prior / prior.sum() / np.maximum(fitted, 1e-9))}


def posteriors(df: DataFrame, text_col: str, model: dict, keep: list[str]) -> DataFrame:
    """The kept columns with tokens and the posterior of each domain, in the model's order."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m["domains"])
        for batch in batches:
            for first, end, data, at in pieces(batch.column(batch.num_columns - 1)):
                p = np.zeros((end - first, 0))
                if k:
                    p = softmax(scores(data, at, m))
                tokens = np.bincount(word_bounds(data, at)[2], minlength=end - first)
                out = batch.slice(first, end - first).select(range(batch.num_columns - 1))
                out = out.append_column("tokens", pa.array(tokens.astype(np.int64)))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(p) + 1, dtype=np.int32) * k), pa.array(p.astype(float).ravel()))
                yield out.append_column("posterior", lists)

    return df.select(*keep, F.col(text_col).alias("__text")).mapInArrow(
        build, ", ".join([*fields, "tokens long", "posterior array<double>"]))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def rates_of(p: np.ndarray, steps: list, most: float) -> np.ndarray:
    """The rates of rows of posteriors after gradient steps, each projected on 0 to ``most``."""
    rate = np.full(len(p), min(1.0, most))
    for u in steps:
        rate = np.clip(rate - p @ np.asarray(u, float), 0.0, most)
    return rate


def totals(mix: DataFrame, steps: list, tried: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens per domain after each of the tried next steps, and the curvature of the rates inside their bounds."""
    m, k = tried.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, curve = np.zeros((m, k)), np.zeros((m, k, k))
        for batch in batches:
            if batch.num_rows:
                p, tokens = _matrix(batch.column(1)), batch.column(0).to_numpy().astype(float)
                base = rates_of(p, steps, most)
                for i in range(m):
                    rate = np.clip(base - p @ tried[i], 0.0, most)
                    held[i] += (rate * tokens) @ p
                    inner = (rate > 0) & (rate < most)
                    curve[i] += (p[inner] * tokens[inner][:, None]).T @ p[inner]
        x = np.concatenate([held.ravel(), curve.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), pa.array(x)], names=["d", "x"])

    out = np.zeros(m * k + m * k * k)
    for r in mix.select("tokens", "posterior").mapInArrow(add, "d long, x double").groupBy("d").agg(
            F.sum("x").alias("x")).collect():
        out[r["d"]] = r["x"]
    return out[:m * k].reshape(m, k), out[m * k:].reshape(m, k, k)


def solve(mix: DataFrame, domains: list[str], targets: dict[str, float], budget: float | None = None,
          anchor: str | None = None, steps: int = STEPS, most: float = np.inf) -> dict:
    """The gradient steps that fit the rates of (tokens, posterior) rows, 0 to ``most``, to the targets.

    ``budget`` is the total of expected tokens (the corpus' own by default);
    with ``anchor`` it is chosen so that this domain keeps its present total.
    Targets that no rates reach are named in a warning, with the nearest totals.
    """
    k = len(domains)
    if not k:
        return {"steps": [], "most": most}
    now, whole = totals(mix, [], np.zeros((1, k)), np.inf)
    now, whole, tokens = now[0], whole[0], now.sum()
    if not tokens > 0:
        return {"steps": [], "most": most}
    weight = np.array([max(float(targets.get(d, 0.0)), 0.0) for d in domains])
    weight = weight / weight.sum() if weight.sum() > 0 else np.full(k, 1 / k)
    if anchor in domains and weight[domains.index(anchor)] > 0:
        budget = now[domains.index(anchor)] / weight[domains.index(anchor)]
    goal = weight * (budget if budget is not None else tokens) / tokens
    near = CLOSE * np.where(goal > 0, goal, goal[goal > 0].min(initial=1.0))
    sums, curve = totals(mix, [], np.zeros((1, k)), most)
    at, free, whole = sums[0] / tokens, curve[0] / tokens, whole / tokens
    largest = float(np.linalg.eigvalsh(whole).max())
    taken, spectral = [], 1.0
    while len(taken) < steps and (np.abs(at - goal) > near / 4).any():
        miss = at - goal
        tried = [miss / largest * x for x in (spectral, *LENGTHS)]
        for matrix, ridge in ((free, 1e-6), (whole, 1e-6), (whole, 1e-2)):
            scaled = np.linalg.solve(matrix + ridge * largest * np.eye(k), miss)
            tried += [scaled * x for x in SCALED]
        sums, curve = totals(mix, taken, np.array(tried), most)
        distance = ((sums / tokens - goal) ** 2).sum(1)
        best = int(distance.argmin())
        if distance[best] >= (1 - GAIN) * (miss @ miss):
            break
        moved = sums[best] / tokens - at
        # The step that a quadratic with the change just seen would ask for (Barzilai and Borwein).
        step = tried[best]
        spectral = float(np.clip(step @ step / max(-(step @ moved), 1e-300) * largest, 0.1, 1e6))
        taken.append(step.tolist())
        at, free = sums[best] / tokens, curve[best] / tokens
    if (np.abs(at - goal) > near).any():
        off = ", ".join(f"{d} {x:.6f} for {g:.6f}" for d, x, g, n in zip(domains, at, goal, near) if abs(x - g) > n)
        warnings.warn(f"no rates reach the targets; nearest totals, as shares of the tokens: {off}", stacklevel=2)
    return {"steps": taken, "most": most}


def rated(mix: DataFrame, taken: dict, id_col: str) -> DataFrame:
    """Add rate and copies: the whole part of the rate and, by a draw, one more for the rest.

    The draw is a hash of the id and, if the rows have it, of ``text_hash``.
    Rows equal in both (these are counted) also take their place in the table,
    so that a group of equal rows keeps its expected share.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.schema.get_field_index("posterior")
            p = _matrix(batch.column(p)) if batch.num_rows and taken["steps"] else np.zeros((batch.num_rows, 0))
            yield batch.append_column("rate", pa.array(rates_of(p, taken["steps"], taken["most"])))

    same = F.xxhash64(F.col(id_col).cast("string"), *([F.col("text_hash")] if "text_hash" in mix.columns else []))
    keyed = mix.withColumn("same", same).withColumn("place", F.monotonically_increasing_id())
    often = keyed.groupBy("same").agg(F.count("*").alias("n")).where("n > 1").select("same", F.lit(True).alias("often"))
    keyed = keyed.join(often, "same", "left")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema]
    out = keyed.mapInArrow(build, ", ".join([*fields, "rate double"]))
    whole = F.floor(F.col("rate") + NOISE)
    rest = F.col("rate") - whole
    hashed = F.xxhash64(F.col("same"), F.when(F.col("often"), F.col("place")), F.lit("mix"))
    draw = F.pmod(hashed, F.lit(1 << 30)) / float(1 << 30)
    copies = (whole + F.when((rest > NOISE) & (draw < rest), 1).otherwise(0)).cast("int")
    return out.withColumn("copies", copies).drop("same", "place", "often")


def mixed(documents: DataFrame, labelled: DataFrame, targets: dict[str, float], anchor: str | None = None,
          id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain",
          most: float = np.inf) -> DataFrame:
    """(id, tokens, p_<domain>..., rate, copies) of every document.

    ``labelled`` has one row per id with its domain. No rate is above ``most``.
    """
    docs = documents.select(F.col(id_col), F.col(text_col))
    model = fit_domains(docs, labelled, id_col, text_col, domain_col)
    docs = docs.withColumn("text_hash", F.xxhash64(text_col))
    mix = stored(posteriors(deal_out(docs), text_col, model, [id_col, "text_hash"]), "posteriors")
    taken = solve(mix, model["domains"], targets, anchor=anchor, most=most)
    out = rated(mix, taken, id_col)
    return out.select(id_col, "tokens", *[F.get("posterior", F.lit(i)).alias(f"p_{d}")
                                          for i, d in enumerate(model["domains"])], "rate", "copies")


#: Domains of the labels table and their weights in the mix.
TARGETS = {"clean": 0.92, "poor": 0.05, "toxic": 0.03}


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labels table: toxic, else poor or clean by quality."""
    one = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    return one.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor")
                      .when(F.col("quality") == 1, "clean").alias("domain"))
