"""Language-model scores: interpolated modified Kneser-Ney over bigrams.

Tasks count hashed bigrams, shards by the leading bits of the context's hash
merge the counts, and each shard writes sorted arrays into the shared folder:
bigram keys with counts and contexts with totals in one file, words with
continuation types in another. Workers map these files into memory, without
keeping them open, and look up whole batches by binary search.
Discounts are a few sums over the shards, so nothing but sums reaches the
driver. Model and work grow with the corpus and so does the number of shards.

Tokens are the words of the text with A-Z lower-cased, then one end token; the
first token follows a start mark that is never counted as a token. An unknown
word has the uniform share of the lowest order.

Defined results: a null or empty text is the end token alone; without training
text every token has probability 1 (one unknown word). Repeated rows count as
often as they occur.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.shared import by_crc, deal_out, emit, local_copy, put_file, scratch_path, stored
from shelfwise.llm.texts import U, hashed_words, mix, pieces

START, END = U(0x243F6A8885A308D3), U(0x13198A2E03707344)
#: Tokens that a task holds before it passes its counts on, and bytes of text per shard.
HELD = 2 << 20
SHARD_BYTES = 8 << 20
LEAST_SHARDS = 64
BIG = 255
#: The arrays of a shard's two files: one by its contexts, one by its words.
FILES = {"context": {"bigram": U, "count": np.uint8, "big_at": np.int64, "big": np.int64, "context": U,
                     "total": np.int64, "n1": np.uint32, "n2": np.uint32, "n3": np.uint32},
         "word": {"word": U, "types": np.int64, "tokens": np.int64}}

COUNTS = pa.schema([("shard", pa.int32()), ("context", pa.binary()), ("run", pa.binary()),
                    ("word", pa.binary()), ("n", pa.binary())])
WORDS = pa.schema([("shard", pa.int32()), ("word", pa.binary()), ("types", pa.binary()), ("tokens", pa.binary()),
                   *[(f"b{i}", pa.int64()) for i in range(1, 5)]])
SUMS = pa.schema([("shard", pa.int32()), ("vocabulary", pa.int64()), ("tokens", pa.int64()), ("types", pa.int64()),
                  *[(f"u{i}", pa.int64()) for i in range(1, 5)], *[(f"b{i}", pa.int64()) for i in range(1, 5)]])


def ddl(schema: pa.Schema) -> str:
    kinds = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.float64(): "double"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def sequences(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, token before it, first token of each row) of all rows, each row ended by END."""
    words, rows = hashed_words(data, at)
    n = len(at) - 1
    size = np.bincount(rows, minlength=n) + 1
    first = np.cumsum(size) - size
    tokens = np.full(int(size.sum()), END, U)
    tokens[np.arange(len(words)) + rows] = words
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first] = START
    return tokens, before, first


def bigram_keys(before: np.ndarray, tokens: np.ndarray, bits: int) -> np.ndarray:
    """A 64-bit key that starts with the leading bits of the context, so that shards are key ranges."""
    low = mix(before * U(0x9E3779B97F4A7C15) + tokens)
    return (before >> U(64 - bits) << U(64 - bits)) | (low >> U(bits))


def _runs(*sorted_columns: np.ndarray) -> np.ndarray:
    """First rows of the runs of equal rows."""
    if not len(sorted_columns[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(sorted_columns[0]), bool)
    new[1:] = False
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _merged(context: np.ndarray, word: np.ndarray, n: np.ndarray):
    order = np.lexsort((word, context))
    context, word, n = context[order], word[order], n[order]
    first = _runs(context, word)
    return context[first], word[first], np.add.reduceat(n, first) if len(first) else n[:0]


def _packed_counts(context, word, n, bits: int) -> Iterator[pa.RecordBatch]:
    """One row per shard: the distinct contexts, how many words each has, the words and counts."""
    context, word, n = _merged(context, word, n)
    shard = (context >> U(64 - bits)).astype(np.int64)
    cuts = np.searchsorted(shard, np.arange((1 << bits) + 1))
    rows = {f.name: [] for f in COUNTS}
    for s in np.flatnonzero(np.diff(cuts)):
        c = context[cuts[s]: cuts[s + 1]]
        first = _runs(c)
        rows["shard"].append(int(s))
        rows["context"].append(c[first].tobytes())
        rows["run"].append(np.diff(np.append(first, len(c))).astype(np.uint32).tobytes())
        rows["word"].append(word[cuts[s]: cuts[s + 1]].tobytes())
        rows["n"].append(n[cuts[s]: cuts[s + 1]].astype(np.uint32).tobytes())
    yield emit(rows, COUNTS)


def _joined(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _put_arrays(path: str, kinds: dict[str, type], arrays: dict[str, np.ndarray]) -> None:
    """Arrays in one file: their lengths, then each from a multiple of 8 bytes on."""
    body = [np.ascontiguousarray(arrays[name], kind).tobytes() for name, kind in kinds.items()]
    sizes = np.array([len(arrays[name]) for name in kinds], np.int64).tobytes()
    put_file(path, iter([sizes, *[b + bytes(-len(b) % 8) for b in body]]))


def _count_of_counts(n: np.ndarray) -> list[int]:
    return [int((n == i).sum()) for i in range(1, 5)]


def count_bigrams(texts: DataFrame, bits: int) -> DataFrame:
    """Packed bigram counts of one text column, by shard."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            word, context = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            held.clear()
            return _packed_counts(context, word, np.ones(len(word), np.int64), bits)

        for batch in batches:
            for _, _, data, at in pieces(batch.column(0)):
                tokens, before, _ = sequences(data, at)
                held.append((tokens, before))
                size += len(tokens)
                if size >= HELD:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    return texts.mapInArrow(count, ddl(COUNTS))


def train(texts: DataFrame, text_col: str, folder: str) -> dict:
    """Count, smooth and store the model of all texts below ``folder``; returns its few sums."""
    texts = deal_out(texts.select(text_col))
    size = texts.agg(F.sum(F.octet_length(text_col)).alias("b")).first()["b"] or 0
    bits = (max(LEAST_SHARDS, -(-size // SHARD_BYTES)) - 1).bit_length()

    def merge_contexts(key, table):
        """Merge a shard's counts, store its bigrams and contexts, pass its words on."""
        shard = key[0].as_py()
        context = np.repeat(_joined(table["context"], U), _joined(table["run"], np.uint32))
        context, word, n = _merged(context, _joined(table["word"], U), _joined(table["n"], np.uint32).astype(np.int64))
        keys = bigram_keys(context, word, bits)
        order = np.argsort(keys)
        ranked = n[order]
        big = np.flatnonzero(ranked >= BIG)
        first = _runs(context)
        sums = [np.add.reduceat(x, first) for x in (n, n == 1, n == 2, n >= 3)]
        _put_arrays(f"{folder}/context-{shard:06d}", FILES["context"], {
            "bigram": keys[order], "count": np.minimum(ranked, BIG), "big_at": big, "big": ranked[big],
            "context": context[first], "total": sums[0], **{f"n{i}": sums[i] for i in (1, 2, 3)}})
        order = np.argsort(word, kind="stable")
        first = _runs(word[order])
        words, tokens = word[order][first], np.add.reduceat(n[order], first)
        types = np.diff(np.append(first, len(word)))
        to = (words >> U(64 - bits)).astype(np.int64)
        cuts = np.searchsorted(to, np.arange((1 << bits) + 1))
        some = np.flatnonzero(np.diff(cuts))
        part = lambda x, kind: [x[cuts[s]: cuts[s + 1]].astype(kind).tobytes() for s in some]
        counts = _count_of_counts(n)
        rows = {"shard": some, "word": part(words, U), "types": part(types, np.uint32), "tokens": part(tokens, np.int64)}
        rows |= {f"b{i + 1}": [counts[i]] + [0] * (len(some) - 1) for i in range(4)}
        return pa.Table.from_batches([emit(rows, WORDS)])

    def merge_words(key, table):
        """Add up a shard's words, store them, return the sums the discounts need."""
        shard = key[0].as_py()
        word, types, tokens = (_joined(table[c], k) for c, k in (("word", U), ("types", np.uint32), ("tokens", np.int64)))
        order = np.argsort(word, kind="stable")
        first = _runs(word[order])
        types = np.add.reduceat(types[order].astype(np.int64), first)
        tokens = np.add.reduceat(tokens[order], first)
        _put_arrays(f"{folder}/word-{shard:06d}", FILES["word"],
                    {"word": word[order][first], "types": types, "tokens": tokens})
        row = {"shard": [shard], "vocabulary": [len(first)], "tokens": [int(tokens.sum())], "types": [int(types.sum())]}
        row |= {f"u{i + 1}": [n] for i, n in enumerate(_count_of_counts(types))}
        row |= {f"b{i}": [int(np.sum(table[f"b{i}"].to_numpy()))] for i in range(1, 5)}
        return pa.Table.from_batches([emit(row, SUMS)])

    counted = count_bigrams(texts, bits)
    words = counted.groupBy("shard").applyInArrow(merge_contexts, ddl(WORDS))
    sums = stored(words.groupBy("shard").applyInArrow(merge_words, ddl(SUMS)), "model-sums")
    total = sums.agg(*[F.coalesce(F.sum(f.name), F.lit(0)).alias(f.name) for f in SUMS if f.name != "shard"]).first()
    return total.asDict() | {"folder": folder, "bits": bits}


def discounts(counts: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more, from the counts of counts."""
    n1, n2, n3, n4 = counts
    if not n1 or not n2:
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    raw = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.clip(raw, 0.0, [0, 1, 2, 3])


_maps: dict[str, dict[str, np.ndarray]] = {}


def _mapped(path: str, kinds: dict[str, type]) -> dict[str, np.ndarray]:
    """The arrays of a file of the model, mapped once per worker.

    The file is closed again, as a worker needs as many as there are shards; a copy's name goes at once. Its
    pages stay mapped.
    """
    if path not in _maps:
        name, copied = local_copy(path)
        with pa.memory_map(name) as source:
            data = source.read_buffer()
        if copied:
            os.unlink(name)
        arrays, at = {}, 8 * len(kinds)
        for (column, kind), n in zip(kinds.items(), np.frombuffer(data, np.int64, len(kinds))):
            arrays[column] = np.frombuffer(data, kind, n, at)
            at += -(-arrays[column].nbytes // 8) * 8
        _maps[path] = arrays
    return _maps[path]


def _found(folder: str, file: str, name: str, keys: np.ndarray, bits: int, columns: list[str], shards: set[int]) -> dict:
    """Look sorted keys up in the sorted arrays of their shards; 0 where a key is absent."""
    out = {c: np.zeros(len(keys), np.int64) for c in columns}
    cuts = np.searchsorted(keys >> U(64 - bits), np.arange((1 << bits) + 1).astype(U))
    for s in np.flatnonzero(np.diff(cuts)):
        if int(s) not in shards:
            continue
        arrays = _mapped(f"{folder}/{file}-{s:06d}", FILES[file])
        have, own = arrays[name], keys[cuts[s]: cuts[s + 1]]
        at = np.searchsorted(have, own)
        at[at == len(have)] = 0
        hit = have[at] == own
        for c in columns:
            values = arrays[c][at].astype(np.int64)
            if c == "count" and (values[hit] == BIG).any():
                big = np.flatnonzero(hit & (values == BIG))
                values[big] = arrays["big"][np.searchsorted(arrays["big_at"], at[big])]
            out[c][cuts[s]: cuts[s + 1]] = np.where(hit, values, 0)
    return out


def token_logs(tokens: np.ndarray, before: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(count in training, log10 probability) of each token."""
    folder, bits, shards = model["folder"], model["bits"], set(model["shards"])
    v, total_types = model["vocabulary"], max(model["types"], 1)
    low, high = (discounts([model[f"{k}{i}"] for i in range(1, 5)]) for k in "ub")

    word, of = np.unique(tokens, return_inverse=True)
    w = _found(folder, "word", "word", word, bits, ["types", "tokens"], shards)
    spread = (low[1] * model["u1"] + low[2] * model["u2"] + low[3] * (v - model["u1"] - model["u2"])) / total_types
    if not v:
        spread = 1.0
    p_low = np.maximum(w["types"] - low[np.minimum(w["types"], 3)], 0) / total_types + spread / (v + 1)

    context, ctx = np.unique(before, return_inverse=True)
    c = _found(folder, "context", "context", context, bits, ["total", "n1", "n2", "n3"], set(model["context_shards"]))
    seen = c["total"] > 0
    back = np.where(seen, (high[1] * c["n1"] + high[2] * c["n2"] + high[3] * c["n3"]) / np.maximum(c["total"], 1), 1.0)

    keys, pair = np.unique(bigram_keys(before, tokens, bits), return_inverse=True)
    n = _found(folder, "context", "bigram", keys, bits, ["count"], set(model["context_shards"]))["count"][pair]
    p = np.maximum(n - high[np.minimum(n, 3)], 0) / np.maximum(c["total"], 1)[ctx] + back[ctx] * p_low[of]
    return w["tokens"][of], np.log10(p)


def score_texts(df: DataFrame, text_col: str, model: dict, keep: list[str]) -> DataFrame:
    """The kept columns with n_tokens, n_known, base_score, score and perplexity."""
    schema = df.select(*keep).schema
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = np.log10(model["tokens"] + model["vocabulary"] + 1)
        for batch in batches:
            for first, end, data, at in pieces(batch.column(batch.num_columns - 1)):
                tokens, before, starts = sequences(data, at)
                count, logs = token_logs(tokens, before, model)
                n = np.diff(np.append(starts, len(tokens)))
                out = batch.slice(first, end - first).select(range(batch.num_columns - 1))
                total = np.add.reduceat(logs, starts)
                for name, values in (
                        ("n_tokens", n), ("n_known", np.add.reduceat((count > 0).astype(np.int64), starts)),
                        ("base_score", np.add.reduceat(np.log10(count + 1.0) - scale, starts)),
                        ("score", total), ("perplexity", 10 ** np.minimum(-total / n, 300))):
                    out = out.append_column(name, pa.array(values))
                yield out

    return df.select(*keep, F.col(text_col).alias("__text")).mapInArrow(
        score, ", ".join([*fields, "n_tokens long, n_known long, base_score double, score double, perplexity double"]))


def build_model(texts: DataFrame, text_col: str) -> dict:
    """Train into a fresh folder of the shared folder."""
    folder = scratch_path(texts.sparkSession, "kneser-ney")
    model = train(texts, text_col, folder)
    return model | _shards(folder)


def _shards(folder: str) -> dict:
    """Which shards exist."""
    from pyarrow import fs

    from shelfwise.llm.shared import open_fs

    where, name = open_fs(folder)
    files = [f.base_name for f in where.get_file_info(fs.FileSelector(name, allow_not_found=True))]
    return {"shards": [int(f[5:]) for f in files if f.startswith("word-") and f[5:].isdigit()],
            "context_shards": [int(f[8:]) for f in files if f.startswith("context-") and f[8:].isdigit()]}


def lm_report(documents: DataFrame) -> DataFrame:
    """Scores of all documents by a model of those with crc32(doc_id) mod 7 other than 2."""
    docs = documents.select("doc_id", "text").withColumn("held_out", by_crc("doc_id", 7) == 2)
    # A null text is an empty one; the size of the input decides on the shards.
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    model = build_model(docs.where(~F.col("held_out")), "text")
    return score_texts(deal_out(docs), "text", model, ["doc_id", "held_out"]).withColumn(
        "train_tokens", F.lit(model["tokens"]).cast("long"))
