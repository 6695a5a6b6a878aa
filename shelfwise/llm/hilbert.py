"""Sharding along a Hilbert curve through several metadata dimensions.

Each dimension is quantised at its quantiles, the cell's index on the curve
orders the rows, and runs of equal length become shards: rows that are close in
all dimensions share files, so that minima and maxima of several columns prune
files at once. Order and position come from a range partitioning; no task holds
more than its range and the driver holds one count per range.

Defined results: a null dimension sorts below all values; ties on the curve are
ordered by ``ties``; rows equal in all of these are interchangeable; an empty
input has no rows. Input columns named shard or slot are replaced.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.shared import partitions_for, stored

BITS = 5
ROWS_EACH = 1 << 20


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer cells (rows x dimensions), by Gray code rotations."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & p
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = np.where(flip, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = index << 1 | (x[i] >> b & 1)
    return index


def _key(df: DataFrame, name: str) -> Column:
    """A number that sorts as the column does; of a string its first seven bytes."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        head = F.hex(F.substring(F.encode(F.col(name), "UTF-8"), 1, 7))
        return F.conv(F.rpad(head, 14, "0"), 16, 10).cast("double")
    return F.col(name).cast("double")


def hilbert_shards(df: DataFrame, dims: list[str], ties: list[str], n_shards: int = 8,
                   bits: int = BITS) -> DataFrame:
    """All rows with shard and slot: runs along the curve whose lengths differ by one at most."""
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    keys = [f"__key{i}" for i in range(len(dims))]
    keyed = df.select("*", *[_key(df, d).alias(k) for d, k in zip(dims, keys)])
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = keyed.select(*keys).agg(F.count("*").alias("n"), *[F.percentile_approx(k, cuts, 10_000).alias(k) for k in keys]).first()
    bounds = [np.unique(np.array(row[k] or [], float)) for k in keys]
    total = row["n"]

    @F.pandas_udf("long")
    def index(*columns: pd.Series) -> pd.Series:
        # A null is -inf: cell 0 unless nothing lies below the first bound.
        cells = [np.searchsorted(b, c.fillna(-np.inf).to_numpy(float), "right") for b, c in zip(bounds, columns)]
        return pd.Series(hilbert_index(np.stack(cells, 1), bits))

    parts = partitions_for(spark, total, ROWS_EACH)
    placed = stored(
        keyed.withColumn("__h", index(*keys)).drop(*keys)
        .repartitionByRange(parts, "__h", *ties).sortWithinPartitions("__h", *ties)
        .withColumn("__at", F.monotonically_increasing_id()), "hilbert-order")
    range_no = F.shiftright("__at", 33)
    counts = {r["p"]: r["n"] for r in placed.groupBy(range_no.alias("p")).agg(F.count("*").alias("n")).collect()}
    starts = dict(zip(sorted(counts), accumulate([0, *[counts[p] for p in sorted(counts)]])))
    offsets = F.broadcast(spark.createDataFrame(  # one row per range
        [(p, s) for p, s in starts.items()], "__p long, __start long"))
    position = F.col("__start") + (F.col("__at") - F.shiftleft(F.col("__p"), 33))
    shard = F.expr(f"cast(__pos * {n_shards} div {max(total, 1)} as int)")
    first = F.expr(f"(cast(shard as bigint) * {total} + {n_shards - 1}) div {n_shards}")
    return (
        placed.withColumn("__p", range_no).join(offsets, "__p").withColumn("__pos", position)
        .withColumn("shard", shard).withColumn("slot", F.col("__pos") - first)
        .drop("__p", "__start", "__at", "__pos", "__h"))


def write_shards(sharded: DataFrame, folder: str, n_shards: int = 8) -> None:
    """One folder per shard, rows in slot order."""
    (sharded.repartitionByRange(n_shards, "shard").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(folder))


def shard_report(documents: DataFrame) -> DataFrame:
    """Shard and slot of each document, with its size and checksum; law: rows."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    meta = documents.select(
        "doc_id", "lang", "source", (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"))
    return hilbert_shards(stored(meta, "hilbert-meta"), ["lang", "source", "size"], ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
