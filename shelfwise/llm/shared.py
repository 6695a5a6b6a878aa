"""Small helpers shared by the operators: stored tables, files in the shared folder, batches."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import scratch_path, stored

__all__ = ["by_crc", "deal_out", "emit", "local_copy", "open_fs", "partitions_for", "put_file",
           "scratch_path", "stored"]


def by_crc(id_col: str, modulus: int):
    """crc32 of the id as text modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def partitions_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Partitions so that each holds about ``rows_each`` rows; at least the session's number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_each))


def deal_out(df: DataFrame) -> DataFrame:
    """Spread an input of few scan tasks over all cores; larger inputs stay as they are."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    files = len(df.inputFiles())
    return df.repartition(cores * 2) if files < cores // 2 else df


def emit(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, as tasks and driver see it."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def put_file(path: str, content) -> None:
    """Write a file whole or not at all: a repeated or lost task leaves no half file behind."""
    where, name = open_fs(path)
    where.create_dir(os.path.dirname(name), recursive=True)
    part = f"{name}.{os.getpid()}-{os.urandom(4).hex()}"
    with where.open_output_stream(part, compression=None) as out:
        if isinstance(content, Iterator):
            for block in content:
                out.write(block)
        else:
            out.write(content)
    where.move(part, name)


def local_copy(path: str) -> tuple[str, bool]:
    """A path that this machine can map into memory, and whether it is a copy to be unlinked.

    A mounted shared folder is mapped in place; files of another store are
    fetched once per worker.
    """
    where, name = open_fs(path)
    if isinstance(where, fs.LocalFileSystem):
        return name, False
    handle, copy = tempfile.mkstemp(prefix="model-")
    with where.open_input_stream(name, compression=None) as source, os.fdopen(handle, "wb") as out:
        while block := source.read(8 << 20):
            out.write(block)
    return copy, True
