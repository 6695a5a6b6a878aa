"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfwise")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local master may fall back to a folder of this machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows live in the shared folder, not on executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """The rows as a Parquet table in the shared folder, for inputs that are read several times.

    Unlike a recomputed plan the table is scanned by column, has a known size
    and survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_file(path: str) -> pq.ParquetFile:
    """A file of a stored table, as a task reads it."""
    where, name = fs.FileSystem.from_uri(path if ":" in path.split("/", 1)[0] else f"file://{path}")
    return pq.ParquetFile(where.open_input_file(name))
