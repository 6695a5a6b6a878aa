"""A clustered index that takes changes: base cells, fresh rows, removals, compaction.

Three tables below one folder of the shared file system:

* ``base/version=V/cell=C``: vectors by cell. A compaction writes the cells it
  touches under the next version and leaves all others where they are.
* ``changes/batch_id=B``: new vectors of a batch; a null vector removes the item.
* ``states/version=V``: where each cell's current rows are, and the last batch
  they hold. Writing this one small file is what makes a compaction take effect,
  so a compaction that dies before is simply run again, and a search that began
  before keeps reading the cells it began with.

A row of the changes hides every base row of its id. One compaction runs at a
time; batches may arrive meanwhile. Folders of earlier versions are left to the
owner of the path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import vectors as V
from shelfwise.operators.vector_index import build_flat, ivf_search, nearest_cells, nearest_code
from shelfwise.session import stored

ROWS = "item_id bigint, embedding array<double>"
# The cell of vectors that have none; no query probes it.
NO_CELL = -1


def _write_cells(rows: DataFrame, path: str, version: int) -> None:
    """A large cell is written by several tasks, small ones share a task."""
    cell = F.coalesce("cell", F.lit(NO_CELL)).cast("bigint").alias("cell")
    placed = rows.select(F.col("item_id").cast("bigint").alias("item_id"), "embedding", cell)
    placed.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(
        f"{path}/base/version={version}"
    )


def _all_base(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{ROWS}, version bigint, cell bigint").parquet(f"{path}/base")


def _write_state(spark: SparkSession, path: str, version: int, applied: int, kept: DataFrame | None) -> None:
    """One row per filled cell, and one without a cell for the last batch applied."""
    filled = _all_base(spark, path).where(F.col("version") == version).select("cell").distinct()
    rows = filled.select("cell", F.lit(version).cast("bigint").alias("home"))
    if kept is not None:
        rows = rows.unionByName(kept)
    mark = spark.createDataFrame([(None, None)], "cell bigint, home bigint")
    rows.unionByName(mark).withColumn("applied", F.lit(applied).cast("bigint")).coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/states/version={version}")


def _state(spark: SparkSession, path: str) -> tuple[int, int, DataFrame]:
    """(version, last batch applied, homes (cell, home)) of the newest state."""
    states = spark.read.schema("cell bigint, home bigint, applied bigint, version bigint").parquet(
        f"{path}/states")
    newest = states.groupBy("version").agg(F.max("applied").alias("applied")).orderBy(F.desc("version")).first()
    homes = states.where((F.col("version") == newest["version"]) & F.col("home").isNotNull())
    return newest["version"], newest["applied"], homes.select("cell", "home")


def _base(spark: SparkSession, path: str, homes: DataFrame) -> DataFrame:
    """Current base rows; ``version`` and ``cell`` are folders, so dead ones are not read."""
    place = homes.select("cell", F.col("home").alias("version"))
    return _all_base(spark, path).join(place, ["version", "cell"], "left_semi").select(
        "item_id", "cell", "embedding")


def _fresh(spark: SparkSession, path: str, applied: int, upto: int | None = None) -> DataFrame:
    """The newest change of every id behind the state; removals have a null vector."""
    changes = spark.read.schema(f"{ROWS}, cell bigint, batch_id bigint").parquet(f"{path}/changes").where(
        F.col("batch_id") > applied)
    if upto is not None:
        changes = changes.where(F.col("batch_id") <= upto)
    newest = changes.groupBy("item_id").agg(F.max(F.struct("batch_id", "cell", "embedding")).alias("_c"))
    return newest.select("item_id", "_c.cell", "_c.embedding")


def create_live(index: DataFrame, path: str) -> None:
    """Start a live index at ``path`` from the rows (item_id, cell, embedding) of ``ivf_build``."""
    spark = index.sparkSession
    _write_cells(index.where(F.col("item_id").isNotNull()), path, 0)
    spark.createDataFrame([], f"{ROWS}, cell bigint").write.mode("overwrite").parquet(
        f"{path}/changes/batch_id=-1")
    _write_state(spark, path, 0, -1, None)


def add_changes(changes: DataFrame, path: str, batch_id: int, centroids: DataFrame) -> None:
    """Write a batch of changes (item_id, embedding); a null vector removes the item.

    Later batches win. Of several rows of one id in a batch the largest vector
    stays, and a vector before a removal. Rows without id are left out. A batch
    that is written again overwrites itself; one that a compaction already
    applied stays without effect, so ids of batches must grow.
    """
    one = changes.where(F.col("item_id").isNotNull()).groupBy("item_id").agg(
        F.max("embedding").alias("embedding"))
    present = nearest_code(build_flat(one.where(F.col("embedding").isNotNull())), centroids, "cell")
    gone = one.where(F.col("embedding").isNull()).select(
        "item_id", V.as_doubles("embedding").alias("embedding"), F.lit(None).cast("bigint").alias("cell"))
    rows = present.select("item_id", "embedding", F.coalesce("cell", F.lit(NO_CELL)).alias("cell"))
    rows.unionByName(gone).write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")


def remove_items(ids: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch that removes the items of ``ids`` (item_id)."""
    gone = ids.where(F.col("item_id").isNotNull()).select(
        "item_id", F.lit(None).cast("array<double>").alias("embedding"), F.lit(None).cast("bigint").alias("cell"))
    gone.distinct().write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")


def live_rows(spark: SparkSession, path: str, cells: DataFrame | None = None) -> DataFrame:
    """(item_id, cell, embedding) as they are now, of all cells or the given ones (cell)."""
    _, applied, homes = _state(spark, path)
    fresh = _fresh(spark, path, applied)
    if cells is not None:
        homes = homes.join(cells, "cell", "left_semi")
    # Any change of an id hides its base row, whatever cell the change is in.
    kept = _base(spark, path, homes).join(fresh.select("item_id"), "item_id", "left_anti")
    alive = fresh.where(F.col("embedding").isNotNull())
    if cells is not None:
        alive = alive.join(cells, "cell", "left_semi")
    return kept.unionByName(alive)


def search_live(path: str, centroids: DataFrame, queries: DataFrame, k: int, nprobe: int = 50) -> DataFrame:
    """Top-k by inner product inside the nprobe nearest cells, over base and changes together.

    Only the folders of probed cells are read. The answer is that of an index
    built anew from the current vectors with the same centroids.
    """
    spark = queries.sparkSession
    unit = queries.select("query_id", V.l2_normalize(V.as_doubles("embedding")).alias("embedding"))
    probed = stored(nearest_cells(unit, centroids, nprobe).select("cell").distinct(), "probed-cells")
    return ivf_search(live_rows(spark, path, probed), centroids, queries, k, nprobe)


def compact(spark: SparkSession, path: str) -> list[int]:
    """Fold the changes into the base; returns the cells that were written again.

    These are the cells that lose a row or gain one. Batches that arrive during
    the compaction stay changes.
    """
    version, applied, homes = _state(spark, path)
    behind = spark.read.schema(f"{ROWS}, cell bigint, batch_id bigint").parquet(f"{path}/changes")
    newest = behind.agg(F.max("batch_id")).first()[0]
    if newest is None or newest <= applied:
        return []
    fresh = stored(_fresh(spark, path, applied, newest), "fresh")
    base, ids = _base(spark, path, homes), fresh.select("item_id")
    losing = base.join(ids, "item_id", "left_semi").select("cell")
    alive = fresh.where(F.col("embedding").isNotNull())
    touched = stored(losing.union(alive.select("cell")).distinct(), "touched-cells")
    rest = _base(spark, path, homes.join(touched, "cell", "left_semi")).join(ids, "item_id", "left_anti")
    _write_cells(rest.unionByName(alive), path, version + 1)
    _write_state(spark, path, version + 1, newest, homes.join(touched, "cell", "left_anti"))
    return sorted(r["cell"] for r in touched.collect())
