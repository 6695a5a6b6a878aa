"""Exact top-k Jaccard between sets with a rising threshold instead of all sharing pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.ordering import rounded, top_k
from shelfwise.operators.spread import HOT_ROWS, spread_join
from shelfwise.session import stored

#: Similarities searched for one after the other; a set whose list is full at one level leaves.
#: They lie beside the usual fractions, so that a list ends above a level and not on it.
LEVELS = (0.74, 0.49, 0.24, 0.0)
#: Rounding may move a similarity by half a unit of the sixth digit.
SURE = 2e-6


def by_rarity(sets: DataFrame) -> DataFrame:
    """(tags, low, items, ordered, size): the tags of each set from the rarest to the most common."""
    each = sets.select("tags", F.explode("tags").alias("tag"))
    common = each.groupBy("tag").agg(F.count("*").alias("_n"))
    ordered = spread_join(each, common, "tag").groupBy("tags").agg(
        F.sort_array(F.collect_list(F.struct("_n", "tag")))["tag"].alias("ordered")
    )
    return sets.join(ordered, "tags").withColumn("size", F.size("ordered"))


def _prefix(level: float):
    """A set similar by ``level`` or more shares a tag with this many of the rarest tags."""
    return F.least(F.col("size"), F.col("size") - F.ceil(F.col("size") * level - 1e-9) + 1).cast("int")


def pairs_above(todo: DataFrame, sets: DataFrame, level: float, hot: int = HOT_ROWS) -> DataFrame:
    """(tags, other, low, items, similarity): pairs with a similarity of ``level`` or more, itself included.

    Prefixes of the rarest tags meet, lengths must fit, and a pair counts only at
    the first tag that both hold, so it comes out once without a distinct.
    """
    cut = F.slice("ordered", 1, _prefix(level))
    a = todo.select("tags", F.col("ordered").alias("_a"), "size", F.explode(cut).alias("tag"))
    b = sets.select(
        F.col("tags").alias("other"), "low", "items", F.col("ordered").alias("_b"),
        F.col("size").alias("_size"), F.explode(cut).alias("tag"),
    )
    shared = F.array_intersect("_a", "_b")
    met = spread_join(a, b, "tag", hot).where(
        (F.col("_size") >= F.col("size") * level - 1e-9) & (F.col("_size") * level <= F.col("size") + 1e-9)
        & (F.get(shared, F.lit(0)) == F.col("tag"))
    )
    n = F.size(shared)
    union = F.col("size") + F.col("_size") - n
    return met.where(n >= union * level - 1e-9).select(
        "tags", "other", "low", "items", rounded(n / union).alias("similarity")
    )


def nearest_sets(sets: DataFrame, k: int, hot: int = HOT_ROWS) -> DataFrame:
    """The sets that hold the k most similar items of every set: (tags, other, similarity).

    ``sets`` has distinct sorted arrays ``tags`` (not empty, without nulls),
    ``low`` (the lowest item id) and ``items`` (how many items carry it). Each
    level looks only at sets whose list is not full yet; the last one takes
    every pair that shares a tag.
    """
    ordered = stored(by_rarity(sets), "sets-by-rarity")
    todo, lists = ordered, None
    for level in LEVELS:
        best = top_k(pairs_above(todo, ordered, level, hot), k, by="similarity", tie="low", per="tags")
        best = stored(best.drop("rank"), "nearest-sets")
        if level > 0:
            full = best.where(F.col("similarity") >= level + SURE).groupBy("tags").agg(
                F.sum(F.least("items", F.lit(k))).alias("_n")
            ).where(F.col("_n") >= k).select("tags")
            full = stored(full, "full-sets")
            best, todo = best.join(full, "tags", "left_semi"), stored(todo.join(full, "tags", "left_anti"), "open-sets")
        lists = best if lists is None else lists.unionByName(best)
        if level > 0 and todo.isEmpty():
            break
    return lists.select("tags", "other", "similarity")
