"""Top-k set joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import set_joins, similarity


def jaccard(a, b):
    return round(len(a & b) / len(a | b), 6) if a & b else 0.0


def by_hand(items, k):
    sets = {i: {t for t in tags or [] if t is not None} for i, tags in items}
    out = set()
    for i, a in sets.items():
        near = sorted((-jaccard(a, b), j) for j, b in sets.items() if j != i and jaccard(a, b) > 0)[:k]
        out |= {(i, rank + 1, j, -s) for rank, (s, j) in enumerate(near)}
    return out


@pytest.mark.parametrize("k,hot", [(1, 1), (4, 20)])
def test_similar_by_tags(spark, k, hot):
    """A tag in two thirds of the items, equal sets, nulls and empty sets."""
    rng = random.Random(k)
    items = [(i, rng.sample([f"t{j}" for j in range(14)], rng.randint(0, 6)) + (["hot"] if i % 3 else []))
             for i in range(150)]
    items += [(200, None), (201, []), (202, [None]), (203, ["t1", None, "t1"]), (204, ["alone"])]
    df = spark.createDataFrame(items, "item_id long, tags array<string>")
    got = {(r.item_id, r["rank"], r.other_id, r.similarity) for r in similarity.similar_by_tags(df, k, hot).collect()}
    assert got == by_hand(items, k)


def test_tag_lists_are_taken_without_a_ranking_per_item(spark):
    items = spark.range(40).select(F.col("id").alias("item_id"), F.array(F.lit("a")).alias("tags"))
    near = similarity.similar_by_tags(items, 3)
    steps = near._jdf.queryExecution().executedPlan().toString().splitlines()
    last = next(i for i, line in enumerate(steps) if "Join [tags" in line)
    assert "SortMergeJoin" in steps[last] and not any("Window" in line for line in steps[:last])
    assert near.count() == 120


def test_pairs_above_finds_every_pair_once(spark):
    rng = random.Random(3)
    tags = {tuple(sorted(rng.sample("abcdefghij", rng.randint(1, 7)))) for _ in range(80)}
    df = spark.createDataFrame([(list(t), i, 1) for i, t in enumerate(sorted(tags))],
                               "tags array<string>, low long, items long")
    ordered = set_joins.by_rarity(df).cache()
    for level in (0.5, 0.0):
        got = [(tuple(r.tags), tuple(r.other)) for r in set_joins.pairs_above(ordered, ordered, level).collect()]
        want = {(a, b) for a in tags for b in tags if set(a) & set(b)
                and len(set(a) & set(b)) >= level * len(set(a) | set(b))}
        assert len(got) == len(set(got)) and set(got) == want


def test_few_candidates_where_near_sets_exist(spark):
    """Families of near sets that share one common tag: the common tag alone never makes candidates."""
    rows = [([f"f{f}a", f"f{f}b", f"f{f}c", f"f{f}d", "hot", f"x{f}{i}"], f * 6 + i, 1)
            for f in range(100) for i in range(6)]
    df = spark.createDataFrame([(sorted(t), low, n) for t, low, n in rows],
                               "tags array<string>, low long, items long")
    ordered = set_joins.by_rarity(df)
    found = set_joins.pairs_above(ordered, ordered, 0.49)
    assert found.count() == 100 * 6 * 6
    near = set_joins.nearest_sets(df, 6)
    assert near.count() == 100 * 6 * 6 and near.where(F.col("similarity") < 0.7).count() == 0
