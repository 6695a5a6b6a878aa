"""The serving plan by a sweep over changes, against the full grid."""

import random
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import counts
from shelfwise.operators.sweeps import best_spans, undominated


def as_rates(spark, data):
    df = spark.createDataFrame(data, "h long, item_id long, rate double")
    return df.select(F.timestamp_seconds(F.col("h") * 3600).alias("interval_start"), "item_id", "rate")


def six_digits(x):
    """Halves of the shortest decimal form go up, as in Spark's round."""
    return float(Decimal(repr(x)).quantize(Decimal("0.000001"), ROUND_HALF_UP))


def by_hand(data, top, visits):
    rates = {(h, i): r or 0.0 for h, i, r in data}
    items = sorted({i for _, i in rates})
    first, last = min(h for h, _ in rates), max(h for h, _ in rates)
    out = {(0, i, None, int(visits / len(items))) for i in items}
    sums = dict.fromkeys(items, 0.0)
    for h in range(first + 1, last + 1):
        for i in items:
            sums[i] += rates.get((h - 1, i), 0.0)
        means = sorted((-six_digits(sums[i] / (h - first)), i) for i in items)[:top]
        out |= {(h - first, i, -m, int(visits / top)) for m, i in means}
    return out


@pytest.mark.parametrize("group_rows,top", [(7, 3), (1 << 20, 1), (40, 5)])
def test_serving_plan_against_the_grid(spark, group_rows, top):
    """Ties, zero and null rates, idle intervals, items that come late, differences below rounding."""
    rng = random.Random(top)
    cells = {(rng.choice([0, 1, 2, 3, 7, 8, 20, 21, 22, 60]), rng.randrange(40)) for _ in range(160)} | {(0, 3)}
    data = [(h, i, rng.choice([0.0, None, 0.5, 0.5, 1.0, 0.500001, 0.500002, rng.random()])) for h, i in sorted(cells)]
    found = counts.serving_plan(as_rates(spark, data), 1, 200, top, group_rows)
    got = {(r.interval, r.item_id, r.mean_rate, r.planned) for r in found.collect()}
    assert got == by_hand(data, top, 200)


def test_empty_and_one_interval(spark):
    one = as_rates(spark, [(5, 1, 0.5), (5, 2, None)])
    assert {(r.interval, r.item_id, r.share) for r in counts.serving_plan(one, 1, 10).collect()} == {
        (0, 1, 0.5), (0, 2, 0.5)}
    assert counts.serving_plan(one.limit(0), 1, 10).count() == 0


def test_spans_are_in_proportion_to_the_rates(spark):
    """2,000 intervals, 300 items and 600 rates: a grid would have 600,000 rows."""
    rng = random.Random(1)
    cells = {(rng.randrange(2000), i): rng.random() for i in range(300) for _ in range(2)}
    df = spark.createDataFrame([(h, i, r) for (h, i), r in cells.items()], "slot long, item_id long, rate double")
    assert best_spans(df, 3, 100).count() <= 2 * len(cells) + 3 * 7


def test_undominated():
    ids, totals = np.array([5, 1, 9, 7, 3]), np.array([1.0, 1.0, 1.0, 2.0, 0.2])
    assert sorted(ids[undominated(ids, totals, 1, 0.1)]) == [7]
    assert sorted(ids[undominated(ids, totals, 2, 0.1)]) == [1, 5, 7]
    assert sorted(ids[undominated(ids, totals, 2, 1.0)]) == [1, 3, 5, 7]
