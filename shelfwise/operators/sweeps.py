"""The k best running means per interval by a sweep over changes, without an item x interval grid."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from shelfwise.operators.ordering import SCORE_DIGITS

#: Changes that one group sweeps. Each group keeps its own best, so the candidates are
#: slots x k for every so many rates.
SWEEP_ROWS = 1 << 20


def undominated(ids: np.ndarray, totals: np.ndarray, k: int, margin: float) -> np.ndarray:
    """Places of items that can still be among the k best before their total changes.

    Totals never fall, so an item is out while k others have totals above its own
    by more than rounding can hide, or totals at least its own and lower ids.
    """
    if len(ids) > k:
        near = np.flatnonzero(totals >= np.partition(totals, -k)[-k] - margin)
    else:
        near = np.arange(len(ids))
    kept, best = [], []
    for at in near[np.argsort(ids[near], kind="stable")]:
        if len(best) < k:
            heapq.heappush(best, totals[at])
        elif best[0] < totals[at]:
            heapq.heapreplace(best, totals[at])
        else:
            continue
        kept.append(at)
    return np.array(kept, np.int64)


def _spans(changes: pd.DataFrame, k: int) -> Iterator[tuple]:
    """(id, total, since, until): how long each item of a group stays undominated with one total."""
    first, last = int(changes["_a"].iloc[0]), int(changes["_b"].iloc[0])
    margin = 2.0 * (last - first + 1) * 10.0**-SCORE_DIGITS
    changes = changes.sort_values("slot", kind="stable")
    everyone = np.sort(changes["item_id"].unique())[:k]
    held = {i: (0.0, first + 1) for i in everyone.tolist()}
    slots = changes["slot"].to_numpy()
    ids, totals = changes["item_id"].to_numpy(), changes["total"].to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
    for lo, hi in zip(starts, [*starts[1:], len(slots)]):
        now = int(slots[lo]) + 1
        if now > last:
            break
        merged = {**held, **{i: (t, now) for i, t in zip(ids[lo:hi].tolist(), totals[lo:hi].tolist())}}
        names = np.array(list(merged))
        kept = undominated(names, np.array([t for t, _ in merged.values()]), k, margin)
        after = {i: merged[i] for i in names[kept].tolist()}
        for i, (total, since) in held.items():
            if after.get(i) != (total, since) and since < now:
                yield i, total, since, now - 1
        held = after
    for i, (total, since) in held.items():
        if since <= last:
            yield i, total, since, last


def best_spans(rates: DataFrame, k: int, group_rows: int = SWEEP_ROWS) -> DataFrame:
    """(item_id, total, since, until, _a): spans of slots in which an item may be among the k best.

    ``rates`` has one row per (slot, item_id) with a ``rate`` of 0 or more. Items
    are dealt to groups by hash; a group of about ``group_rows`` rows is swept in
    the order of slots, and an item takes at most one row per slot of it. Spans are
    at most twice the rates and k per group.
    """
    running = Window.partitionBy("item_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    bounds = rates.agg(F.struct(F.min("slot").alias("_a"), F.max("slot").alias("_b"))).scalar()
    groups = rates.agg(F.greatest(F.ceil(F.count("*") / group_rows), F.lit(1))).scalar()
    changes = rates.select(
        "slot", "item_id", F.sum("rate").over(running).alias("total"),
        F.pmod(F.xxhash64("item_id"), groups).alias("_group"), bounds.alias("_s"),
    ).select("slot", "item_id", "total", "_group", "_s.*")
    schema = StructType([
        rates.schema["item_id"], StructField("total", DoubleType()), StructField("since", LongType()),
        StructField("until", LongType()), StructField("_a", LongType()),
    ])

    def sweep(group: pd.DataFrame) -> pd.DataFrame:
        rows = [(*span, int(group["_a"].iloc[0])) for span in _spans(group, k)]
        return pd.DataFrame(rows, columns=schema.names)

    return changes.groupBy("_group").applyInPandas(sweep, schema)
