"""Repeatable pseudo-random draws in whole numbers, the same in Spark and in SQL text."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2147483647  # 2^31 - 1; squares stay below 2^63
FACTOR = 48271
CARRY = 69621
SHIFT = 12820163


def draw(seed: int | Column, *keys: Column | str) -> Column:
    """A number from 0 to PRIME - 1 for whole-number keys; two quadratic rounds per key.

    A draw of the first keys may be the seed for the rest of them.
    """
    x = F.lit(seed).cast("bigint")
    for key in keys:
        k = F.pmod((F.col(key) if isinstance(key, str) else key).cast("bigint"), F.lit(PRIME))
        x = F.pmod((k + 1) * FACTOR + x * CARRY, F.lit(PRIME))
        for _ in range(2):
            x = F.pmod(x * x + SHIFT, F.lit(PRIME))
    return x


def draw_sql(seed: int, *keys: str) -> str:
    """The same as SQL for keys that are not negative."""
    x = f"{seed}::BIGINT"
    for key in keys:
        x = f"(((({key})::BIGINT % {PRIME} + 1) * {FACTOR} + {x} * {CARRY}) % {PRIME})"
        for _ in range(2):
            x = f"(({x} * {x} + {SHIFT}) % {PRIME})"
    return x


def draw_of(seed: int, *keys: int) -> int:
    """The same for plain numbers."""
    x = seed
    for key in keys:
        x = ((key % PRIME + 1) * FACTOR + x * CARRY) % PRIME
        for _ in range(2):
            x = (x * x + SHIFT) % PRIME
    return x


def normal(seed: int, *keys: Column | str) -> Column:
    """A draw from the standard normal distribution for whole-number keys."""
    u, v = ((draw(seed + i, *keys) + 0.5) / F.lit(float(PRIME)) for i in (1, 2))
    return F.sqrt(-2 * F.log(u)) * F.cos(v * F.lit(2 * math.pi))


def normal_sql(seed: int, *keys: str) -> str:
    """The same as SQL."""
    u, v = (f"(({draw_sql(seed + i, *keys)} + 0.5e0) / {float(PRIME)!r}e0)" for i in (1, 2))
    return f"(sqrt(-2 * ln({u})) * cos({v} * {2 * math.pi!r}e0))"


def normal_of(seed: int, *keys: int) -> float:
    """The same for plain numbers."""
    u, v = ((draw_of(seed + i, *keys) + 0.5) / PRIME for i in (1, 2))
    return math.sqrt(-2 * math.log(u)) * math.cos(v * 2 * math.pi)
