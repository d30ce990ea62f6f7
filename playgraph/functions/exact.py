"""Sums and averages of doubles that do not depend on the order of the rows.

A double is cut, without rounding, into its whole part and three fractions of
32 bits.  The parts are summed as exact decimals, so any partitioning and any
retry gives the same bits.  Bits below 2 ** -96 are cut off (the same for every
order); values beyond 64 bits, nan and infinities are summed apart as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = 4294967296.0  # 2 ** 32
PARTS = 4
LARGEST = 9.2e18


def _parts(x: Column) -> list[Column]:
    """Whole part and three 32-bit fractions; each step is exact."""
    out, rest = [], x
    for i in range(PARTS):
        whole = rest.cast("bigint")
        out.append(whole)
        rest = (rest - whole.cast("double")) * F.lit(STEP)
    return out


def sum_parts(x: str | Column, prefix: str) -> list[Column]:
    """Aggregates ``<prefix>0`` to ``<prefix>3`` (exact), ``<prefix>_wide`` (doubles that do not fit) and ``<prefix>_n``.

    Decimal sums have fixed-width buffers and a map-side partial step; they can
    be added up again (``add_parts``), so they serve as running totals.
    """
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    fits = F.abs(x) < LARGEST  # false for nan and infinities, null for null
    parts = _parts(F.when(fits, x))
    sums = [F.sum(p.cast("decimal(20,0)")).alias(f"{prefix}{i}") for i, p in enumerate(parts)]
    return [*sums, F.sum(F.when(~fits, x)).alias(f"{prefix}_wide"), F.count(x).alias(f"{prefix}_n")]


def add_parts(prefix: str) -> list[Column]:
    """Totals of rows of totals."""
    return [F.sum(f"{prefix}{i}").cast("decimal(30,0)").alias(f"{prefix}{i}") for i in range(PARTS)] + [F.sum(f"{prefix}_wide").alias(f"{prefix}_wide"), F.sum(f"{prefix}_n").alias(f"{prefix}_n")]


def total_of(prefix: str) -> Column:
    """The sum as a double, from the totals; null without values.

    Carries move up first, so the whole part and each fraction are exact and
    rounding happens when they are put together.
    """
    step = F.lit(int(STEP)).cast("decimal(20,0)")
    parts, carry = [], F.lit(0).cast("decimal(38,0)")
    for i in range(PARTS - 1, -1, -1):
        whole = F.coalesce(F.col(f"{prefix}{i}"), F.lit(0)).cast("decimal(36,0)") + carry
        if i == 0:
            parts.append(whole.cast("double"))
            break
        carry = F.call_function("div", whole.cast("decimal(36,0)"), step).cast("decimal(30,0)")
        parts.append((whole % step).cast("double") / F.lit(STEP**i))
    low = parts[0]
    for p in parts[1:]:
        low = low + p
    return F.when(F.col(f"{prefix}_n") > 0, low + F.coalesce(f"{prefix}_wide", F.lit(0.0)))


def average_of(prefix: str) -> Column:
    return total_of(prefix) / F.when(F.col(f"{prefix}_n") > 0, F.col(f"{prefix}_n"))
