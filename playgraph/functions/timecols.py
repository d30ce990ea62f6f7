"""Time arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch of a wall-clock (NTZ) timestamp."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), _c(ts))
    return F.floor(micros / F.lit(1_000_000)).cast("bigint")


def age_seconds(now, ts) -> Column:
    """``now - ts`` in seconds (double, microsecond precision)."""
    return F.timestamp_diff("MICROSECOND", _c(ts), _c(now)) / F.lit(1_000_000.0)


def ntz_literal(value: str) -> Column:
    """A TIMESTAMP_NTZ literal from ``'YYYY-MM-DD HH:MM:SS'``."""
    return F.expr(f"TIMESTAMP_NTZ'{value}'")
