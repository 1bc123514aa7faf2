"""Numeric helpers as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL. Spark orders NaN above every number and aggregates keep it,
    while the pandas original treats it as missing; convert at ingest."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def log1p_zero(c) -> Column:
    """``log1p`` with 0 treated as missing and missing -> 0.

    0 -> 0, NULL -> 0, x <= -1 -> 0 (Spark's log1p gives NULL there).
    """
    return F.coalesce(F.log1p(F.nullif(_col(c), F.lit(0.0))), F.lit(0.0))


def relative_shift(recent, baseline) -> Column:
    """``abs((r - b) / b)``; 0 when b = 0; NULL when either side is NULL."""
    r, b = _col(recent), _col(baseline)
    return F.when(b == 0, F.lit(0.0)).otherwise(F.abs((r - b) / b))


def percent_rate(part, total) -> Column:
    """``part / total * 100``, 0 when total is 0."""
    return F.coalesce(F.try_divide(_col(part).cast("double"), _col(total)) * 100.0, F.lit(0.0))


def cyclic(c, period: int) -> tuple[Column, Column]:
    angle = _col(c).cast("double") * F.lit(2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def round_half_away(c, digits: int = 6) -> Column:
    """``round(x * 10^d) / 10^d`` with halves away from zero, in plain double
    arithmetic (codegen'd; ``F.round`` on doubles goes through BigDecimal and
    is several times slower). Same rule as C's ``round``."""
    c = _col(c)
    m = float(10 ** digits)
    return F.signum(c) * F.floor(F.abs(c) * m + 0.5) / m
