"""Time parsing and formatting as Column expressions (all JVM-side)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c, fmt: str | None = None, on_bad: str = "fail") -> Column:
    """Text -> TIMESTAMP_NTZ with one format.

    ``on_bad="fail"`` raises on text that does not match (ANSI mode);
    ``on_bad="null"`` turns it into NULL. Values that already are timestamps
    pass through unchanged (re-coercion is idempotent).
    """
    c = _col(c)
    if fmt is None:
        parsed = c.cast("timestamp_ntz") if on_bad == "fail" else c.try_cast("timestamp_ntz")
        return parsed
    if on_bad == "fail":
        return F.to_timestamp_ntz(c, F.lit(fmt))
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


_SHAPE_TOKENS = [("yyyy", r"\d{4}"), ("MM", r"\d{2}"), ("dd", r"\d{2}"), ("HH", r"\d{2}"),
                 ("mm", r"\d{2}"), ("ss", r"\d{2}"), ("M", r"\d{1,2}"), ("d", r"\d{1,2}"), ("H", r"\d{1,2}")]


def format_shape(fmt: str) -> str | None:
    """A regex every text in ``fmt`` matches (None if the pattern has other
    letters). Used to skip parse attempts that cannot succeed: a failed
    parse costs an exception, a regex test does not."""
    out, i = "^", 0
    while i < len(fmt):
        if fmt[i] == "'":
            j = fmt.index("'", i + 1)
            out += re.escape(fmt[i + 1:j])
            i = j + 1
            continue
        for tok, rx in _SHAPE_TOKENS:
            if fmt.startswith(tok, i):
                out += rx
                i += len(tok)
                break
        else:
            if fmt[i].isalpha():
                return None
            out += re.escape(fmt[i])
            i += 1
    return out + "$"


def parse_mixed_timestamp(c, formats: Sequence[str] = tuple(fixed.MIXED_FORMATS)) -> Column:
    """Per-value mixed formats, day-first before month-first, bad -> NULL.

    The first format that parses wins, so ``01/04/2025`` is 1 April and
    ``04/13/2025`` falls back to month-first (13 April). A format is only
    tried on text of its shape.
    """
    c = _col(c)
    tries = []
    for f in formats:
        shape = format_shape(f)
        attempt = F.try_to_timestamp(c, F.lit(f))
        tries.append(attempt if shape is None else F.when(c.rlike(shape), attempt))
    return F.coalesce(*tries).cast("timestamp_ntz")


def scalar(df, value: Column) -> Column | None:
    """The one value of an aggregate as a literal of its own type; None if it is NULL.

    The value travels as text (microseconds for zoned timestamps), so neither the
    driver's nor the session's clock zone can shift it, and as a literal it
    reaches the scan's filters.
    """
    one = df.agg(value.alias("v"))
    kind = one.schema["v"].dataType.simpleString()
    if kind == "timestamp":
        v = one.select(F.unix_micros("v").alias("v")).first()["v"]
        return None if v is None else F.timestamp_micros(F.lit(v))
    v = one.select(F.col("v").cast("string").alias("v")).first()["v"]
    return None if v is None else F.lit(v).cast(kind)


def format_time(c, fmt: str = fixed.FMT_ISO) -> Column:
    return F.date_format(_col(c), fmt)


def shift_days(c, days: int) -> Column:
    """``ts - days`` as a day-time interval; keeps TIMESTAMP_NTZ."""
    return _col(c) - F.expr(f"INTERVAL {int(days)} DAYS")


def day_window(as_of, days: int = 1) -> tuple[Column, Column]:
    """``[as_of - days, as_of - days]`` as dates (yesterday by default).

    ``as_of`` is a date/str Column or literal, passed in so runs are repeatable.
    """
    d = F.to_date(F.lit(as_of)) if not isinstance(as_of, Column) else F.to_date(as_of)
    start = F.date_sub(d, days)
    return start, start


def hour_bucket(c) -> Column:
    """Truncate to the hour, staying TIMESTAMP_NTZ (session zone is UTC)."""
    return F.date_trunc("hour", _col(c)).cast("timestamp_ntz")
