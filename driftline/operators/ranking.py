"""Row positions inside a (possibly huge, possibly skewed) ordered series.

``Window.partitionBy(keys).orderBy(t)`` puts a whole series into one task,
and with no keys at all into ONE partition for the whole table. The helpers
here give the same answer with work split by ordered ranges:

1. deal rows to ranges of ``(keys, order)`` (sampled splitters, so ranges hold
   about as many rows whatever the values are) and stage them; a task sorts and
   cuts many small ranges, so that tasks and files grow with the rows and not
   with the ranges;
2. count rows per ``(keys, range)`` and prefix-sum the counts per key -> first
   position of each range;
3. number rows inside ``(keys, range)`` and add the range's offset.

Step 3 is one shuffle on ``(keys, range)``; a hot key is spread over its
ranges, and a hot instant too if ``order`` has tie-break columns. The offset
of a range is fed into that same window as an extra marker row (a union, not
a join), so there is no second shuffle of the wide rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .sizing import tasks_for

BUCKET = "_dl_bucket"
POS = "_dl_pos"
_MARK = "_dl_mark"
_OFF = "_dl_off"


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def in_ranges(df: DataFrame, order: Sequence[str | Column], ranges: int, name: str,
              rows: int | None = None) -> DataFrame:
    """``df`` with the number of its range in ``BUCKET``: rows that come earlier in ``order`` have
    no larger number, equal rows the same one. Staged, so that every reader sees the same ranges.

    A range is a task. Given the number of ``rows``, more ranges than ``tasks_for`` them are cut by
    number inside sorted tasks; then equal rows may lie on both sides of a cut, and numbers have gaps.
    """
    ranges, by = max(1, int(ranges)), _order_cols(order)
    tasks = ranges if rows is None else min(ranges, tasks_for(df.sparkSession, rows))
    dealt = df.repartitionByRange(tasks, *by)
    if tasks == ranges:
        return materialize(dealt.withColumn(BUCKET, F.spark_partition_id()), name)
    # the id counts the rows of a task in its lower 33 bits; a range has the id of its first row
    placed = dealt.sortWithinPartitions(*by).withColumn(BUCKET, F.monotonically_increasing_id())
    size = max(1, math.ceil(rows / ranges))
    return materialize(placed.withColumn(BUCKET, F.expr(f"{BUCKET} - ({BUCKET} & {2 ** 33 - 1}L) % {size}")), name)


def add_position(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                 ranges: int = 32, pos_col: str = POS, rows: int | None = None) -> DataFrame:
    """Add ``pos_col``: 1-based row position within each key, in ``order``.

    Exactly ``row_number().over(partitionBy(keys).orderBy(order))`` (ties
    broken by the remaining ``order`` columns, which should make it unique),
    but never a single-partition or single-key task. ``order`` may be of any
    sortable type. ``rows``, if known, bounds the tasks (see ``in_ranges``).
    """
    keys = list(keys)
    b = in_ranges(df, [*[F.col(f"`{k}`") for k in keys], *order], ranges, "series-ranges", rows)
    counts = (b.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_n")))
    w_off = (Window.partitionBy(*keys) if keys else Window.partitionBy()) \
        .orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, BUCKET,
                            F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias(_OFF),
                            F.lit(True).alias(_MARK))
    rows = b.withColumn(_MARK, F.lit(False)).withColumn(_OFF, F.lit(None).cast("long"))
    u = rows.unionByName(offsets, allowMissingColumns=True)
    w = Window.partitionBy(*keys, BUCKET).orderBy(F.col(_MARK).desc(), *_order_cols(order))
    out = (u.withColumn(pos_col, F.row_number().over(w) - 1 +
                        F.first(_OFF, ignorenulls=True).over(w))
           .filter(~F.col(_MARK))
           .drop(_MARK, _OFF, BUCKET))
    return out


def lag_by_position(df: DataFrame, keys: Sequence[str], pos_col: str,
                    value_cols: Sequence[str], lags: Sequence[int],
                    name=lambda c, k: f"{c}_lag{k}") -> DataFrame:
    """``lag(c, k)`` for every value column and lag, by position.

    Each row is emitted once as itself (k = 0) and once per lag, narrowed to
    the value columns, at position ``pos + k`` (one ``explode`` in the same
    stage, so the input is computed once). One shuffle on ``(keys, pos)``
    brings each row together with its at most ``len(lags)`` predecessors:
    groups have ``1 + len(lags)`` rows whatever the key distribution.
    """
    keys = list(keys)
    kcol = "_dl_k"
    vals = {c: f"_dl_v_{i}" for i, c in enumerate(value_cols)}
    others = [c for c in df.columns if c not in keys and c != pos_col]
    k = F.col(kcol)
    fanned = df.select("*", F.explode(F.array(*[F.lit(int(x)) for x in [0, *lags]])).alias(kcol))
    fanned = fanned.select(
        *[F.col(f"`{c}`") for c in keys],
        (F.col(pos_col) + k).alias(pos_col), k,
        *[F.when(k == 0, F.col(f"`{c}`")).alias(c) for c in others],
        *[F.when(k > 0, F.col(f"`{c}`")).alias(v) for c, v in vals.items()])
    w = Window.partitionBy(*keys, pos_col)
    lag_exprs = [F.first(F.when(k == lag, F.col(vals[c])), ignorenulls=True).over(w).alias(name(c, lag))
                 for c in value_cols for lag in lags]
    return (fanned.select("*", *lag_exprs)
            .filter(k == 0)
            .drop(kcol, *vals.values()))
