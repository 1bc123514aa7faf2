"""Lags by the clock, and lags kept right when rows arrive late.

``features.lag_features`` counts rows. Here a lag is the value some hours
earlier: at exactly that time (``lag_by_clock``), or as of it
(``lag_as_of``). ``refresh_lags`` brings a table with lags by row up to date
after a back-fill: a late row moves the lags of the rows behind it, as many as
the largest lag, and only those are computed anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..session import materialize
from .features import lag_features
from .incremental import join_keys, new_rows, upsert
from .ranking import BUCKET, in_ranges, lag_by_position
from .sizing import RANGE_SPREAD, ROWS_PER_TASK, ranges_for, series_profile

HOUR = 3_600_000_000  # microseconds


def _micros(time_col: str) -> Column:
    return F.unix_micros(F.col(f"`{time_col}`").cast("timestamp"))


def lag_by_clock(df: DataFrame, cols: Sequence[str], hours: Sequence[int] = tuple(fixed.LAGS), keys: Sequence[str] = (),
                 time_col: str = fixed.TIME_COL) -> DataFrame:
    """``<c>_<k>h_ago``: the value exactly k hours earlier, NULL if that hour is missing.

    An equi-join of the table with itself shifted, done as one fan-out and one
    shuffle for all lags; groups have 1 + #lags rows. Times are unique within a
    key (deduplicate first); rows without a time have no earlier ones.
    """
    pos, by_micros = "_dl_at", {k * HOUR: k for k in hours}
    rows = df.withColumn(pos, _micros(time_col))
    lagged = lag_by_position(rows.where(f"{pos} IS NOT NULL"), keys, pos, cols, list(by_micros),
                             name=lambda c, k: f"{c}_{by_micros[k]}h_ago")
    return lagged.unionByName(rows.where(f"{pos} IS NULL"), allowMissingColumns=True).drop(pos)


def lag_as_of(df: DataFrame, cols: Sequence[str], hours: Sequence[int] = tuple(fixed.LAGS), keys: Sequence[str] = (),
              order: Sequence[str] = (fixed.TIME_COL,), rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``<c>_<k>h_as_of``: the value of the last row at or before k hours earlier, NULL if there is none.

    For irregular series. ``order`` starts with the time; its other columns tell
    rows of one time apart, the last of them counts. Every row goes in as itself
    and as a question for each lag, and one window gives each question the last
    row before it. A series of more than ``rows_per_task`` such rows is cut into
    ordered ranges, each of which starts with the last row of those before.
    Rows without a time are no answers and get NULL.
    """
    keys, order, time_col = list(keys), list(order), order[0]
    rows = df.withColumn("_dl_at", _micros(time_col)).withColumn("_dl_row", F.monotonically_increasing_id())
    rows = materialize(rows, "as-of-rows")  # row numbers must stay
    values = F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(cols)])
    shifted = F.array(F.lit(0), *[F.lit(int(k)) for k in hours])
    known = rows.where("_dl_at IS NOT NULL").select(
        *[F.col(f"`{k}`") for k in keys], F.col("_dl_at").alias("_at"), values.alias("_v"), "_dl_row",
        F.struct(*[F.col(f"`{c}`") for c in order[1:]], "_dl_row").alias("_tie"), F.explode(shifted).alias("_k"))
    # a question comes after the rows of its time
    marks = known.select(
        *[F.col(f"`{k}`") for k in keys], (F.col("_at") - F.col("_k") * HOUR).alias("_at"), (F.col("_k") > 0).alias("_ask"),
        F.when(F.col("_k") == 0, F.col("_v")).alias("_v"), F.when(F.col("_k") == 0, F.col("_tie")).alias("_tie"),
        "_dl_row", "_k")
    along = ["_at", "_ask", "_tie", "_dl_row", "_k"]
    total, largest = series_profile(marks, keys)
    if largest <= rows_per_task:
        series, by = marks.withColumn("_first", F.lit(1)), keys
    else:
        dealt = in_ranges(marks, [*[F.col(f"`{k}`") for k in keys], *along],
                          ranges_for(total, rows_per_task) * RANGE_SPREAD, "as-of-ranges", total)
        before = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(BUCKET) \
            .rowsBetween(Window.unboundedPreceding, -1)
        lasts = dealt.groupBy(*keys, BUCKET).agg(
            F.max_by("_v", F.when(~F.col("_ask"), F.struct("_at", "_tie"))).alias("_last"))
        starts = lasts.select(*keys, BUCKET, F.last("_last", ignorenulls=True).over(before).alias("_v"), F.lit(0).alias("_first"))
        series = dealt.withColumn("_first", F.lit(1)).unionByName(starts, allowMissingColumns=True)
        by = [*keys, BUCKET]
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy("_first", *along) \
        .rowsBetween(Window.unboundedPreceding, 0)
    answers = series.withColumn("_a", F.last("_v", ignorenulls=True).over(w)).where("_ask")
    wide = answers.groupBy("_dl_row").agg(*[
        F.first(F.when(F.col("_k") == k, F.col("_a")), ignorenulls=True).alias(f"_a{k}") for k in hours])
    named = [F.col(f"_a{k}.v{i}").alias(f"{c}_{k}h_as_of") for i, c in enumerate(cols) for k in hours]
    return rows.join(wide, "_dl_row", "left").select(*[F.col(f"`{c}`") for c in df.columns], *named)


def _needed_days(days: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """Of days (keys, _day, _n rows, _late): those that hold any of the ``depth`` rows before or behind a late day,
    with ``_segment``, the number of their run of needed days."""
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_day")
    past, to_come = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    upto = F.sum("_n").over(past)
    summed = days.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_n"))
    last = F.max(F.when(F.col("_late"), F.col("_upto"))).over(past)
    following = F.min(F.when(F.col("_late"), F.col("_before"))).over(to_come)
    near = F.coalesce(F.col("_before") - F.col("_last") < depth, F.lit(False)) | \
        F.coalesce(F.col("_next") - F.col("_upto") < depth, F.lit(False))
    marked = summed.withColumn("_last", last).withColumn("_next", following).withColumn("_near", near)
    return marked.withColumn("_segment", F.sum(F.when(F.col("_near"), 0).otherwise(1)).over(past)) \
        .where("_near").select(*keys, "_day", "_segment")


def changed_lags(table: DataFrame, late: DataFrame, cols: Sequence[str] = tuple(fixed.LAG_SOURCES),
                 lags: Sequence[int] = tuple(fixed.LAGS), keys: Sequence[str] = (),
                 order: Sequence[str] = (fixed.TIME_COL,), rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows of ``table`` and ``late`` whose lags aren't (or no longer) in ``table``, with their lags.

    ``table`` has the columns ``<c>_lag<k>``, right for its own rows; a row of
    ``late`` with the key and order of one of them replaces it. Only the days are
    read that hold the largest lag's number of rows around a late row; each run
    of such days is a small series of its own. Runs of more than
    ``rows_per_task`` rows (a back-fill of most of the table) take the plan of
    huge series over the whole table. Order columns are unique within a key.
    """
    keys, order, depth = list(keys), list(order), max(lags)
    raw = [c for c in table.columns if c not in {f"{c}_lag{k}" for c in cols for k in lags}]
    late = late.select(*[F.col(f"`{c}`") for c in raw])
    on = [*keys, *order[1:]]
    base = new_rows(table.select(*[F.col(f"`{c}`") for c in raw]), late, keys=on, time_col=order[0])
    day = F.to_date(F.col(f"`{order[0]}`")).alias("_day")

    def days(df: DataFrame, n: Column, is_late: bool) -> DataFrame:
        return df.select(*keys, day).groupBy(*keys, "_day").agg(n.alias("_n"), F.lit(is_late).alias("_late"))

    # a replaced row keeps its place, so its day counts without it and as late
    both = days(base, F.count(F.lit(1)), False).unionByName(days(late, F.lit(0).cast("bigint"), True))
    profile = both.groupBy(*keys, "_day").agg(F.sum("_n").alias("_n"), F.max("_late").alias("_late"))
    needed = materialize(_needed_days(profile, keys, depth), "backfill-days")
    first, last = needed.agg(F.min("_day"), F.max("_day")).first()
    if first is None and needed.isEmpty():
        return table.limit(0)
    # literals reach the scan; a day may be NULL, as its rows have no time
    t = F.col(f"`{order[0]}`")
    around = base.where((F.to_date(t) >= F.lit(first)) & (F.to_date(t) <= F.lit(last)) | t.isNull())
    merged = around.withColumn("_dl_late", F.lit(False)).unionByName(late.withColumn("_dl_late", F.lit(True)))
    merged = join_keys(merged.withColumn("_day", day), needed, [*keys, "_day"], "inner").drop("_day")
    merged = materialize(merged, "backfill-rows")
    _, largest = series_profile(merged, [*keys, "_segment"])
    if largest > rows_per_task:
        every = base.unionByName(late)
        return lag_features(every, cols, lags, keys, order, rows_per_task=rows_per_task).select(
            *[F.col(f"`{c}`") for c in table.columns])
    lagged = lag_features(merged, cols, lags, [*keys, "_segment"], order, method="window")
    behind = Window.partitionBy(*keys, "_segment").orderBy(*order).rowsBetween(-depth, 0)
    return lagged.withColumn("_dl_moved", F.max("_dl_late").over(behind)).where("_dl_moved") \
        .select(*[F.col(f"`{c}`") for c in table.columns])


def refresh_lags(table: DataFrame, late: DataFrame, cols: Sequence[str] = tuple(fixed.LAG_SOURCES),
                 lags: Sequence[int] = tuple(fixed.LAGS), keys: Sequence[str] = (),
                 order: Sequence[str] = (fixed.TIME_COL,), rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``table`` with ``late`` and all lags as a full rebuild would give them; see ``changed_lags``."""
    changed = materialize(changed_lags(table, late, cols, lags, keys, order, rows_per_task), "backfill-changed")
    return upsert(table, changed, keys=[*keys, *list(order)[1:]], time_col=order[0], keep="last")
