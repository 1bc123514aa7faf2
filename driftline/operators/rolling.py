"""The drift report from daily state, without reading the old rows again.

The state of a day is how often each value of each feature occurs on it
(``day_counts``), and count, mean and sum of squared deviations (``day_moments``). Days are merged by Chan's formula, so a report over 97 days
reads their state, and of the table itself only the days on which a period
begins or ends, as those are cut at an instant. A late or corrected row makes its
own day's state anew and no other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.timeparse import scalar, shift_days
from ..session import materialize
from ..sources.tables import path_exists
from .drift import (BASELINE, RECENT, joined_metrics, ks_of_counts, label_drift, long_values, present_features,
                    split_periods, with_shifts)
from .partitioned import PART, overwrite_partitions, touched_partitions
from .sizing import ranges_for

DAY = "day"


def _dated(df: DataFrame, time_col: str, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``(keys, day, feature, value)``, NULL and NaN left out."""
    dated = df.where(F.col(time_col).isNotNull()).withColumn(DAY, F.to_date(time_col)) \
        .withColumn(RECENT, F.lit(False)).withColumn(BASELINE, F.lit(False))
    return long_values(dated, features, [*keys, DAY]).drop(RECENT, BASELINE)


def _numbers() -> list[Column]:
    """Count, mean and sum of squared deviations of ``value``."""
    n = F.count("value")
    return [n.alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * n).alias("m2")]


def day_counts(df: DataFrame, time_col: str, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, day, feature, value, n)``: how often each value occurs on a day."""
    return _dated(df, time_col, features, keys).groupBy(*keys, DAY, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def day_moments(df: DataFrame, time_col: str, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, day, feature, n, mean, m2)``."""
    return _dated(df, time_col, features, keys).groupBy(*keys, DAY, "feature").agg(*_numbers())


def write_days(df: DataFrame, path: str, time_col: str, features: Sequence[str], keys: Sequence[str] = ()) -> None:
    """Put the state of the days of ``df`` in place of what ``path`` has of them. ``df`` holds whole days.

    Files are by month, so only the months of these days are read and written.
    """
    spark, month = df.sparkSession, F.date_format(DAY, "yyyy-MM")
    for name, make in (("counts", day_counts), ("moments", day_moments)):
        state = materialize(make(df, time_col, features, keys).withColumn(PART, month), "day-state")
        if path_exists(spark, f"{path}/{name}"):
            # a day without any value left has no state, so days are those of the rows
            days = df.select(F.to_date(time_col).alias("_dl_day")).where("_dl_day IS NOT NULL").distinct()
            parts = days.select(F.date_format("_dl_day", "yyyy-MM").alias(PART)).distinct()
            held = touched_partitions(spark, f"{path}/{name}", parts).join(days, F.col(DAY) == F.col("_dl_day"), "left_anti")
            state = materialize(held.select(*state.columns).unionByName(state), "day-state")
        overwrite_partitions(state, f"{path}/{name}")


def rolling_report(spark: SparkSession, path: str, table: DataFrame, time_col: str,
                   features: Sequence[str] | None = None, keys: Sequence[str] = (),
                   threshold: float = fixed.DRIFT_THRESHOLD, ks: float = fixed.KS_THRESHOLD,
                   recent_days: int = fixed.RECENT_DAYS, baseline_days: int = fixed.BASELINE_DAYS) -> DataFrame:
    """``drift.drift_report`` of ``table`` (global end of data) from the state at ``path``.

    ``table`` is read for its last time and for the rows of the three days on
    which periods begin or end.
    """
    keys, feats = list(keys), present_features(table, features if features is not None else fixed.DRIFT_FEATURES)
    narrow = table.select(*keys, time_col, *[F.col(f"`{f}`") for f in feats])
    end = scalar(narrow, F.max(time_col))
    counts, moments = (spark.read.parquet(f"{path}/{x}") for x in ("counts", "moments"))
    if end is None:
        return label_drift(_metrics(counts.limit(0), moments.limit(0), narrow.limit(0), time_col, feats, keys, 1), feats,
                           threshold, ks)
    start = shift_days(end, recent_days)
    cuts = [F.to_date(x) for x in (shift_days(start, baseline_days), start, end)]
    first, middle, last = spark.range(1).select(*cuts).first()  # literals, so that folders and row groups are skipped
    day = F.col(DAY)
    recent, baseline = (day > F.lit(middle)) & (day < F.lit(last)), (day > F.lit(first)) & (day < F.lit(middle))
    flags = {RECENT: recent, BASELINE: baseline}
    months = F.col(PART).cast("string").between(F.lit(f"{first:%Y-%m}"), F.lit(f"{last:%Y-%m}"))
    whole = months & (recent | baseline) & F.col("feature").isin(feats)
    t = F.col(time_col)
    edges = None
    for d in dict.fromkeys((first, middle, last)):
        on_day = narrow.where((t >= F.lit(d)) & (t < F.date_add(F.lit(d), 1)))
        edges = on_day if edges is None else edges.unionAll(on_day)
    edges = split_periods(edges, time_col, recent_days, baseline_days, end=end)
    of_days = counts.where(whole).withColumns(flags)
    rows = moments.where(whole).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return label_drift(_metrics(of_days, moments.where(whole).withColumns(flags), edges, time_col, feats, keys,
                                ranges_for(rows)), feats, threshold, ks)


def _metrics(counts: DataFrame, moments: DataFrame, edges: DataFrame, time_col: str, feats: Sequence[str],
             keys: list[str], value_buckets: int) -> DataFrame:
    """Metrics of whole days' state (flagged) and of the flagged rows of the other days."""
    by = [*keys, "feature"]
    for flag in (RECENT, BASELINE):  # the state of no day at all comes without flags
        if flag not in counts.columns:
            counts, moments = (x.withColumn(flag, F.lit(False)) for x in (counts, moments))
            edges = edges.withColumn(flag, F.lit(False))
    rows = long_values(edges, feats, keys)
    values = counts.select(*by, "value", "n", RECENT, BASELINE).unionByName(rows.withColumn("n", F.lit(1).cast("bigint")))
    both = values.groupBy(*by, "value").agg(
        F.coalesce(F.sum(F.when(F.col(RECENT), F.col("n"))), F.lit(0)).alias("c_r"),
        F.coalesce(F.sum(F.when(F.col(BASELINE), F.col("n"))), F.lit(0)).alias("c_b"))
    # one piece for each day, and a few for the rows of the cut days
    cut = rows.groupBy(*by, RECENT, BASELINE).agg(*_numbers())
    pieces = moments.select(*by, "n", "mean", "m2", RECENT, BASELINE).unionByName(cut.select(
        *by, "n", "mean", "m2", RECENT, BASELINE))
    w = Window.partitionBy(*by)

    def period(flag: str, name: str) -> tuple[Column, list[Column]]:
        """The period's mean, and its three numbers given that."""
        n = F.when(F.col(flag), F.col("n"))
        apart = F.col("m2") + F.col("n") * (F.col("mean") - F.col(f"mean_{name}")) ** 2
        size = F.coalesce(F.sum(n), F.lit(0))
        return F.sum(n * F.col("mean")).over(w) / F.nullif(F.sum(n).over(w), F.lit(0)), [
            size.alias(f"n_{name}"), F.first(f"mean_{name}").alias(f"_m_{name}"),
            F.when(size > 1, F.sum(F.when(F.col(flag), apart)) / (size - 1)).alias(f"var_{name}")]

    (mean_r, of_r), (mean_b, of_b) = period(RECENT, "recent"), period(BASELINE, "baseline")
    merged = pieces.withColumns({"mean_recent": mean_r, "mean_baseline": mean_b}).groupBy(*by).agg(*of_r, *of_b) \
        .withColumnsRenamed({"_m_recent": "mean_recent", "_m_baseline": "mean_baseline"})
    return joined_metrics(with_shifts(merged), ks_of_counts(both, keys, value_buckets), keys)
