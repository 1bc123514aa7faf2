"""Drift between a recent period and a baseline period, per feature (and key).

Shape of the computation, for any number of features and keys:

* ``split_periods`` flags rows ``is_recent`` / ``is_baseline``. Both periods
  are closed, so the boundary instant carries both flags.
* ``long_values`` unpivots the features into ``(keys, feature, value)``,
  dropping NULLs; all later steps group by ``(keys, feature)``.
* ``drift_moments``: mean, sample variance and counts per period, one
  partial aggregate.
* ``ks_statistic``: exact two-sample Kolmogorov-Smirnov distance. Counts are
  pre-aggregated per distinct value (ties handled, hot values collapse
  map-side), values are range-partitioned, and running sums are taken per range plus the range's offset, so one
  feature's values are spread over many tasks.
* ``drift_report`` joins the two small results and labels each feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.numeric import relative_shift
from ..functions.timeparse import scalar, shift_days
from .incremental import join_keys
from .ranking import BUCKET, in_ranges
from .sizing import ranges_for

RECENT = "is_recent"
BASELINE = "is_baseline"


def present_features(df: DataFrame, registry: Sequence[str] = tuple(fixed.DRIFT_FEATURES)) -> list[str]:
    """Registered features that exist in the table, in registry order."""
    cols = set(df.columns)
    return [f for f in registry if f in cols]


def period_end(df: DataFrame, time_col: str):
    """Global end of data (a scalar, resolved eagerly from one column)."""
    return period_stats(df, time_col)[0]


def period_stats(df: DataFrame, time_col: str):
    """(max time as a literal Column or None, row count): small jobs over the time column."""
    return scalar(df, F.max(time_col)), df.count()


def split_periods(df: DataFrame, time_col: str, recent_days: int = fixed.RECENT_DAYS,
                  baseline_days: int = fixed.BASELINE_DAYS, keys: Sequence[str] = (),
                  scope: str = "global", end=None, keep_outside: bool = False) -> DataFrame:
    """Add ``is_recent`` = t in [end - r, end] and ``is_baseline`` = t in
    [end - r - b, end - r] (both closed).

    ``scope="global"``: end = max time of the table, resolved to a literal
    first, so the range filter reaches the Parquet scan. ``scope="key"``:
    end = max time per key (a one-row-per-key aggregate joined back).
    Rows in neither period are dropped unless ``keep_outside``.
    """
    t = F.col(time_col)
    if scope == "global":
        if end is None:
            end = period_end(df, time_col)
        if end is None:
            return df.withColumn(RECENT, F.lit(False)).withColumn(BASELINE, F.lit(False)).limit(0)
        e = end if isinstance(end, Column) else F.lit(end)
        x = df
    else:
        ends = df.groupBy(*keys).agg(F.max(time_col).alias("_dl_end"))
        x = join_keys(df, ends, keys, "inner")
        e = F.col("_dl_end")
    r_start = shift_days(e, recent_days)
    b_start = shift_days(r_start, baseline_days)
    if not keep_outside:
        x = x.filter((t >= b_start) & (t <= e))
    x = x.withColumn(RECENT, (t >= r_start) & (t <= e)) \
         .withColumn(BASELINE, (t >= b_start) & (t <= r_start))
    return x.drop("_dl_end") if scope != "global" else x


def period_bounds(df: DataFrame, time_col: str, keys: Sequence[str] = (), **kw) -> DataFrame:
    """Min/max time of the whole table and of each period (one aggregate)."""
    flagged = split_periods(df, time_col, keys=keys, keep_outside=True, **kw)
    t = F.col(time_col)
    return flagged.groupBy(*keys).agg(
        F.min(t).alias("data_start"), F.max(t).alias("data_end"),
        F.min(F.when(F.col(RECENT), t)).alias("recent_start"),
        F.max(F.when(F.col(RECENT), t)).alias("recent_end"),
        F.min(F.when(F.col(BASELINE), t)).alias("baseline_start"),
        F.max(F.when(F.col(BASELINE), t)).alias("baseline_end"),
        F.count_if(F.col(RECENT)).alias("recent_rows"),
        F.count_if(F.col(BASELINE)).alias("baseline_rows"),
    )


def long_values(flagged: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, feature, value, is_recent, is_baseline)``; NaN/NULL dropped."""
    ids = [*keys, RECENT, BASELINE]
    narrow = flagged.selectExpr(
        *[f"`{k}`" for k in ids],
        *[f"CASE WHEN isnan(CAST(`{f}` AS DOUBLE)) THEN NULL ELSE CAST(`{f}` AS DOUBLE) END AS `{f}`"
          for f in features])
    return (narrow.unpivot(ids, list(features), "feature", "value")
            .filter(F.col("value").isNotNull()))


def drift_moments(long_df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean, sample variance and non-null count per period, and the shifts.

    Empty period (no non-null value on either side) -> all three metrics 0.
    One row in a period -> its variance is NULL, so variance_shift is NULL
    (never significant).
    """
    v, r, b = F.col("value"), F.col(RECENT), F.col(BASELINE)
    m = long_df.groupBy(*keys, "feature").agg(
        F.count_if(r).alias("n_recent"), F.count_if(b).alias("n_baseline"),
        F.avg(F.when(r, v)).alias("mean_recent"), F.avg(F.when(b, v)).alias("mean_baseline"),
        F.var_samp(F.when(r, v)).alias("var_recent"), F.var_samp(F.when(b, v)).alias("var_baseline"))
    return with_shifts(m)


def with_shifts(moments: DataFrame) -> DataFrame:
    """Moments of both periods with mean_shift and variance_shift, 0 if a period is empty."""
    empty = (F.col("n_recent") == 0) | (F.col("n_baseline") == 0)
    return moments.withColumns({
        "mean_shift": F.when(empty, F.lit(0.0)).otherwise(
            relative_shift(F.col("mean_recent"), F.col("mean_baseline"))),
        "variance_shift": F.when(empty, F.lit(0.0)).otherwise(
            relative_shift(F.col("var_recent"), F.col("var_baseline"))),
    })


def _value_counts(long_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return long_df.groupBy(*keys, "feature", "value").agg(
        F.count_if(F.col(RECENT)).alias("c_r"), F.count_if(F.col(BASELINE)).alias("c_b"))


def ks_statistic(long_df: DataFrame, keys: Sequence[str] = (), value_buckets: int = 32) -> DataFrame:
    """Two-sample KS distance ``max |F_recent(v) - F_baseline(v)|`` per
    ``(keys, feature)``, exact (p-value not computed).

    ``value_buckets`` ordered ranges of ``(keys, feature, value)``, of about as
    many distinct values each, bound the size of any one window task, so only a
    feature that needs it is cut; 1 means one window per feature. Ranges only
    affect balance, never the result. NULL keys are a series of their own.
    """
    return ks_of_counts(_value_counts(long_df, keys), keys, value_buckets)


def ks_of_counts(counts: DataFrame, keys: Sequence[str] = (), value_buckets: int = 32) -> DataFrame:
    """``ks_statistic`` from rows (keys, feature, value, c_r, c_b): how often each value occurs in either period."""
    keys = list(keys)
    grp = [*keys, "feature"]
    if value_buckets <= 1:
        w_all = Window.partitionBy(*grp)
        w_run = Window.partitionBy(*grp).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        cdf = counts.select(*grp,
                            F.try_divide(F.sum("c_r").over(w_run), F.sum("c_r").over(w_all)).alias("f_r"),
                            F.try_divide(F.sum("c_b").over(w_run), F.sum("c_b").over(w_all)).alias("f_b"))
        return cdf.groupBy(*grp).agg(F.max(F.abs(F.col("f_r") - F.col("f_b"))).alias("ks_statistic"))

    bucketed = in_ranges(counts, [*[F.col(f"`{g}`") for g in grp], "value"], value_buckets, "ks-ranges")
    # per-range totals -> running offsets per feature (tiny: ranges + features)
    tot = bucketed.groupBy(*grp, BUCKET).agg(F.sum("c_r").alias("t_r"), F.sum("c_b").alias("t_b"))
    w_prev = Window.partitionBy(*grp).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    w_grp = Window.partitionBy(*grp)
    offs = tot.select(*grp, BUCKET,
                      F.coalesce(F.sum("t_r").over(w_prev), F.lit(0)).alias("o_r"),
                      F.coalesce(F.sum("t_b").over(w_prev), F.lit(0)).alias("o_b"),
                      F.sum("t_r").over(w_grp).alias("n_r"),
                      F.sum("t_b").over(w_grp).alias("n_b"),
                      F.lit(True).alias("_dl_mark"))
    u = bucketed.withColumn("_dl_mark", F.lit(False)).unionByName(offs, allowMissingColumns=True)
    w = Window.partitionBy(*grp, BUCKET).orderBy(F.col("_dl_mark").desc(), "value") \
        .rowsBetween(Window.unboundedPreceding, 0)

    def carried(c: str) -> Column:
        return F.first(c, ignorenulls=True).over(w)

    run = u.select(*grp, "_dl_mark",
                   F.try_divide(carried("o_r") + F.sum(F.coalesce("c_r", F.lit(0))).over(w),
                                carried("n_r")).alias("f_r"),
                   F.try_divide(carried("o_b") + F.sum(F.coalesce("c_b", F.lit(0))).over(w),
                                carried("n_b")).alias("f_b"))
    return (run.filter(~F.col("_dl_mark"))
            .groupBy(*grp).agg(F.max(F.abs(F.col("f_r") - F.col("f_b"))).alias("ks_statistic")))


def drift_metrics(flagged: DataFrame, features: Sequence[str], keys: Sequence[str] = (),
                  value_buckets: int | str = "auto") -> DataFrame:
    """One row per (keys, feature): mean_shift, variance_shift, ks_statistic,
    n_recent, n_baseline (plus the period moments)."""
    keys = list(keys)
    if value_buckets == "auto":
        value_buckets = ranges_for(flagged.count() * len(features))
    lv = long_values(flagged, features, keys)
    return joined_metrics(drift_moments(lv, keys), ks_statistic(lv, keys, value_buckets=value_buckets), keys)


def joined_metrics(mom: DataFrame, ks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Moments with the KS distance, 0 if a period is empty."""
    j = join_keys(mom, ks, [*keys, "feature"], "left")
    empty = (F.col("n_recent") == 0) | (F.col("n_baseline") == 0)
    return j.withColumn("ks_statistic",
                        F.when(empty, F.lit(0.0)).otherwise(F.coalesce("ks_statistic", F.lit(0.0))))


def significant(threshold: float = fixed.DRIFT_THRESHOLD, ks: float = fixed.KS_THRESHOLD) -> Column:
    """mean_shift > t OR variance_shift > t OR ks > ks_t; NULL compares false."""
    return (F.coalesce(F.col("mean_shift") > threshold, F.lit(False))
            | F.coalesce(F.col("variance_shift") > threshold, F.lit(False))
            | F.coalesce(F.col("ks_statistic") > ks, F.lit(False)))


def classify_drift(threshold: float = fixed.DRIFT_THRESHOLD, ks: float = fixed.KS_THRESHOLD) -> Column:
    """First match wins: mean_shift, variance_shift, distribution_shift, no_drift."""
    return (F.when(F.coalesce(F.col("mean_shift") > threshold, F.lit(False)), F.lit("mean_shift"))
            .when(F.coalesce(F.col("variance_shift") > threshold, F.lit(False)), F.lit("variance_shift"))
            .when(F.coalesce(F.col("ks_statistic") > ks, F.lit(False)), F.lit("distribution_shift"))
            .otherwise(F.lit("no_drift")))


def label_drift(metrics: DataFrame, features: Sequence[str] | None = None,
                threshold: float = fixed.DRIFT_THRESHOLD, ks: float = fixed.KS_THRESHOLD) -> DataFrame:
    """Add is_significant, drift_type and pos (registry order of the feature)."""
    out = metrics.withColumn("is_significant", significant(threshold, ks)) \
                 .withColumn("drift_type", classify_drift(threshold, ks))
    if features is not None:
        names = ", ".join("'" + f.replace("'", "''") + "'" for f in features)
        out = out.withColumn("pos", F.expr(f"CAST(nullif(array_position(array({names}), feature), 0) AS INT) - 1"))
    return out


def drift_report(df: DataFrame, time_col: str, features: Sequence[str] | None = None,
                 keys: Sequence[str] = (), threshold: float = fixed.DRIFT_THRESHOLD,
                 ks: float = fixed.KS_THRESHOLD, recent_days: int = fixed.RECENT_DAYS,
                 baseline_days: int = fixed.BASELINE_DAYS, scope: str = "global",
                 value_buckets: int | str = "auto") -> DataFrame:
    """Long drift report: one row per (keys, feature) present in the table.

    ``value_buckets="auto"`` sizes the KS value ranges from the row count
    times the features: one range per ``ROWS_PER_TASK`` values, so small tables
    use one window per feature and a feature with billions of values is spread
    over many tasks.
    """
    feats = present_features(df, features if features is not None else fixed.DRIFT_FEATURES)
    narrow = df.select(*keys, time_col, *[F.col(f"`{f}`") for f in feats])
    end = None
    if scope == "global" or value_buckets == "auto":
        end, n_rows = period_stats(narrow, time_col)
        if value_buckets == "auto":
            value_buckets = ranges_for(n_rows * len(feats))
    flagged = split_periods(narrow, time_col, recent_days, baseline_days, keys=keys, scope=scope,
                            end=end if scope == "global" else None)
    m = drift_metrics(flagged, feats, keys, value_buckets=value_buckets)
    return label_drift(m, feats, threshold, ks)


def summary_lines(report: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One text per key: a line per significant feature in registry order,
    joined by newlines; a fixed text when nothing is significant.

    The collected list is bounded by the number of features.
    """
    line = F.format_string(fixed.SUMMARY_LINE_FORMAT, F.col("feature"), F.col("drift_type"),
                           F.col("mean_shift"), F.col("variance_shift"), F.col("ks_statistic"))
    items = F.collect_list(F.when(F.col("is_significant"), F.struct(F.col("pos"), line.alias("l"))))
    agg = report.groupBy(*keys).agg(F.array_sort(items).alias("_dl_items"))
    text = F.array_join(F.transform("_dl_items", lambda s: s["l"]), "\n")
    return agg.select(*keys, F.when(F.size("_dl_items") == 0, F.lit(fixed.NO_DRIFT_TEXT))
                      .otherwise(text).alias("summary"))


def nested_report(report: DataFrame, keys: Sequence[str] = (),
                  features_to_add: Sequence[str] = (), reasoning: str = "") -> DataFrame:
    """The nested report object: one row per key (bounded by #features)."""
    metrics = F.struct("mean_shift", "variance_shift", "ks_statistic")
    sig = F.collect_list(F.when(F.col("is_significant"), F.struct(
        F.col("pos"), F.col("feature"), F.col("drift_type"), metrics.alias("metrics"))))
    agg = report.groupBy(*keys).agg(
        F.max(F.col("is_significant").cast("int")).alias("_dl_any"),
        F.map_from_entries(F.collect_list(F.struct(F.col("feature"), metrics))).alias("drift_metrics"),
        F.array_sort(sig).alias("_dl_sig"))
    return agg.select(
        *keys,
        F.coalesce(F.col("_dl_any") == 1, F.lit(False)).alias("seasonal_shift_detected"),
        F.array(*[F.lit(f) for f in features_to_add]).cast("array<string>").alias("features_to_add"),
        F.lit(reasoning).alias("reasoning"),
        F.struct(F.col("drift_metrics"),
                 F.transform("_dl_sig", lambda s: F.struct(
                     s["feature"].alias("feature"), s["drift_type"].alias("drift_type"),
                     s["metrics"].alias("metrics"))).alias("significant_drifts"))
        .alias("detailed_analysis"))
