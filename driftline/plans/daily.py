"""The daily jobs, end to end, as Spark jobs over files.

1. ``ingest_day``: landed pollutant + weather payloads -> raw hourly table
   (inner join on time, append, keep the existing row per hour, guards).
2. ``update_feature_table``: raw rows not yet in the feature table -> 46
   feature columns (scaler fitted on the new rows, lags over history + new)
   -> upsert keeping the new row.
3. ``refresh_selection``: feature rows newer than the selection's last hour
   -> the 18 selected columns -> upsert keeping the new row.
4. ``drift_analysis``: feature table -> drift report JSON.
5. ``discovery``: requested features + column catalog + attempt log ->
   dispositions and the nested report.

Every write goes to a staging folder first and is then swapped in, so a job
can rewrite the table it read, and a failed job leaves the old table intact.
Tables are CSV with a header, as in the original; ``fmt="parquet"`` works too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..operators import discovery as disc
from ..operators import drift, features, incremental, matching
from ..session import materialize, scratch_dir
from ..sources import payload, sinks, tables
from ..sources.guarded import replace_guarded


def feature_schema(time_as_text: bool = True) -> T.StructType:
    from .suite import FEATURE_COLUMNS, INT_FEATURES
    t = T.StringType() if time_as_text else T.TimestampNTZType()
    return T.StructType([T.StructField(fixed.TIME_COL, t)] +
                        [T.StructField(c, T.IntegerType() if c in INT_FEATURES else T.DoubleType())
                         for c in FEATURE_COLUMNS[1:]])


def selection_schema() -> T.StructType:
    fs = feature_schema()
    return T.StructType([fs[c] for c in fixed.SELECTED_COLUMNS])


def _swap(spark, df: DataFrame, path: str, **kw) -> None:
    sinks.replace_table(spark, df, path, scratch_dir(spark, "staging"), **kw)


def ingest_day(spark: SparkSession, pollutant_path: str, weather_path: str, raw_path: str,
               keys: Sequence[str] = (), mode: str = "rewrite") -> dict:
    """Append one day of payloads to the raw table; existing hours win.

    ``mode="rewrite"`` (the original's behaviour): union, keep first, guards,
    sorted full rewrite of a CSV table through a staged swap. Raises before
    the swap when the merge would lose rows or the table cannot be read; the rows
    are counted by the job that writes them.
    ``mode="append"``: a Parquet table partitioned by date; only hours not yet
    present are appended (anti-join against the partitions of the batch's
    dates), so the daily cost follows the day, not the table, and a re-run
    appends nothing.
    """
    pol = payload.read_hourly_payload(spark, pollutant_path, fixed.POLLUTANT_FIELDS)
    wea = payload.read_hourly_payload(spark, weather_path, fixed.WEATHER_FIELDS)
    merged = incremental.join_on_time(pol, wea, keys=keys)
    if mode == "append":
        from ..streaming.landing import append_new_hours
        cols = [F.col(f"`{c}`") for c in [*keys, *fixed.RAW_COLUMNS]]
        return {"rows_added": append_new_hours(merged.select(*cols), raw_path, keys=keys)}
    existing = tables.load_or_empty(spark, raw_path, tables.raw_schema(),
                                    time_formats=fixed.FMT_ISO, on_bad="null")
    return replace_guarded(
        spark, existing, lambda seen: incremental.upsert(seen, merged, keys=keys, keep="first").select(
            *[F.col(f"`{c}`") for c in [*keys, *fixed.RAW_COLUMNS]]), raw_path, time_format=fixed.FMT_ISO)


def update_feature_table(spark: SparkSession, raw_path: str, feature_path: str,
                         keys: Sequence[str] = ()) -> dict:
    """Feature rows for raw hours not yet in the feature table.

    Returns counts; writes nothing when there is nothing new.
    """
    keys = list(keys)
    raw = tables.read_table(spark, raw_path, schema=tables.raw_schema(),
                            time_formats=fixed.FMT_ISO, on_bad="fail")
    prev = tables.load_or_empty(spark, feature_path, feature_schema(),
                                time_formats=fixed.FMT_DAY_FIRST, on_bad="fail")
    # the anti-join reads the whole raw table and the feature table's keys:
    # run it once and keep the (small) result in the shared folder
    new = materialize(incremental.new_rows(raw, prev, keys=keys), "new-rows")
    if not incremental.has_rows(new):
        return {"new_rows": 0}
    feats = features.build_features(new, history=prev, keys=keys)
    cols = [c.name for c in feature_schema().fields]
    final = incremental.upsert(prev, feats.select(*keys, *[F.col(f"`{c}`") for c in cols]),
                               keys=keys, keep="last")
    n_new = new.count()
    _swap(spark, final, feature_path, time_format=fixed.FMT_DAY_FIRST)
    return {"new_rows": n_new}


def refresh_selection(spark: SparkSession, feature_path: str, selection_path: str,
                      bootstrap: bool = True) -> dict:
    """Selected columns of the feature rows newer than the selection's max hour.

    Both files are parsed with mixed formats (day-first first). With an
    empty or absent selection, ``bootstrap=True`` takes every row (the
    original would add nothing in that case).
    """
    full = tables.read_table(spark, feature_path, schema=feature_schema(),
                             time_formats=fixed.MIXED_FORMATS,
                             on_bad="null")
    sel = tables.load_or_empty(spark, selection_path, selection_schema(),
                               time_formats=fixed.MIXED_FORMATS, on_bad="null")
    new = incremental.rows_after_watermark(full, sel, bootstrap=bootstrap)
    if not incremental.has_rows(new):
        return {"new_rows": 0}
    updated = incremental.upsert(sel, features.select_features(new), keys=[], keep="last")
    n_new = new.count()
    _swap(spark, updated, selection_path, time_format=fixed.FMT_ISO)
    return {"new_rows": n_new}


def drift_analysis(spark: SparkSession, feature_path: str, out_path: str | None = None,
                   threshold: float = fixed.DRIFT_THRESHOLD, features_to_add: Sequence[str] = (),
                   reasoning: str = "") -> DataFrame:
    """Drift report of the feature table; optional nested JSON report."""
    ft = tables.read_table(spark, feature_path, schema=feature_schema(),
                           time_formats=[fixed.FMT_DAY_FIRST, fixed.FMT_ISO], on_bad="null")
    tc = tables.resolve_time_col(ft)
    rep = drift.drift_report(ft, tc, fixed.DRIFT_FEATURES, threshold=threshold)
    if out_path:
        sinks.write_report(drift.nested_report(rep, features_to_add=features_to_add,
                                               reasoning=reasoning).coalesce(1), out_path)
    return rep


def discovery(spark: SparkSession, requested: DataFrame, table: DataFrame, attempt_log: DataFrame,
              out_path: str | None = None, run_at: str | None = None, source: str = "",
              location: dict[str, object] | None = None) -> DataFrame:
    """Dispositions for the requested features (``pos, feature``).

    With ``out_path`` the whole report is written there; ``run_at`` is its time stamp,
    ``source`` names the table and ``location`` its place.

    ``table`` only supplies its column names; ``attempt_log`` has one row per
    (feature, attempt) with the model's response text and the probe outcome.
    """
    catalog = tables.column_catalog(table)
    matches = matching.match_features(requested, catalog)
    todo = matches.filter(F.col("status") == fixed.STATUS_MISSING).select("feature")
    log = attempt_log.join(todo, "feature", "left_semi")
    resolved = disc.resolve_attempts(log)
    d = disc.dispositions(matches.withColumnRenamed("feature", "original_feature")
                          .withColumn("feature", F.col("original_feature")),
                          resolved, key="feature").drop("feature")
    if out_path:
        d = materialize(d, "dispositions")  # three parts of the report read it
        sinks.write_disposition_report(disc.disposition_report(d),
                                       disc.report_header(d, catalog, run_at or "", source, location), out_path,
                                       mappings=disc.detailed_mappings(d))
    return d
