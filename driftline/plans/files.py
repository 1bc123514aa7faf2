"""Queries of readers, writers, load guards and reports, each with its DuckDB SQL.

They take data of the driver tables through files in the shared folder and back;
the SQL says what must come out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.timeparse import day_window, parse_time
from ..operators import discovery, drift, features, incremental
from ..session import materialize, scratch_dir
from ..sources import payload, sinks, tables
from ..sources.guarded import GuardError, replace_guarded
from . import suite
from .daily import selection_schema
from .standins import HOURLY_WIDE_SQL, hourly_wide, table
from .suite import finish, q, r6, ts

RAW = fixed.RAW_COLUMNS
RUN_AT = "2025-06-01T00:00:00"
#: Requested features in one report file, and the hour of the day whose time texts are spoilt.
REPORT_SIZE, BAD_HOUR = 100, 5
#: Place in the discovery report's metadata.
LOCATION = {"lat": 24.8607, "lon": 67.0011, "city": "Karachi", "country": "Pakistan"}


def _hourly(spark: SparkSession, sf: str) -> DataFrame:
    return hourly_wide(table(spark, sf, "events"))


# ---------------------------------------------------------------------------
# readers
# ---------------------------------------------------------------------------

def q_weather_payload_files(spark, sf):
    """Weather payloads, one a day, landed as JSON lines -> read from the files and exploded."""
    path = scratch_dir(spark, "weather-payload")
    suite.payload_text(spark, sf, fixed.WEATHER_FIELDS).write.text(path)
    return finish(payload.read_hourly_payload(spark, path, fixed.WEATHER_FIELDS, multi_line=False))


SQL_WEATHER_PAYLOAD_FILES = f"""
WITH hw AS ({HOURLY_WIDE_SQL})
SELECT {ts('datetime', 'datetime')}, {', '.join(r6(q(c)) for c in fixed.WEATHER_FIELDS.values())} FROM hw
"""


def _spoilt_csv(spark, sf) -> str:
    """The raw hourly table as CSV, where the times of one hour of the day are no times."""
    path = scratch_dir(spark, "spoilt-csv")
    text = _hourly(spark, sf).withColumn("datetime", F.when(F.hour("datetime") == BAD_HOUR, "unknown").otherwise(
        F.date_format("datetime", fixed.FMT_ISO)))
    sinks.write_table(text, path, sort="none")
    return path


def q_raw_csv_bad_times(spark, sf):
    """Raw CSV whose bad times become NULL; parsing the parsed column once more changes nothing."""
    df = tables.read_table(spark, _spoilt_csv(spark, sf), schema=tables.raw_schema(), on_bad="null")
    return finish(df.withColumn("datetime", parse_time("datetime", on_bad="null")))


SQL_RAW_CSV_BAD_TIMES = f"""
WITH hw AS ({HOURLY_WIDE_SQL})
SELECT CASE WHEN hour(datetime) <> {BAD_HOUR} THEN strftime(datetime, '%Y-%m-%d %H:%M:%S') END AS datetime,
       {', '.join(r6(q(c)) for c in RAW[1:])} FROM hw
"""


def q_raw_csv_in_file_order(spark, sf):
    """Raw CSV written by time and read strictly; ``pos`` counts the rows as the files hold them, file by name."""
    path = scratch_dir(spark, "raw-csv")
    sinks.write_table(_hourly(spark, sf), path)
    rows = tables.read_table(spark, path, schema=tables.raw_schema()).select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))
    by_name = Window.partitionBy(F.lit(0)).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n")) \
        .select("file", F.coalesce(F.sum("n").over(by_name), F.lit(0)).alias("before"))  # a row per file
    inside = Window.partitionBy("file").orderBy("block", "row")
    placed = rows.withColumn("nth", F.row_number().over(inside)).join(before, "file")
    return finish(placed.select((F.col("before") + F.col("nth")).alias("pos"), *[F.col(f"`{c}`") for c in RAW]))


SQL_RAW_CSV_IN_FILE_ORDER = f"""
WITH hw AS ({HOURLY_WIDE_SQL})
SELECT row_number() OVER (ORDER BY datetime) AS pos, {ts('datetime', 'datetime')},
       {', '.join(r6(q(c)) for c in RAW[1:])} FROM hw
"""


def q_time_column(spark, sf):
    """The time column is ``datetime``, or ``date`` where there is no such; its range in both tables."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("date"), (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("datetime"))
    out = None
    for name, df in (("both", orders), ("date only", orders.drop("datetime"))):
        time_col = tables.resolve_time_col(df)
        one = df.agg(F.min(time_col).alias("first"), F.max(time_col).alias("last"), F.count(time_col).alias("n")) \
            .select(F.lit(name).alias("columns"), F.lit(time_col).alias("time_col"), "first", "last", "n")
        out = one if out is None else out.unionByName(one)
    return finish(out)


SQL_TIME_COLUMN = f"""
SELECT 'both' AS columns, 'datetime' AS time_col, {ts("min(o_orderdate) + INTERVAL 1 DAY", 'first')},
       {ts("max(o_orderdate) + INTERVAL 1 DAY", 'last')}, count(o_orderdate) AS n FROM orders
UNION ALL
SELECT 'date only', 'date', {ts('min(o_orderdate)', 'first')}, {ts('max(o_orderdate)', 'last')}, count(o_orderdate)
FROM orders
"""


def q_first_run_load(spark, sf):
    """A table that isn't there is empty with all columns; a first batch goes into it and is read back."""
    path = scratch_dir(spark, "first-run")
    before = tables.load_or_empty(spark, path, tables.raw_schema())
    found_rows = incremental.has_rows(before)
    sinks.write_table(incremental.upsert(before, _hourly(spark, sf)), path)
    after = tables.load_or_empty(spark, path, tables.raw_schema())
    return finish(after.select(*[F.col(f"`{c}`") for c in before.columns], F.lit(found_rows).alias("had_rows"),
                               F.lit(incremental.has_rows(after)).alias("has_rows")))


SQL_FIRST_RUN_LOAD = f"""
WITH hw AS ({HOURLY_WIDE_SQL})
SELECT {ts('datetime', 'datetime')}, {', '.join(r6(q(c)) for c in RAW[1:])}, false AS had_rows,
       (SELECT count(*) > 0 FROM hw) AS has_rows FROM hw
"""


def q_requested_report(spark, sf):
    """Report files of ``REPORT_SIZE`` requested features each -> (pos in its list, feature)."""
    path = scratch_dir(spark, "requests")
    # a number of partitions, as AQE goes by bytes and would have one task write thousands of small files
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    requests = suite.requested_features(spark, sf).withColumn("report", F.expr(f"pos div {REPORT_SIZE}"))
    reports = requests.repartition(tasks, "report").groupBy("report").agg(
        F.array_sort(F.collect_list(F.struct("pos", "feature"))).alias("items"))
    reports.select(F.transform("items", lambda x: x["feature"]).alias("features_to_add")) \
        .write.option("maxRecordsPerFile", 1).json(path)
    return tables.read_requested_features(spark, path)


SQL_REQUESTED_REPORT = f"""
WITH {suite.REQUESTED_SQL}
SELECT CAST(row_number() OVER (PARTITION BY pos // {REPORT_SIZE} ORDER BY pos) - 1 AS INTEGER) AS pos, feature FROM req
"""


def q_catalog_counts(spark, sf):
    """The columns that a CSV's header names, in its order, with how many values each has."""
    path = scratch_dir(spark, "catalog-csv")
    sinks.write_table(_hourly(spark, sf), path)
    df = tables.read_table(spark, path, time_col=None)
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    named = counts.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column_name", "n_values")
    return tables.column_catalog(df).join(named, "column_name").select("pos", "column_name", "n_values")


SQL_CATALOG_COUNTS = f"WITH hw AS ({HOURLY_WIDE_SQL})\n" + " UNION ALL ".join(
    f"SELECT {i} AS pos, '{c}' AS column_name, count({q(c)}) AS n_values FROM hw" for i, c in enumerate(RAW))


# ---------------------------------------------------------------------------
# writers
# ---------------------------------------------------------------------------

def q_selected_csv_roundtrip(spark, sf):
    """The 18 selected columns, a helper column dropped -> CSV with ISO times -> read strictly."""
    path = scratch_dir(spark, "selected-csv")
    selected = features.select_features(suite.feature_table(spark, sf)).withColumn("helper", F.to_date("datetime"))
    sinks.write_table(selected.drop("helper"), path)
    return finish(tables.read_table(spark, path, schema=selection_schema()))


def q_publish_orders(spark, sf):
    """Orders published to a URI of the shared file system, and read from there."""
    uri = scratch_dir(spark, "published")
    sinks.publish(table(spark, sf, "orders").select(*suite.ORDERS_COLS), uri, fmt="parquet", time_col="o_orderdate",
                  sort="within")
    return finish(tables.read_table(spark, uri, fmt="parquet", time_col="o_orderdate"))


SQL_PUBLISH_ORDERS = f"WITH {suite.ORDERS_SPLIT_SQL} SELECT {suite.ORDERS_OUT_SQL} FROM o"


# ---------------------------------------------------------------------------
# load guards
# ---------------------------------------------------------------------------

def _guarded(spark, existing: DataFrame, merge: Callable, path: str, **kw) -> tuple[dict, bool]:
    """The counts of a load, and whether it was written."""
    try:
        return replace_guarded(spark, existing, merge, path, fmt="parquet", time_col=None, **kw), True
    except GuardError as refused:
        return refused.stats, False


def q_load_guards(spark, sf):
    """What each guard decides on a load of orders: append, refuse to shrink, refuse an unreadable target, skip."""
    _, existing, batch = suite._orders_split(spark, sf)
    path = scratch_dir(spark, "guarded-orders")
    sinks.write_table(existing, path, fmt="parquet", time_col=None)

    def held() -> DataFrame:
        return spark.read.parquet(path)

    key = ["o_orderkey"]
    append = _guarded(spark, held(), lambda seen: incremental.upsert(seen, batch, keys=key, time_col=None), path)
    shrink = _guarded(spark, held(), lambda seen: seen.join(existing.select(*key), key, "left_semi"), path)
    spoilt = _spoilt_csv(spark, sf)
    target = spark.read.schema(tables.raw_schema()).option("header", True).csv(spoilt)
    bad = F.col("datetime").isNotNull() & parse_time("datetime", fixed.FMT_ISO, "null").isNull()
    unreadable = _guarded(spark, target, lambda seen: incremental.upsert(seen, target.limit(0)), scratch_dir(spark, "reread"),
                          never={"unreadable time": bad})
    nothing_new = not incremental.has_rows(incremental.new_rows(existing, existing, key, "o_orderdate"))
    n = append[0]["rows_before"]
    same = {"rows_before": n, "rows_after": n, "rows_added": 0, "changed": False}
    steps = (("append", *append), ("shrink", *shrink), ("unreadable", same, unreadable[1]), ("nothing new", same, not nothing_new))
    return spark.createDataFrame(
        [(step, s["rows_before"], s["rows_after"], s["rows_added"], s["changed"], written) for step, s, written in steps],
        "step string, rows_before long, rows_after long, rows_added long, changed boolean, written boolean")


SQL_LOAD_GUARDS = f"""
WITH {suite.ORDERS_SPLIT_SQL},
n AS (SELECT (SELECT count(*) FROM existing) AS b,
             (SELECT count(*) FROM (SELECT o_orderkey FROM existing UNION SELECT o_orderkey FROM batch)) AS a),
s AS (SELECT 'append' AS step, b AS rows_before, a AS rows_after, true AS written FROM n
      UNION ALL SELECT 'shrink', a, b, a = b FROM n
      UNION ALL SELECT 'unreadable', b, b, false FROM n
      UNION ALL SELECT 'nothing new', b, b, false FROM n)
SELECT step, rows_before, rows_after, rows_after - rows_before AS rows_added, rows_before <> rows_after AS changed, written
FROM s
"""


def q_yesterday_events(spark, sf):
    """Events of the day before the last one, by type."""
    events = table(spark, sf, "events")
    first, last = day_window(incremental.watermark(events, "ts"))
    day = F.to_date("ts")
    return events.where((day >= first) & (day <= last)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


SQL_YESTERDAY_EVENTS = """
SELECT event_type, count(*) AS n FROM events
WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) - 1 FROM events) GROUP BY event_type
"""


# ---------------------------------------------------------------------------
# reports
# ---------------------------------------------------------------------------

REPORT_COLUMNS = ["feature", "pos", "n_recent", "n_baseline", "mean_shift", "variance_shift", "ks_statistic",
                  "is_significant", "drift_type"]


def q_drift_empty_baseline(spark, sf):
    """Only the last days of line items: the baseline has no rows, so no shift is measured."""
    li = suite._lineitem(spark, sf)
    recent = li.where(F.col(suite.LI_TIME) > incremental.watermark(li, suite.LI_TIME) -
                      F.expr(f"INTERVAL {fixed.RECENT_DAYS} DAYS"))
    return finish(drift.drift_report(recent, suite.LI_TIME, suite.DRIFT_FEATURES_LI).select(*REPORT_COLUMNS))


SQL_DRIFT_EMPTY_BASELINE = f"""
WITH r AS (SELECT * FROM lineitem
           WHERE {suite.LI_TIME} > (SELECT max({suite.LI_TIME}) FROM lineitem) - INTERVAL {fixed.RECENT_DAYS} DAYS)
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {i} AS pos, count({c}) AS n_recent, 0::BIGINT AS n_baseline, 0::DOUBLE AS mean_shift, "
    "0::DOUBLE AS variance_shift, 0::DOUBLE AS ks_statistic, false AS is_significant, 'no_drift' AS drift_type FROM r"
    for i, c in enumerate(suite.DRIFT_FEATURES_LI))


def q_drift_nothing_to_say(spark, sf):
    """The summary where nothing passes the thresholds: its fixed text."""
    return drift.summary_lines(suite._drift_report_li(spark, sf, threshold=1e9, ks=1.0))


SQL_DRIFT_NOTHING_TO_SAY = suite._report_sql(1e9, 1.0) + f"""
SELECT CASE WHEN count(*) FILTER (is_significant) = 0 THEN '{fixed.NO_DRIFT_TEXT}' END AS summary FROM lab
"""


def q_remaining_features(spark, sf):
    """Requested features that the catalog doesn't have under any name."""
    done = suite._matches(spark, sf).where(F.col("status") == fixed.STATUS_EXISTS)
    return discovery.remaining(suite.requested_features(spark, sf), done)


SQL_REMAINING_FEATURES = f"""
WITH {suite.REQUESTED_SQL}, {suite.SCORES_SQL}
SELECT pos, feature FROM req
WHERE feature NOT IN (SELECT feature FROM mt WHERE status = '{fixed.STATUS_EXISTS}')
"""


def _discovery_report(spark, sf) -> str:
    path = scratch_dir(spark, "discovery-report")
    d = materialize(suite._dispositions(spark, sf), "dispositions")
    header = discovery.report_header(d, suite.column_names(spark, sf), RUN_AT, "part", LOCATION)
    return sinks.write_disposition_report(discovery.disposition_report(d), header, path,
                                          mappings=discovery.detailed_mappings(d))


SCORES_TEXT = ("array_join(transform(array_sort(map_entries(similarity_scores)), "
               "e -> concat(e.key, '=', format_string('%.4f', e.value))), ';')")


def q_discovery_report(spark, sf):
    """The three result lists of the discovery report, each with its own fields, from its files."""
    path = f"{_discovery_report(spark, sf)}/results"
    back = spark.read.schema(
        "category string, original_feature string, confidence double, reasoning string, mapped_to string, "
        f"similarity_scores map<string, double>, api_details {discovery.CANDIDATE_TYPE}, api_details_json string, "
        "search_attempts int, suggested_alternatives array<string>").json(path)
    return finish(back.selectExpr(
        "category", "original_feature", "confidence", "reasoning", "mapped_to", f"{SCORES_TEXT} AS scores",
        "api_details.name AS api_name", "api_details_json", "search_attempts",
        "array_join(suggested_alternatives, ',') AS suggested_alternatives"))


SQL_DISCOVERY_REPORT = f"""
WITH {suite.REQUESTED_SQL}, {suite.SCORES_SQL}, {suite.ATTEMPTS_SQL}, {suite.DISP_SQL},
c AS (SELECT *, CASE WHEN normalization_status = '{fixed.STATUS_EXISTS}' THEN '{fixed.CATEGORY_EXISTING}'
                     WHEN api_found THEN '{fixed.CATEGORY_NEW}' ELSE '{fixed.CATEGORY_NOT_FOUND}' END AS category FROM disp)
SELECT category, original_feature,
       round(CASE WHEN category = '{fixed.CATEGORY_EXISTING}' THEN normalization_confidence
                  ELSE confidence_score END, 6) AS confidence,
       reason AS reasoning, CASE WHEN category = '{fixed.CATEGORY_EXISTING}' THEN mapped_to END AS mapped_to,
       CASE WHEN category = '{fixed.CATEGORY_EXISTING}' THEN scores END AS scores,
       CASE WHEN category = '{fixed.CATEGORY_NEW}' THEN api_name END AS api_name,
       CASE WHEN category = '{fixed.CATEGORY_NEW}' THEN api_details_json END AS api_details_json,
       CASE WHEN category <> '{fixed.CATEGORY_EXISTING}' THEN search_attempts END AS search_attempts,
       CASE WHEN category = '{fixed.CATEGORY_NOT_FOUND}' THEN alternatives END AS suggested_alternatives
FROM c
"""


def q_discovery_mappings(spark, sf):
    """The report's detailed mappings, all 13 fields, from its files."""
    back = spark.read.schema(discovery.mapping_schema()).json(f"{_discovery_report(spark, sf)}/detailed_feature_mappings")
    shown = {"similarity_scores": f"{SCORES_TEXT} AS scores", "search_keywords": "array_join(search_keywords, ',') AS keywords",
             "api_details": "api_details.name AS api_name",
             "suggested_alternatives": "array_join(suggested_alternatives, ',') AS alternatives"}
    return finish(back.selectExpr(*[shown.get(f, f) for f in fixed.MAPPING_FIELDS]))


SQL_DISCOVERY_MAPPINGS = f"""
WITH {suite.REQUESTED_SQL}, {suite.SCORES_SQL}, {suite.ATTEMPTS_SQL}, {suite.DISP_SQL}
SELECT original_feature, normalization_status, mapped_to, scores,
       round(normalization_confidence, 6) AS normalization_confidence, keywords, api_found, api_name,
       round(confidence_score, 6) AS confidence_score, reason, alternatives, search_attempts, final_status
FROM disp
"""


def q_discovery_metadata(spark, sf):
    """The discovery report's nested metadata, from its file: time, place, source, counts and rates."""
    path = f"{_discovery_report(spark, sf)}/metadata"
    back = spark.read.schema(
        "timestamp string, location struct<lat: double, lon: double, city: string, country: string>, "
        "total_features_processed long, csv_file_analyzed string, csv_columns_count long, processing_summary struct<"
        "total_features: long, already_exists: long, new_apis_found: long, not_found: long, already_exists_rate: double, "
        "api_discovery_rate: double, overall_success_rate: double>").json(path)
    return finish(back.selectExpr("processing_summary.*", "csv_columns_count AS total_columns", "timestamp AS run_at",
                                  "location.lat", "location.city", "total_features_processed", "csv_file_analyzed"))


SQL_DISCOVERY_METADATA = f"""
SELECT *, (SELECT count(*) FROM part) AS total_columns, '{RUN_AT}' AS run_at, {LOCATION['lat']}::DOUBLE AS lat,
       '{LOCATION['city']}' AS city, total_features AS total_features_processed, 'part' AS csv_file_analyzed
FROM ({suite.SQL_DISPOSITION_SUMMARY})
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "weather_payload_files": q_weather_payload_files,
    "raw_csv_bad_times": q_raw_csv_bad_times,
    "raw_csv_in_file_order": q_raw_csv_in_file_order,
    "time_column": q_time_column,
    "first_run_load": q_first_run_load,
    "requested_report": q_requested_report,
    "catalog_counts": q_catalog_counts,
    "selected_csv_roundtrip": q_selected_csv_roundtrip,
    "publish_orders": q_publish_orders,
    "load_guards": q_load_guards,
    "yesterday_events": q_yesterday_events,
    "drift_empty_baseline": q_drift_empty_baseline,
    "drift_nothing_to_say": q_drift_nothing_to_say,
    "remaining_features": q_remaining_features,
    "discovery_report": q_discovery_report,
    "discovery_mappings": q_discovery_mappings,
    "discovery_metadata": q_discovery_metadata,
}

ORACLE_SQL: dict[str, str] = {
    "weather_payload_files": SQL_WEATHER_PAYLOAD_FILES,
    "raw_csv_bad_times": SQL_RAW_CSV_BAD_TIMES,
    "raw_csv_in_file_order": SQL_RAW_CSV_IN_FILE_ORDER,
    "time_column": SQL_TIME_COLUMN,
    "first_run_load": SQL_FIRST_RUN_LOAD,
    "requested_report": SQL_REQUESTED_REPORT,
    "catalog_counts": SQL_CATALOG_COUNTS,
    "selected_csv_roundtrip": suite.SQL_SELECT_FEATURES,
    "publish_orders": SQL_PUBLISH_ORDERS,
    "load_guards": SQL_LOAD_GUARDS,
    "yesterday_events": SQL_YESTERDAY_EVENTS,
    "drift_empty_baseline": SQL_DRIFT_EMPTY_BASELINE,
    "drift_nothing_to_say": SQL_DRIFT_NOTHING_TO_SAY,
    "remaining_features": SQL_REMAINING_FEATURES,
    "discovery_report": SQL_DISCOVERY_REPORT,
    "discovery_mappings": SQL_DISCOVERY_MAPPINGS,
    "discovery_metadata": SQL_DISCOVERY_METADATA,
}
