"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

Every query reads whole tables (or data Spark derives from them). Outputs
are normalised for comparison: timestamps as ``yyyy-MM-dd HH:mm:ss`` text,
doubles rounded to 6 decimals, in the Spark result and in the SQL alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..functions.text import extract_json_block
from ..functions.timeparse import parse_mixed_timestamp
from ..operators import discovery, drift, features, incremental, matching
from ..session import materialize, scratch_dir
from ..sources import payload as payload_src
from ..sources import sinks, tables
from . import standins
from .standins import HOURLY_WIDE_SQL, table

# ---------------------------------------------------------------------------
# shared helpers
# ---------------------------------------------------------------------------


def _magnitude_round_sql(x: str) -> str:
    """Round by magnitude: 6 decimals below 1e3, 3 below 1e6, 0 below 1e12,
    millions below 1e18 (unchanged above), so every value keeps 9 to 12
    significant digits, well inside double precision; halves away from zero
    in plain double arithmetic; -0.0 -> 0.0. The oracle SQL applies the same
    rule (``r6``)."""
    def rnd(m: str) -> str:
        return f"signum({x}) * floor(abs({x}) * {m} + 0.5) / {m}"
    return (f"CASE WHEN abs({x}) < 1e3 THEN {rnd('1e6')} WHEN abs({x}) < 1e6 THEN {rnd('1e3')} "
            f"WHEN abs({x}) < 1e12 THEN {rnd('1e0')} WHEN abs({x}) < 1e18 THEN {rnd('1e-6')} "
            f"ELSE {x} END + 0.0")


def finish(df: DataFrame) -> DataFrame:
    """Timestamps -> text, doubles -> rounded (for order-free comparison).
    One ``selectExpr`` call: the whole projection is parsed on the JVM side."""
    out = []
    for f in df.schema.fields:
        c = f"`{f.name}`"
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(f"date_format({c}, '{fixed.FMT_ISO}') AS {c}")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(f"{_magnitude_round_sql(c)} AS {c}")
        else:
            out.append(c)
    return df.selectExpr(*out)


def q(name: str) -> str:
    return f'"{name}"'


def r6(expr: str, alias: str | None = None) -> str:
    """DuckDB twin of ``_magnitude_round_sql`` (same thresholds, C ``round``)."""
    e = f"({expr})"
    return (f"CASE WHEN abs({e}) < 1e3 THEN round({e}, 6) WHEN abs({e}) < 1e6 THEN round({e}, 3) "
            f"WHEN abs({e}) < 1e12 THEN round({e}, 0) WHEN abs({e}) < 1e18 THEN round({e} / 1e6, 0) * 1e6 "
            f"ELSE {e} END + 0.0 AS {q(alias or expr.strip(chr(34)))}")


def ts(expr: str, alias: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {q(alias)}"


# a key column with NULLs: return flag N, about half of all rows
NULLED_FLAG = "nullif(l_returnflag, 'N')"
DRIFT_FEATURES_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_TIME = "l_shipdate"
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]
# split of orders into an existing table and an overlapping later batch
OLD_DAYS = 365   # existing: orders older than (max date - 365 days)
NEW_DAYS = 730   # batch: orders from (max date - 730 days) on, price corrected
PRICE_FIX = 1.0


def _orders(spark, sf):
    return table(spark, sf, "orders").select(*ORDERS_COLS)


def _orders_split(spark, sf):
    o = _orders(spark, sf)
    end = incremental.watermark(o, "o_orderdate")
    existing = o.filter(F.col("o_orderdate") < F.lit(end) - F.expr(f"INTERVAL {OLD_DAYS} DAYS"))
    batch = (o.filter(F.col("o_orderdate") >= F.lit(end) - F.expr(f"INTERVAL {NEW_DAYS} DAYS"))
             .withColumn("o_totalprice", F.col("o_totalprice") + PRICE_FIX))
    return o, existing, batch


ORDERS_SPLIT_SQL = f"""
o AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders),
m AS (SELECT max(o_orderdate) AS e FROM o),
existing AS (SELECT o.* FROM o, m WHERE o_orderdate < e - INTERVAL {OLD_DAYS} DAYS),
batch AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice + {PRICE_FIX} AS o_totalprice
          FROM o, m WHERE o_orderdate >= e - INTERVAL {NEW_DAYS} DAYS)
"""

ORDERS_OUT_SQL = f"o_orderkey, o_custkey, {ts('o_orderdate', 'o_orderdate')}, {r6('o_totalprice')}"


def _hourly(spark, sf):
    return standins.hourly_wide(table(spark, sf, "events"))


# ---------------------------------------------------------------------------
# sources
# ---------------------------------------------------------------------------

def q_hourly_series(spark, sf):
    return finish(_hourly(spark, sf))


SQL_HOURLY_SERIES = f"""
WITH hw AS ({HOURLY_WIDE_SQL})
SELECT {ts('datetime', 'datetime')}, {', '.join(r6(q(c)) for c in fixed.RAW_COLUMNS[1:])} FROM hw
"""


def _field_getter(name):
    return lambda r: r[name]


def payload_text(spark, sf, fields: dict[str, str]) -> DataFrame:
    """hourly series -> one payload per day (<= 24 hours, parallel arrays under
    ``hourly``, source field names) as JSON text."""
    src = {dst: srcname for srcname, dst in fields.items()}
    per_day = _hourly(spark, sf).groupBy(F.to_date("datetime").alias("day")).agg(
        F.array_sort(F.collect_list(F.struct("datetime", *[F.col(f"`{m}`") for m in src]))).alias("rows"))
    hourly = F.struct(
        F.transform("rows", lambda r: F.date_format(r["datetime"], fixed.FMT_PAYLOAD)).alias("time"),
        *[F.transform("rows", _field_getter(m)).alias(src[m]) for m in src])
    return per_day.select(F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"))


def q_payload_explode(spark, sf):
    """A payload per day as JSON text -> parsed and exploded back."""
    parsed = payload_text(spark, sf, fixed.POLLUTANT_FIELDS).select(
        payload_src.parse_payload_text(F.col("payload"), fixed.POLLUTANT_FIELDS).alias("p")).select("p.*")
    return finish(payload_src.explode_payload(parsed, fixed.POLLUTANT_FIELDS))


SQL_PAYLOAD_EXPLODE = f"""
WITH hw AS ({HOURLY_WIDE_SQL})
SELECT {ts('datetime', 'datetime')},
       {', '.join(r6(q(c)) for c in fixed.POLLUTANT_FIELDS.values())}
FROM hw
"""

# (Spark format, DuckDB format) of the styles that order dates are written in, by order key
MIXED_STYLES = [
    (fixed.FMT_ISO, "%Y-%m-%d %H:%M:%S"), (fixed.FMT_DAY_FIRST, "%d/%m/%Y %H:%M"),
    (fixed.FMT_MONTH_FIRST, "%m/%d/%Y %H:%M"), ("dd/MM/yyyy HH:mm:ss", "%d/%m/%Y %H:%M:%S"),
    ("dd/MM/yyyy", "%d/%m/%Y"), ("d/M/yyyy H:mm", "%-d/%-m/%Y %-H:%M"),
    ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S"), ("yyyy-MM-dd", "%Y-%m-%d"),
]


def _mixed_text(c, key):
    n = len(MIXED_STYLES) + 1
    text = F.concat(F.lit("bad-"), key.cast("string"))
    for i, (fmt, _) in enumerate(MIXED_STYLES):
        text = F.when(key % n == i, F.date_format(c, fmt)).otherwise(text)
    return text


def q_mixed_time_parse(spark, sf):
    """Dates written in eight styles by order key, or garbage, moved by some
    hours so that times of day count, and parsed back, day-first first."""
    o = tables.spread(_orders(spark, sf))  # per-row text work: use every core
    when = F.expr("CAST(o_orderdate AS TIMESTAMP_NTZ) + make_dt_interval(0, o_orderkey % 24, o_orderkey % 60, 0)")
    txt = o.select("o_orderkey", _mixed_text(when, F.col("o_orderkey")).alias("time_text"))
    return finish(txt.withColumn("parsed", parse_mixed_timestamp("time_text")))


SQL_MIXED_TIME_PARSE = f"""
WITH w AS (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + to_hours(o_orderkey % 24)
                              + to_minutes(o_orderkey % 60) AS t FROM orders),
t AS (SELECT o_orderkey,
             CASE o_orderkey % {len(MIXED_STYLES) + 1}
             {' '.join(f"WHEN {i} THEN strftime(t, '{d}')" for i, (_, d) in enumerate(MIXED_STYLES))}
             ELSE 'bad-' || CAST(o_orderkey AS VARCHAR) END AS time_text
      FROM w)
SELECT o_orderkey, time_text,
       strftime(try_strptime(time_text, [
           '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%d', '%d/%m/%Y %H:%M:%S', '%d/%m/%Y %H:%M',
           '%d/%m/%Y', '%m/%d/%Y %H:%M']), '%Y-%m-%d %H:%M:%S') AS parsed
FROM t
"""


# ---------------------------------------------------------------------------
# joins, incremental loads
# ---------------------------------------------------------------------------

def _type_hours(ev: DataFrame, etype: str, prefix: str) -> DataFrame:
    from ..functions.timeparse import hour_bucket
    return (ev.filter(F.col("event_type") == etype)
            .groupBy(hour_bucket("ts").alias("datetime"))
            .agg(F.avg("value").alias(f"{prefix}_avg"), F.count(F.lit(1)).alias(f"{prefix}_n")))


def q_join_on_time(spark, sf):
    ev = table(spark, sf, "events")
    return finish(incremental.join_on_time(_type_hours(ev, "click", "click"),
                                           _type_hours(ev, "view", "view")))


SQL_JOIN_ON_TIME = f"""
WITH c AS (SELECT date_trunc('hour', ts) AS datetime, avg(value) AS click_avg, count(*) AS click_n
           FROM events WHERE event_type = 'click' GROUP BY 1),
     v AS (SELECT date_trunc('hour', ts) AS datetime, avg(value) AS view_avg, count(*) AS view_n
           FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT {ts('datetime', 'datetime')}, {r6('click_avg')}, click_n, {r6('view_avg')}, view_n
FROM c JOIN v USING (datetime)
"""


def q_new_rows_anti(spark, sf):
    o, existing, _ = _orders_split(spark, sf)
    return finish(incremental.new_rows(o, existing, keys=["o_orderkey"], time_col="o_orderdate"))


SQL_NEW_ROWS_ANTI = f"""
WITH {ORDERS_SPLIT_SQL}
SELECT {ORDERS_OUT_SQL} FROM o
WHERE NOT EXISTS (SELECT 1 FROM existing x
                  WHERE x.o_orderkey = o.o_orderkey AND x.o_orderdate = o.o_orderdate)
"""


def _upsert(spark, sf, keep):
    _, existing, batch = _orders_split(spark, sf)
    return incremental.upsert(existing, batch, keys=["o_orderkey"], time_col=None, keep=keep)


def q_upsert_keep_first(spark, sf):
    return finish(_upsert(spark, sf, "first"))


def q_upsert_keep_last(spark, sf):
    return finish(_upsert(spark, sf, "last"))


def _upsert_sql(order: str) -> str:
    return f"""
WITH {ORDERS_SPLIT_SQL},
u AS (SELECT *, 0 AS side FROM existing UNION ALL SELECT *, 1 AS side FROM batch),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY side {order}) AS rn FROM u)
SELECT {ORDERS_OUT_SQL} FROM r WHERE rn = 1
"""


def q_rows_after_watermark(spark, sf):
    o, existing, _ = _orders_split(spark, sf)
    return finish(incremental.rows_after_watermark(o, existing, time_col="o_orderdate"))


SQL_ROWS_AFTER_WATERMARK = f"""
WITH {ORDERS_SPLIT_SQL}
SELECT {ORDERS_OUT_SQL} FROM o WHERE o_orderdate > (SELECT max(o_orderdate) FROM existing)
"""


def q_load_stats(spark, sf):
    _, existing, _ = _orders_split(spark, sf)
    return incremental.load_stats(existing, _upsert(spark, sf, "first"))


SQL_LOAD_STATS = f"""
WITH {ORDERS_SPLIT_SQL},
u AS (SELECT o_orderkey FROM existing UNION SELECT o_orderkey FROM batch),
b AS (SELECT count(*) AS rows_before FROM existing),
a AS (SELECT count(*) AS rows_after FROM u)
SELECT rows_before, rows_after, rows_after - rows_before AS rows_added,
       rows_after <> rows_before AS changed FROM b, a
"""


# ---------------------------------------------------------------------------
# features
# ---------------------------------------------------------------------------

LOG_COLS_LI = ["l_tax", "l_discount", "l_quantity"]


def q_log_features(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LOG_COLS_LI)
    return finish(features.log_features(li, LOG_COLS_LI).drop(*LOG_COLS_LI))


SQL_LOG_FEATURES = f"""
SELECT l_orderkey, l_linenumber,
       {', '.join(r6(f'coalesce(ln(1 + nullif({c}, 0)), 0)', f'log_{c}') for c in LOG_COLS_LI)}
FROM lineitem
"""


def q_standard_scale(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                             *DRIFT_FEATURES_LI)
    return finish(features.standard_scale(li, DRIFT_FEATURES_LI, keys=["l_returnflag"])
                  .drop(*DRIFT_FEATURES_LI))


def _scaled_sql(c: str, part: str = "") -> str:
    over = f"OVER ({part})"
    v, m, n = f"var_pop({q(c)}) {over}", f"avg({q(c)}) {over}", f"count({q(c)}) {over}"
    eps = features.EPS
    return (f"({q(c)} - {m}) / "
            f"CASE WHEN {v} IS NULL OR {v} <= {n} * {eps} * {v} + power({n} * {m} * {eps}, 2) "
            f"OR sqrt({v}) < 10 * {eps} THEN 1 ELSE sqrt({v}) END")


SQL_STANDARD_SCALE = f"""
SELECT l_orderkey, l_linenumber, l_returnflag,
       {', '.join(r6(_scaled_sql(c, 'PARTITION BY l_returnflag'), f'scaled_{c}') for c in DRIFT_FEATURES_LI)}
FROM lineitem
"""


def q_standard_scale_null_keys(spark, sf):
    """Keyed scaling where one key, about half of the rows, is NULL: a series of its own."""
    li = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{NULLED_FLAG} AS flag",
                                                 *DRIFT_FEATURES_LI)
    return finish(features.standard_scale(li, DRIFT_FEATURES_LI, keys=["flag"]).drop(*DRIFT_FEATURES_LI))


SQL_STANDARD_SCALE_NULL_KEYS = f"""
WITH li AS (SELECT l_orderkey, l_linenumber, {NULLED_FLAG} AS flag, {', '.join(DRIFT_FEATURES_LI)} FROM lineitem)
SELECT l_orderkey, l_linenumber, flag,
       {', '.join(r6(_scaled_sql(c, 'PARTITION BY flag'), f'scaled_{c}') for c in DRIFT_FEATURES_LI)}
FROM li
"""

EVENT_LAGS = [1, 12, 24]
# rows a task in the queries that run the split plans
SPLIT_ROWS = 1000
NULLED_USER = "CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id END"


def _event_lags(spark, sf, keys, user="user_id", **plan):
    ev = table(spark, sf, "events").selectExpr("event_id", f"{user} AS user_id", "ts", "value")
    out = features.lag_features(ev, ["value"], EVENT_LAGS, keys=keys, order=["ts", "event_id"], **plan)
    return finish(out.select("event_id", "user_id", *[f"value_lag{k}" for k in EVENT_LAGS]))


def q_lag_features(spark, sf):
    return _event_lags(spark, sf, ["user_id"])


def q_lag_features_global(spark, sf):
    return _event_lags(spark, sf, [])


def q_lag_features_split(spark, sf):
    """The plan of large series: ordered ranges, positions, fan-out."""
    return _event_lags(spark, sf, ["user_id"], method="ranked", rows_per_task=SPLIT_ROWS)


def q_lag_features_global_split(spark, sf):
    return _event_lags(spark, sf, [], method="ranked", rows_per_task=SPLIT_ROWS)


def q_lag_features_null_keys(spark, sf):
    """A third of the users is NULL: one series of its own, cut into ranges."""
    return _event_lags(spark, sf, ["user_id"], NULLED_USER, method="ranked", rows_per_task=SPLIT_ROWS)


def _lag_sql(part: str, user: str = "user_id") -> str:
    lags = ", ".join(f"lag(value, {k}) OVER (PARTITION BY {part} ORDER BY ts, event_id) AS value_lag{k}"
                     if part else f"lag(value, {k}) OVER (ORDER BY ts, event_id) AS value_lag{k}"
                     for k in EVENT_LAGS)
    return f"""
WITH e AS (SELECT event_id, {user} AS user_id, ts, value FROM events),
l AS (SELECT event_id, user_id, {lags} FROM e)
SELECT event_id, user_id, {', '.join(r6(f'value_lag{k}') for k in EVENT_LAGS)} FROM l
"""


def q_calendar_features(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.col("ts").alias("datetime"))
    out = features.cyclic_features(features.calendar_features(ev), "hour")
    return finish(out.drop("datetime"))


SQL_CALENDAR_FEATURES = """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
       CASE WHEN isodow(ts) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
       round(sin(hour(ts) * (2 * pi() / 24)), 6) AS hour_sin,
       round(cos(hour(ts) * (2 * pi() / 24)), 6) AS hour_cos
FROM events
"""

FEATURE_COLUMNS = (fixed.RAW_COLUMNS + [f"log_{c}" for c in fixed.LOG_COLUMNS]
                   + [f"scaled_{c}" for c in fixed.SCALE_COLUMNS]
                   + [f"{c}_lag{k}" for c in fixed.LAG_SOURCES for k in fixed.LAGS]
                   + ["hour", "day_of_week", "is_weekend", "hour_sin", "hour_cos"]
                   + [f"{a}_{b}" for a, b in fixed.INTERACTION_PAIRS])
INT_FEATURES = {"hour", "day_of_week", "is_weekend"}


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """The 46-column feature table of the hourly series (first run: every
    hour is new; scaler fitted on all of them; lags over the whole series).

    The hourly series is read three times (scaler fit, positions, rows), so
    it is materialized once in the shared checkpoint folder first."""
    hourly = materialize(_hourly(spark, sf), "hourly-series")
    return features.build_features(hourly).select(*[F.col(f"`{c}`") for c in FEATURE_COLUMNS])


def q_feature_table(spark, sf):
    return finish(feature_table(spark, sf))


def feature_table_by_user(spark: SparkSession, sf: str) -> DataFrame:
    """One hourly series per user: scaler fitted per user, lags per user."""
    hourly = materialize(standins.hourly_wide(table(spark, sf, "events"), ["user_id"]),
                         "hourly-by-user")
    return features.build_features(hourly, keys=["user_id"]).select(
        "user_id", *[F.col(f"`{c}`") for c in FEATURE_COLUMNS])


def q_feature_table_by_user(spark, sf):
    return finish(feature_table_by_user(spark, sf))





def _feature_table_cte(key: str = "") -> str:
    part = f"PARTITION BY {key}" if key else ""
    lag_over = f"OVER ({part} ORDER BY datetime)"
    return f"""
hw AS ({standins.hourly_wide_sql(key)}),
lg AS (SELECT *, {', '.join(f'coalesce(ln(1 + nullif({q(c)}, 0)), 0) AS {q("log_" + c)}' for c in fixed.LOG_COLUMNS)}
       FROM hw),
sc AS (SELECT *, {', '.join(f'{_scaled_sql(c, part)} AS {q("scaled_" + c)}' for c in fixed.SCALE_COLUMNS)}
       FROM lg),
lgd AS (SELECT *, {', '.join(f'lag({q(c)}, {k}) {lag_over} AS {q(f"{c}_lag{k}")}' for c in fixed.LAG_SOURCES for k in fixed.LAGS)}
        FROM sc),
cal AS (SELECT *, CAST(hour(datetime) AS INTEGER) AS hour,
               CAST(isodow(datetime) - 1 AS INTEGER) AS day_of_week,
               CASE WHEN isodow(datetime) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
               sin(hour(datetime) * (2 * pi() / 24)) AS hour_sin,
               cos(hour(datetime) * (2 * pi() / 24)) AS hour_cos
        FROM lgd),
ft AS (SELECT *, {', '.join(f'{q(a)} * {q(b)} AS {q(f"{a}_{b}")}' for a, b in fixed.INTERACTION_PAIRS)}
       FROM cal)
"""


def _feature_select(cols) -> str:
    parts = []
    for c in cols:
        if c == "datetime":
            parts.append(ts("datetime", "datetime"))
        elif c in INT_FEATURES:
            parts.append(q(c))
        else:
            parts.append(r6(q(c), c))
    return ", ".join(parts)


FEATURE_TABLE_CTE = _feature_table_cte()
SQL_FEATURE_TABLE = f"WITH {FEATURE_TABLE_CTE} SELECT {_feature_select(FEATURE_COLUMNS)} FROM ft"


def q_select_features(spark, sf):
    return finish(features.select_features(feature_table(spark, sf)))


SQL_SELECT_FEATURES = f"WITH {FEATURE_TABLE_CTE} SELECT {_feature_select(fixed.SELECTED_COLUMNS)} FROM ft"
SQL_FEATURE_TABLE_BY_USER = (f"WITH {_feature_table_cte('user_id')} "
                             f"SELECT user_id, {_feature_select(FEATURE_COLUMNS)} FROM ft")


def q_csv_roundtrip(spark, sf):
    """Feature table -> CSV (time as dd/MM/yyyy HH:mm) in the shared scratch
    folder -> read back with its schema and strict time format."""
    ft = feature_table(spark, sf)
    path = scratch_dir(spark, "feature-csv")
    sinks.write_table(ft, path, fmt="csv", time_format=fixed.FMT_DAY_FIRST)
    schema = T.StructType([T.StructField("datetime", T.StringType())] +
                          [T.StructField(c, T.IntegerType() if c in INT_FEATURES else T.DoubleType())
                           for c in FEATURE_COLUMNS[1:]])
    back = tables.read_table(spark, path, schema=schema, time_formats=fixed.FMT_DAY_FIRST)
    return finish(back)


# ---------------------------------------------------------------------------
# drift
# ---------------------------------------------------------------------------

def _lineitem(spark, sf):
    return table(spark, sf, "lineitem").select(LI_TIME, "l_returnflag", *DRIFT_FEATURES_LI)


def q_period_bounds(spark, sf):
    return finish(drift.period_bounds(_lineitem(spark, sf), LI_TIME))


PERIODS_SQL = f"""
m AS (SELECT max({LI_TIME}) AS e FROM lineitem),
f AS (SELECT l.*, {LI_TIME} >= e - INTERVAL {fixed.RECENT_DAYS} DAYS AND {LI_TIME} <= e AS is_recent,
             {LI_TIME} >= e - INTERVAL {fixed.RECENT_DAYS + fixed.BASELINE_DAYS} DAYS
             AND {LI_TIME} <= e - INTERVAL {fixed.RECENT_DAYS} DAYS AS is_baseline
      FROM lineitem l, m)
"""

SQL_PERIOD_BOUNDS = f"""
WITH {PERIODS_SQL}
SELECT {ts(f'min({LI_TIME})', 'data_start')}, {ts(f'max({LI_TIME})', 'data_end')},
       {ts(f'min({LI_TIME}) FILTER (WHERE is_recent)', 'recent_start')},
       {ts(f'max({LI_TIME}) FILTER (WHERE is_recent)', 'recent_end')},
       {ts(f'min({LI_TIME}) FILTER (WHERE is_baseline)', 'baseline_start')},
       {ts(f'max({LI_TIME}) FILTER (WHERE is_baseline)', 'baseline_end')},
       count(*) FILTER (WHERE is_recent) AS recent_rows,
       count(*) FILTER (WHERE is_baseline) AS baseline_rows
FROM f
"""

LONG_SQL = f"""
lv AS (SELECT feature, value, is_recent, is_baseline FROM f
       UNPIVOT (value FOR feature IN ({', '.join(DRIFT_FEATURES_LI)}))
       WHERE (is_recent OR is_baseline) AND value IS NOT NULL AND NOT isnan(value))
"""

MOMENTS_SQL = """
mo AS (SELECT feature,
              count(*) FILTER (WHERE is_recent) AS n_recent,
              count(*) FILTER (WHERE is_baseline) AS n_baseline,
              avg(value) FILTER (WHERE is_recent) AS mean_recent,
              avg(value) FILTER (WHERE is_baseline) AS mean_baseline,
              var_samp(value) FILTER (WHERE is_recent) AS var_recent,
              var_samp(value) FILTER (WHERE is_baseline) AS var_baseline
       FROM lv GROUP BY feature),
ms AS (SELECT *,
         CASE WHEN n_recent = 0 OR n_baseline = 0 THEN 0.0
              WHEN mean_baseline = 0 THEN 0.0
              ELSE abs((mean_recent - mean_baseline) / mean_baseline) END AS mean_shift,
         CASE WHEN n_recent = 0 OR n_baseline = 0 THEN 0.0
              WHEN var_baseline = 0 THEN 0.0
              ELSE abs((var_recent - var_baseline) / var_baseline) END AS variance_shift
       FROM mo)
"""

KS_SQL = """
vc AS (SELECT feature, value, count(*) FILTER (WHERE is_recent) AS c_r,
              count(*) FILTER (WHERE is_baseline) AS c_b FROM lv GROUP BY feature, value),
cdf AS (SELECT feature,
               sum(c_r) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)
                 / nullif(sum(c_r) OVER (PARTITION BY feature), 0) AS f_r,
               sum(c_b) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)
                 / nullif(sum(c_b) OVER (PARTITION BY feature), 0) AS f_b
        FROM vc),
ks AS (SELECT feature, max(abs(f_r - f_b)) AS ks_raw FROM cdf GROUP BY feature)
"""


def _drift_report_li(spark, sf, **kw):
    return drift.drift_report(_lineitem(spark, sf), LI_TIME, DRIFT_FEATURES_LI, **kw)


def q_drift_moments(spark, sf):
    r = _drift_report_li(spark, sf)
    return finish(r.select("feature", "n_recent", "n_baseline", "mean_recent", "mean_baseline",
                           "var_recent", "var_baseline", "mean_shift", "variance_shift"))


SQL_DRIFT_MOMENTS = f"""
WITH {PERIODS_SQL}, {LONG_SQL}, {MOMENTS_SQL}
SELECT feature, n_recent, n_baseline, {r6('mean_recent')}, {r6('mean_baseline')},
       {r6('var_recent')}, {r6('var_baseline')}, {r6('mean_shift')}, {r6('variance_shift')}
FROM ms
"""


def q_drift_ks(spark, sf):
    r = _drift_report_li(spark, sf)
    return finish(r.select("feature", "ks_statistic"))


def q_drift_ks_split(spark, sf):
    """The plan of large features: values cut into ordered ranges."""
    return finish(_drift_report_li(spark, sf, value_buckets=16).select("feature", "ks_statistic"))


SQL_DRIFT_KS = f"""
WITH {PERIODS_SQL}, {LONG_SQL}, {KS_SQL}
SELECT feature, round(coalesce(ks_raw, 0.0), 6) AS ks_statistic FROM ks
"""


def _classify_sql(t: float, k: float) -> str:
    return f"""
CASE WHEN coalesce(mean_shift > {t}, false) THEN 'mean_shift'
     WHEN coalesce(variance_shift > {t}, false) THEN 'variance_shift'
     WHEN coalesce(ks_statistic > {k}, false) THEN 'distribution_shift'
     ELSE 'no_drift' END"""


def _report_sql(t: float, k: float) -> str:
    pos = " ".join(f"WHEN '{f}' THEN {i}" for i, f in enumerate(DRIFT_FEATURES_LI))
    return f"""
WITH {PERIODS_SQL}, {LONG_SQL}, {MOMENTS_SQL}, {KS_SQL},
rep AS (SELECT ms.feature, mean_shift, variance_shift,
               CASE WHEN n_recent = 0 OR n_baseline = 0 THEN 0.0 ELSE coalesce(ks_raw, 0.0) END
                 AS ks_statistic,
               CASE ms.feature {pos} END AS pos
        FROM ms LEFT JOIN ks USING (feature)),
lab AS (SELECT *,
          coalesce(mean_shift > {t}, false) OR coalesce(variance_shift > {t}, false)
            OR coalesce(ks_statistic > {k}, false) AS is_significant,
          {_classify_sql(t, k)} AS drift_type
        FROM rep)
"""


SQL_DRIFT_REPORT = _report_sql(fixed.DRIFT_THRESHOLD, fixed.KS_THRESHOLD) + f"""
SELECT feature, pos, {r6('mean_shift')}, {r6('variance_shift')}, {r6('ks_statistic')},
       is_significant, drift_type FROM lab
"""


def q_drift_report(spark, sf):
    r = _drift_report_li(spark, sf)
    return finish(r.select("feature", "pos", "mean_shift", "variance_shift", "ks_statistic",
                           "is_significant", "drift_type"))


def _drift_sql(source_ctes: str, source: str, time_col: str, feats: list[str],
               t: float = fixed.DRIFT_THRESHOLD, k: float = fixed.KS_THRESHOLD) -> str:
    """Oracle SQL of ``drift_report`` over any relation (global period end)."""
    r, b = fixed.RECENT_DAYS, fixed.RECENT_DAYS + fixed.BASELINE_DAYS
    pos = " ".join(f"WHEN '{f}' THEN {i}" for i, f in enumerate(feats))
    casts = ", ".join(f"CAST({q(f)} AS DOUBLE) AS {q(f)}" for f in feats)
    return f"""
WITH {source_ctes},
dm AS (SELECT max({time_col}) AS e FROM {source}),
df AS (SELECT {time_col} >= e - INTERVAL {r} DAYS AND {time_col} <= e AS is_recent,
              {time_col} >= e - INTERVAL {b} DAYS AND {time_col} <= e - INTERVAL {r} DAYS AS is_baseline,
              {casts}
       FROM {source}, dm),
lv AS (SELECT feature, value, is_recent, is_baseline FROM df
       UNPIVOT (value FOR feature IN ({', '.join(q(f) for f in feats)}))
       WHERE (is_recent OR is_baseline) AND value IS NOT NULL AND NOT isnan(value)),
{MOMENTS_SQL}, {KS_SQL},
rep AS (SELECT ms.feature, n_recent, n_baseline, mean_shift, variance_shift,
               CASE WHEN n_recent = 0 OR n_baseline = 0 THEN 0.0 ELSE coalesce(ks_raw, 0.0) END
                 AS ks_statistic,
               CASE ms.feature {pos} END AS pos
        FROM ms LEFT JOIN ks USING (feature))
SELECT feature, pos, n_recent, n_baseline, {r6('mean_shift')}, {r6('variance_shift')},
       {r6('ks_statistic')},
       coalesce(mean_shift > {t}, false) OR coalesce(variance_shift > {t}, false)
         OR coalesce(ks_statistic > {k}, false) AS is_significant,
       {_classify_sql(t, k)} AS drift_type
FROM rep
"""


def q_drift_report_features(spark, sf):
    """The flagship: drift of all registered features of the feature table."""
    from .flagship import flagship
    return finish(flagship(spark, sf))


SQL_DRIFT_REPORT_FEATURES = _drift_sql(
    FEATURE_TABLE_CTE.strip(), "ft", "datetime",
    [f for f in fixed.DRIFT_FEATURES if f in FEATURE_COLUMNS])


# lower thresholds so that the lineitem periods do produce summary lines
SUMMARY_T, SUMMARY_KS = 0.05, 0.05


def q_drift_summary_lines(spark, sf):
    r = _drift_report_li(spark, sf, threshold=SUMMARY_T, ks=SUMMARY_KS)
    return drift.summary_lines(r)


SQL_DRIFT_SUMMARY_LINES = _report_sql(SUMMARY_T, SUMMARY_KS) + f"""
SELECT coalesce(string_agg(printf('{fixed.SUMMARY_LINE_FORMAT.replace("'", "''")}', feature, drift_type,
                                  mean_shift, variance_shift, ks_statistic), chr(10) ORDER BY pos)
                  FILTER (WHERE is_significant),
                '{fixed.NO_DRIFT_TEXT}') AS summary
FROM lab
"""


def q_drift_report_by_flag(spark, sf):
    """Keyed drift: one series per return flag, each with its own period end."""
    r = drift.drift_report(_lineitem(spark, sf), LI_TIME, DRIFT_FEATURES_LI, keys=["l_returnflag"],
                           scope="key")
    return finish(r.select("l_returnflag", "feature", "n_recent", "n_baseline", "mean_shift",
                           "variance_shift", "ks_statistic", "is_significant", "drift_type"))


KEYED_COLUMNS = ["feature", "n_recent", "n_baseline", "mean_shift", "variance_shift", "ks_statistic",
                 "is_significant", "drift_type"]


def q_drift_ks_split_by_flag(spark, sf):
    """Keyed, and its values cut into ordered ranges."""
    r = drift.drift_report(_lineitem(spark, sf), LI_TIME, DRIFT_FEATURES_LI, keys=["l_returnflag"],
                           scope="key", value_buckets=16)
    return finish(r.select("l_returnflag", *KEYED_COLUMNS))


def q_drift_report_null_keys(spark, sf):
    """Keyed drift where one key, about half of the rows, is NULL."""
    li = _lineitem(spark, sf).withColumn("l_returnflag", F.expr(NULLED_FLAG))
    r = drift.drift_report(li, LI_TIME, DRIFT_FEATURES_LI, keys=["l_returnflag"], scope="key")
    return finish(r.select("l_returnflag", *KEYED_COLUMNS))


def _keyed_drift_sql(flag: str = "l_returnflag") -> str:
    t, k = fixed.DRIFT_THRESHOLD, fixed.KS_THRESHOLD
    r, b = fixed.RECENT_DAYS, fixed.RECENT_DAYS + fixed.BASELINE_DAYS
    return f"""
WITH li AS (SELECT * REPLACE (coalesce({flag}, '-') AS l_returnflag) FROM lineitem),
m AS (SELECT l_returnflag, max({LI_TIME}) AS e FROM li GROUP BY 1),
f AS (SELECT l.*, {LI_TIME} >= e - INTERVAL {r} DAYS AND {LI_TIME} <= e AS is_recent,
             {LI_TIME} >= e - INTERVAL {b} DAYS AND {LI_TIME} <= e - INTERVAL {r} DAYS AS is_baseline
      FROM li l JOIN m USING (l_returnflag)),
lv AS (SELECT l_returnflag, feature, value, is_recent, is_baseline FROM f
       UNPIVOT (value FOR feature IN ({', '.join(DRIFT_FEATURES_LI)}))
       WHERE (is_recent OR is_baseline) AND value IS NOT NULL),
mo AS (SELECT l_returnflag, feature,
              count(*) FILTER (WHERE is_recent) AS n_recent,
              count(*) FILTER (WHERE is_baseline) AS n_baseline,
              avg(value) FILTER (WHERE is_recent) AS mr, avg(value) FILTER (WHERE is_baseline) AS mb,
              var_samp(value) FILTER (WHERE is_recent) AS vr,
              var_samp(value) FILTER (WHERE is_baseline) AS vb
       FROM lv GROUP BY 1, 2),
ms AS (SELECT *,
         CASE WHEN n_recent = 0 OR n_baseline = 0 THEN 0.0 WHEN mb = 0 THEN 0.0
              ELSE abs((mr - mb) / mb) END AS mean_shift,
         CASE WHEN n_recent = 0 OR n_baseline = 0 THEN 0.0 WHEN vb = 0 THEN 0.0
              ELSE abs((vr - vb) / vb) END AS variance_shift FROM mo),
vc AS (SELECT l_returnflag, feature, value, count(*) FILTER (WHERE is_recent) AS c_r,
              count(*) FILTER (WHERE is_baseline) AS c_b FROM lv GROUP BY 1, 2, 3),
cdf AS (SELECT l_returnflag, feature,
          sum(c_r) OVER (PARTITION BY l_returnflag, feature ORDER BY value ROWS UNBOUNDED PRECEDING)
            / nullif(sum(c_r) OVER (PARTITION BY l_returnflag, feature), 0) AS f_r,
          sum(c_b) OVER (PARTITION BY l_returnflag, feature ORDER BY value ROWS UNBOUNDED PRECEDING)
            / nullif(sum(c_b) OVER (PARTITION BY l_returnflag, feature), 0) AS f_b FROM vc),
ks AS (SELECT l_returnflag, feature, max(abs(f_r - f_b)) AS ks_raw FROM cdf GROUP BY 1, 2),
rep AS (SELECT ms.*, CASE WHEN n_recent = 0 OR n_baseline = 0 THEN 0.0
                          ELSE coalesce(ks_raw, 0.0) END AS ks_statistic
        FROM ms LEFT JOIN ks USING (l_returnflag, feature))
SELECT nullif(l_returnflag, '-') AS l_returnflag, feature, n_recent, n_baseline, {r6('mean_shift')}, {r6('variance_shift')},
       {r6('ks_statistic')},
       coalesce(mean_shift > {t}, false) OR coalesce(variance_shift > {t}, false)
         OR coalesce(ks_statistic > {k}, false) AS is_significant,
       {_classify_sql(t, k)} AS drift_type
FROM rep
"""


def q_report_json_roundtrip(spark, sf):
    """Drift report -> nested report object -> JSON in the shared scratch
    folder -> read back and flattened to one row per feature."""
    r = _drift_report_li(spark, sf)
    path = scratch_dir(spark, "drift-report")
    nested = drift.nested_report(r)
    sinks.write_report(nested, path)
    back = spark.read.schema(nested.schema).json(path)
    flat = back.select(F.explode("detailed_analysis.drift_metrics").alias("feature", "m"),
                       "seasonal_shift_detected")
    return finish(flat.select("feature", F.col("m.mean_shift").alias("mean_shift"),
                              F.col("m.variance_shift").alias("variance_shift"),
                              F.col("m.ks_statistic").alias("ks_statistic"),
                              "seasonal_shift_detected"))


SQL_REPORT_JSON_ROUNDTRIP = _report_sql(fixed.DRIFT_THRESHOLD, fixed.KS_THRESHOLD) + f"""
SELECT feature, {r6('mean_shift')}, {r6('variance_shift')}, {r6('ks_statistic')},
       (SELECT bool_or(is_significant) FROM lab) AS seasonal_shift_detected FROM lab
"""


# ---------------------------------------------------------------------------
# feature-name matching and source discovery
# ---------------------------------------------------------------------------

def requested_features(spark, sf) -> DataFrame:
    """One requested feature per part: a spelling of its name chosen by key
    (upper case + " INDEX", vowels rotated, type_brand, run together)."""
    return table(spark, sf, "part").selectExpr(
        "p_partkey AS pos",
        "CASE p_partkey % 4 WHEN 0 THEN concat(upper(p_name), ' INDEX') "
        "WHEN 1 THEN translate(p_name, 'aeiou', 'eioua') "
        "WHEN 2 THEN concat_ws('_', p_type, p_brand) "
        "ELSE regexp_replace(p_name, ' ', '') END AS feature")


REQUESTED_SQL = """
req AS (SELECT p_partkey AS pos,
               CASE p_partkey % 4 WHEN 0 THEN upper(p_name) || ' INDEX'
                                  WHEN 1 THEN translate(p_name, 'aeiou', 'eioua')
                                  WHEN 2 THEN p_type || '_' || p_brand
                                  ELSE replace(p_name, ' ', '') END AS feature
        FROM part),
cat AS (SELECT DISTINCT p_name AS column_name FROM part)
"""


def column_names(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_name").alias("column_name"))


def _norm_sql(x: str) -> str:
    suf = "|".join(fixed.NAME_SUFFIXES)
    return (f"regexp_replace(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', '_', 'g'), "
            f"'^_+|_+$', '', 'g'), '_({suf})$', '')")


def _alias_values() -> str:
    rows = [(c, a) for c, al in fixed.ALIASES.items() for a in al]
    return ", ".join(f"('{c}', '{a}')" for c, a in rows)


SCORES_SQL = f"""
al AS (SELECT replace({_norm_sql('c')}, '_', '') AS a, replace({_norm_sql('a')}, '_', '') AS b
       FROM (VALUES {_alias_values()}) v(c, a)),
ap AS (SELECT a, b FROM al UNION SELECT b, a FROM al),
rq AS (SELECT *, list_filter(string_split(rn, '_'), lambda t: t <> '') AS rt
       FROM (SELECT DISTINCT feature, {_norm_sql('feature')} AS rn FROM req)),
ct AS (SELECT *, list_filter(string_split(cn, '_'), lambda t: t <> '') AS ct
       FROM (SELECT column_name, {_norm_sql('column_name')} AS cn FROM cat)),
pairs AS (SELECT feature, column_name, rn, cn, rt, ct, levenshtein(rn, cn) AS lev FROM rq, ct),
sc AS (SELECT feature, column_name,
         greatest(CASE WHEN replace(rn, '_', '') = replace(cn, '_', '') THEN {fixed.EXACT_SCORE} END,
                  CASE WHEN EXISTS (SELECT 1 FROM ap WHERE ap.a = replace(rn, '_', '')
                                                       AND ap.b = replace(cn, '_', ''))
                       THEN {fixed.ALIAS_SCORE} END,
                  CASE WHEN lev <= 2 OR list_has_any(rt, ct) THEN least({fixed.FUZZY_CAP},
                       1.0 - lev / greatest(length(rn), length(cn), 1)) END) AS score
       FROM pairs),
top AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY score DESC, column_name) AS rank
        FROM sc WHERE score IS NOT NULL),
best AS (SELECT feature, max(score) AS score, arg_min(column_name, rank) AS best FROM top
         WHERE rank <= {fixed.TOP_N_SCORES} GROUP BY feature),
mt AS (SELECT req.pos, req.feature,
              CASE WHEN coalesce(best.score > {fixed.SIMILARITY_THRESHOLD}, false)
                   THEN '{fixed.STATUS_EXISTS}' ELSE '{fixed.STATUS_MISSING}' END AS status,
              CASE WHEN coalesce(best.score > {fixed.SIMILARITY_THRESHOLD}, false)
                   THEN best.best END AS mapped_to,
              coalesce(best.score, 0.0) AS confidence
       FROM req LEFT JOIN best USING (feature))
"""


def _matches(spark, sf):
    return matching.match_features(requested_features(spark, sf), column_names(spark, sf))


def q_match_features(spark, sf):
    return finish(_matches(spark, sf).select("pos", "feature", "status", "mapped_to", "confidence"))


SQL_MATCH_FEATURES = f"""
WITH {REQUESTED_SQL}, {SCORES_SQL}
SELECT pos, feature, status, mapped_to, round(confidence, 6) AS confidence FROM mt
"""


def q_match_candidates(spark, sf):
    c = matching.top_candidates(matching.match_candidates(requested_features(spark, sf), column_names(spark, sf)))
    return finish(c.select("feature", "column_name", "score", F.col("rank").cast("int").alias("rank")))


def q_match_top_columns(spark, sf):
    """The same rows without scoring every pair."""
    c, _ = matching.top_matches(requested_features(spark, sf), column_names(spark, sf))
    return finish(c.select("feature", "column_name", "score", F.col("rank").cast("int").alias("rank")))


SQL_MATCH_CANDIDATES = f"""
WITH {REQUESTED_SQL}, {SCORES_SQL}
SELECT feature, column_name, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
FROM top WHERE rank <= {fixed.TOP_N_SCORES}
"""

PROBE_STATUSES = [200, 401, 403, 404, 410, 500, 301]


def probes(spark, sf) -> DataFrame:
    """One probe per page: candidate from the page URL (ftp for some, none for
    some), an endpoint, and an outcome/status picked by page id."""
    statuses = ", ".join(map(str, PROBE_STATUSES))
    return table(spark, sf, "pages").selectExpr(
        "page_id",
        "CASE WHEN page_id % 13 = 0 THEN NULL ELSE named_struct("
        "'name', concat('page ', CAST(page_id AS STRING)), "
        "'url', CASE WHEN page_id % 11 = 0 THEN regexp_replace(url, '^https?', 'ftp') ELSE url END, "
        "'endpoint', CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN '/api/v1' ELSE 'data/' END) "
        "END AS candidate_api",
        "CASE page_id % 10 WHEN 7 THEN 'timeout' WHEN 8 THEN 'connection' "
        "WHEN 9 THEN 'request_error' ELSE 'http' END AS outcome",
        f"element_at(array({statuses}), CAST(page_id % {len(PROBE_STATUSES)} + 1 AS INT)) AS http_status",
        "'read timed out' AS detail")


def q_classify_probes(spark, sf):
    c = discovery.classify_probes(probes(spark, sf))
    return c.select("page_id", "is_valid", "reason", "probe_url")


def _url_sql() -> str:
    return "CASE WHEN page_id % 11 = 0 THEN regexp_replace(url, '^https?', 'ftp') ELSE url END"


SQL_CLASSIFY_PROBES = f"""
WITH p AS (
  SELECT page_id, page_id % 13 <> 0 AS has_cand, {_url_sql()} AS curl,
         CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN '/api/v1' ELSE 'data/' END AS endpoint,
         CASE page_id % 10 WHEN 7 THEN 'timeout' WHEN 8 THEN 'connection'
                           WHEN 9 THEN 'request_error' ELSE 'http' END AS outcome,
         ([{', '.join(map(str, PROBE_STATUSES))}])[page_id % {len(PROBE_STATUSES)} + 1] AS http_status
  FROM pages),
c AS (SELECT *, coalesce(curl LIKE 'http://%' OR curl LIKE 'https://%', false) AS good_url FROM p)
SELECT page_id,
       coalesce(has_cand AND good_url AND outcome = 'http' AND http_status IN (200, 401, 403), false)
         AS is_valid,
       CASE WHEN NOT has_cand THEN '{fixed.REASON_NO_CANDIDATE}'
            WHEN NOT good_url THEN '{fixed.REASON_BAD_URL}'
            WHEN outcome = 'http' AND http_status = 200 THEN NULL
            WHEN outcome = 'http' AND http_status = 401 THEN '{fixed.REASON_401}'
            WHEN outcome = 'http' AND http_status = 403 THEN '{fixed.REASON_403}'
            WHEN outcome = 'http' AND http_status IN (404, 410)
              THEN printf('{fixed.REASON_NOT_FOUND}', http_status)
            WHEN outcome = 'http' THEN printf('{fixed.REASON_UNEXPECTED}', http_status)
            WHEN outcome = 'timeout' THEN '{fixed.REASON_TIMEOUT}'
            WHEN outcome = 'connection' THEN '{fixed.REASON_CONNECTION}'
            WHEN outcome = 'request_error' THEN printf('{fixed.REASON_REQUEST}', 'read timed out')
            ELSE printf('{fixed.REASON_OTHER}', 'read timed out') END AS reason,
       CASE WHEN has_cand THEN
         CASE WHEN endpoint = '' THEN curl
              ELSE regexp_replace(curl, '/+$', '') || '/' || regexp_replace(endpoint, '^/+', '') END
       END AS probe_url
FROM c
"""

HTTP_FOR = {"click": "http", "purchase": "http", "signup": "http", "view": "timeout",
            "error": "connection"}
ATTEMPT_STATUSES = [200, 401, 403, 404, 410, 500]


def attempt_log(spark, sf) -> DataFrame:
    """events as a source-search log: feature = user id, attempts in time
    order (only the first ``MAX_ATTEMPTS`` are ever used; the top-k per key
    is limited map-side), response text and probe outcome from the event."""
    statuses = ", ".join(map(str, ATTEMPT_STATUSES))
    outcome = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in HTTP_FOR.items())
    first = (table(spark, sf, "events")
             .withColumn("attempt_no", F.expr("row_number() OVER (PARTITION BY user_id "
                                              "ORDER BY ts, event_id)"))
             .where(f"attempt_no <= {fixed.MAX_ATTEMPTS}")
             .selectExpr("*", "CAST(user_id AS STRING) AS uid",
                         "concat('0.', lpad(CAST(floor(value) % 100 AS STRING), 2, '0')) AS conf",
                         "CASE WHEN event_type = 'view' THEN 'ftp' ELSE 'https' END AS scheme"))
    body = ("concat('{\"search_keywords\": [\"', event_type, '\", \"u', uid, "
            "'\"], \"candidate_api\": {\"name\": \"source ', uid, '\", \"url\": \"', scheme, "
            "'://api.example.com/u', uid, '\", \"endpoint\": \"/v1/', event_type, "
            "'\", \"params\": [\"', event_type, '\", \"hour\"], \"coverage_notes\": {\"area\": \"u', uid, "
            "'\"}}, \"confidence\": ', conf, '}')")
    text = (f"CASE event_id % 4 WHEN 0 THEN concat('```json\\n', {body}, '\\n```') "
            f"WHEN 1 THEN concat('Found one: ', {body}, ' (checked)') "
            "WHEN 2 THEN concat('{\"search_keywords\": [], \"candidate_api\": null, "
            "\"confidence\": 0.0, \"reason\": \"nothing suitable\", \"suggestions\": [\"other ', event_type, '\", \"none\"]}') "
            "ELSE concat('no answer for ', event_type) END")
    return first.selectExpr(
        "user_id AS feature", "attempt_no", f"{text} AS response_text",
        f"CASE event_type {outcome} ELSE 'other' END AS outcome",
        f"element_at(array({statuses}), CAST(floor(value) % {len(ATTEMPT_STATUSES)} + 1 AS INT)) "
        "AS http_status",
        "'bad response' AS detail")


def q_resolve_attempts(spark, sf):
    r = discovery.resolve_attempts(attempt_log(spark, sf))
    return finish(r.select("feature", "api_found", F.col("api_details.name").alias("api_name"), "api_url",
                           "confidence_score", F.array_join("search_keywords", ",").alias("keywords"),
                           "reason", "search_attempts"))


ATTEMPTS_SQL = f"""
ev AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt_no FROM events),
a0 AS (
  SELECT user_id AS feature, attempt_no, event_type AS et, CAST(user_id AS VARCHAR) AS uid, event_id,
         '0.' || lpad(CAST(CAST(floor(value) AS BIGINT) % 100 AS VARCHAR), 2, '0') AS conf,
         CASE WHEN event_type = 'view' THEN 'ftp' ELSE 'https' END AS scheme,
         CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in HTTP_FOR.items())}
              ELSE 'other' END AS outcome,
         ([{', '.join(map(str, ATTEMPT_STATUSES))}])[CAST(floor(value) AS BIGINT) % {len(ATTEMPT_STATUSES)} + 1]
           AS http_status
  FROM ev WHERE attempt_no <= {fixed.MAX_ATTEMPTS}),
a1 AS (
  SELECT *, '{{"search_keywords": ["' || et || '", "u' || uid || '"], "candidate_api": '
            || '{{"name": "source ' || uid || '", "url": "' || scheme || '://api.example.com/u' || uid
            || '", "endpoint": "/v1/' || et || '", "params": ["' || et || '", "hour"], "coverage_notes": {{"area": "u'
            || uid || '"}}}}, "confidence": ' || conf || '}}' AS body
  FROM a0),
a2 AS (
  SELECT *, CASE event_id % 4 WHEN 0 THEN '```json' || chr(10) || body || chr(10) || '```'
                              WHEN 1 THEN 'Found one: ' || body || ' (checked)'
                              WHEN 2 THEN '{{"search_keywords": [], "candidate_api": null, "confidence": 0.0, "reason": "nothing suitable", "suggestions": ["other ' || et || '", "none"]}}'
                              ELSE 'no answer for ' || et END AS response_text
  FROM a1),
a3 AS (
  SELECT *, CASE WHEN instr(response_text, '```json') > 0
                   THEN regexp_replace(regexp_extract(regexp_replace(response_text, '^\\s+|\\s+$', '', 'g'), '(?s)```json(.*?)(```|\\z)', 1), '^\\s+|\\s+$', '', 'g')
                 WHEN instr(response_text, '{{') > 0
                   THEN nullif(regexp_extract(regexp_replace(response_text, '^\\s+|\\s+$', '', 'g'), '(?s)(\\{{.*\\}})', 1), '')
                 ELSE regexp_replace(response_text, '^\\s+|\\s+$', '', 'g') END AS block
  FROM a2),
a4 AS (
  SELECT *, coalesce(json_valid(block), false) AS parse_ok FROM a3),
a5 AS (
  SELECT *,
    CASE WHEN parse_ok THEN json_extract(block, '$.candidate_api') END AS cand_j,
    CASE WHEN parse_ok THEN coalesce(CAST(json_extract(block, '$.confidence') AS DOUBLE), 0.0) END AS conf_p,
    CASE WHEN parse_ok THEN coalesce(array_to_string(CAST(json_extract(block, '$.search_keywords') AS VARCHAR[]), ','), '') END AS kw_p,
    CASE WHEN parse_ok THEN coalesce(array_to_string(CAST(json_extract(block, '$.suggestions') AS VARCHAR[]), ','), '') END AS sg_p
  FROM a4),
a6 AS (
  SELECT *,
    last_value(CASE WHEN parse_ok THEN {{'v': cand_j}} END IGNORE NULLS)
      OVER (PARTITION BY feature ORDER BY attempt_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cand_w,
    last_value(conf_p IGNORE NULLS)
      OVER (PARTITION BY feature ORDER BY attempt_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS conf_w,
    last_value(kw_p IGNORE NULLS)
      OVER (PARTITION BY feature ORDER BY attempt_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS kw_w,
    last_value(sg_p IGNORE NULLS)
      OVER (PARTITION BY feature ORDER BY attempt_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sg_w
  FROM a5),
a7 AS (
  SELECT feature, attempt_no, outcome, http_status, coalesce(conf_w, 0.0) AS confidence,
         coalesce(kw_w, '') AS keywords, coalesce(sg_w, '') AS suggested,
         CASE WHEN cand_w.v IS NULL OR json_type(cand_w.v) = 'NULL' THEN NULL ELSE cand_w.v END AS cand
  FROM a6),
a8 AS (
  SELECT *, cand IS NOT NULL AS has_cand,
         json_extract_string(cand, '$.url') AS curl, json_extract_string(cand, '$.endpoint') AS endpoint,
         json_extract_string(cand, '$.name') AS cname FROM a7),
a9 AS (
  SELECT *, coalesce(curl LIKE 'http://%' OR curl LIKE 'https://%', false) AS good_url FROM a8),
cl AS (
  SELECT *,
    coalesce(has_cand AND good_url AND outcome = 'http' AND http_status IN (200, 401, 403), false) AS is_valid,
    CASE WHEN NOT has_cand THEN '{fixed.REASON_NO_CANDIDATE}'
         WHEN NOT good_url THEN '{fixed.REASON_BAD_URL}'
         WHEN outcome = 'http' AND http_status = 200 THEN NULL
         WHEN outcome = 'http' AND http_status = 401 THEN '{fixed.REASON_401}'
         WHEN outcome = 'http' AND http_status = 403 THEN '{fixed.REASON_403}'
         WHEN outcome = 'http' AND http_status IN (404, 410) THEN printf('{fixed.REASON_NOT_FOUND}', http_status)
         WHEN outcome = 'http' THEN printf('{fixed.REASON_UNEXPECTED}', http_status)
         WHEN outcome = 'timeout' THEN '{fixed.REASON_TIMEOUT}'
         WHEN outcome = 'connection' THEN '{fixed.REASON_CONNECTION}'
         WHEN outcome = 'request_error' THEN printf('{fixed.REASON_REQUEST}', 'bad response')
         ELSE printf('{fixed.REASON_OTHER}', 'bad response') END AS reason,
    CASE WHEN has_cand THEN
      CASE WHEN coalesce(endpoint, '') = '' THEN curl
           ELSE regexp_replace(curl, '/+$', '') || '/' || regexp_replace(endpoint, '^/+', '') END
    END AS probe_url
  FROM a9),
fv AS (SELECT *, min(CASE WHEN is_valid THEN attempt_no END) OVER (PARTITION BY feature) AS first_valid FROM cl),
used AS (SELECT * FROM fv WHERE first_valid IS NULL OR attempt_no <= first_valid),
res AS (
  SELECT feature, count(*) AS search_attempts, arg_max(is_valid, attempt_no) AS api_found,
         arg_max(CASE WHEN is_valid THEN cname END, attempt_no) AS api_name,
         arg_max(CASE WHEN is_valid THEN probe_url END, attempt_no) AS api_url,
         arg_max({{'j': CASE WHEN is_valid THEN CAST(cand AS VARCHAR) END}}, attempt_no).j AS api_json,
         arg_max(suggested, attempt_no) AS suggested,
         arg_max(confidence, attempt_no) AS confidence_score, arg_max(keywords, attempt_no) AS keywords,
         arg_max({{'r': reason}}, attempt_no).r AS reason
  FROM used GROUP BY feature)
"""

SQL_RESOLVE_ATTEMPTS = f"""
WITH {ATTEMPTS_SQL}
SELECT feature, api_found, api_name, api_url, round(confidence_score, 6) AS confidence_score, keywords,
       reason, CAST(search_attempts AS INTEGER) AS search_attempts FROM res
"""


def _dispositions(spark, sf):
    m = _matches(spark, sf)
    r = discovery.resolve_attempts(attempt_log(spark, sf))
    d = discovery.dispositions(m.withColumnRenamed("feature", "original_feature"),
                               r.withColumnRenamed("feature", "pos"), key="pos")
    return discovery.categorize(d)


def q_dispositions(spark, sf):
    d = _dispositions(spark, sf)
    return finish(d.select("pos", "original_feature", "normalization_status", "mapped_to",
                           "normalization_confidence", "api_found",
                           F.col("api_details.name").alias("api_name"), "api_details_json", "api_url",
                           F.expr("array_join(transform(array_sort(map_entries(similarity_scores)), "
                                  "e -> concat(e.key, '=', format_string('%.4f', e.value))), ';')").alias("scores"),
                           F.array_join("search_keywords", ",").alias("keywords"),
                           F.array_join("suggested_alternatives", ",").alias("alternatives"),
                           "confidence_score", "reason",
                           "search_attempts", "final_status", "category", "report_confidence"))


DISP_SQL = f"""
dj AS (
  SELECT mt.pos, mt.feature AS original_feature, mt.status AS normalization_status, mt.mapped_to,
         mt.confidence AS normalization_confidence, mt.status = '{fixed.STATUS_MISSING}' AS missing,
         res.api_found AS r_found, res.api_name AS r_name, res.confidence_score AS r_conf,
         res.reason AS r_reason, res.search_attempts AS r_att, res.api_json, res.api_url AS r_url,
         res.keywords AS r_keywords, res.suggested, coalesce(ss.scores, '') AS scores
  FROM mt LEFT JOIN res ON mt.pos = res.feature
  LEFT JOIN (SELECT feature, string_agg(column_name || '=' || printf('%.4f', score), ';' ORDER BY column_name) AS scores
             FROM top WHERE rank <= {fixed.TOP_N_SCORES} GROUP BY feature) ss ON mt.feature = ss.feature),
disp AS (
  SELECT pos, original_feature, normalization_status, mapped_to, normalization_confidence,
         missing AND coalesce(r_found, false) AS api_found,
         CASE WHEN missing AND coalesce(r_found, false) THEN r_name END AS api_name,
         CASE WHEN missing AND coalesce(r_found, false) THEN api_json END AS api_details_json,
         CASE WHEN missing AND coalesce(r_found, false) THEN r_url END AS api_url, scores,
         CASE WHEN missing THEN coalesce(r_keywords, '') ELSE '' END AS keywords,
         CASE WHEN missing AND NOT coalesce(r_found, false) THEN coalesce(suggested, '') ELSE '' END AS alternatives,
         CASE WHEN missing THEN coalesce(r_conf, 0.0) ELSE 0.0 END AS confidence_score,
         CASE WHEN normalization_status = '{fixed.STATUS_EXISTS}' THEN '{fixed.REASON_EXISTS}'
              WHEN missing THEN coalesce(r_reason, CASE WHEN NOT (missing AND coalesce(r_found, false))
                                                        THEN '{fixed.REASON_MISSING}' END) END AS reason,
         CAST(CASE WHEN missing THEN coalesce(r_att, 0) ELSE 0 END AS INTEGER) AS search_attempts,
         CASE WHEN normalization_status = '{fixed.STATUS_EXISTS}' THEN '{fixed.STATUS_EXISTS}'
              WHEN missing AND coalesce(r_found, false) THEN '{fixed.FINAL_FOUND}'
              ELSE '{fixed.FINAL_NOT_FOUND}' END AS final_status
  FROM dj)
"""

SQL_DISPOSITIONS = f"""
WITH {REQUESTED_SQL}, {SCORES_SQL}, {ATTEMPTS_SQL}, {DISP_SQL}
SELECT pos, original_feature, normalization_status, mapped_to,
       round(normalization_confidence, 6) AS normalization_confidence, api_found, api_name, api_details_json,
       api_url, scores, keywords, alternatives,
       round(confidence_score, 6) AS confidence_score, reason, search_attempts, final_status,
       CASE WHEN normalization_status = '{fixed.STATUS_EXISTS}' THEN '{fixed.CATEGORY_EXISTING}'
            WHEN api_found THEN '{fixed.CATEGORY_NEW}' ELSE '{fixed.CATEGORY_NOT_FOUND}' END AS category,
       round(CASE WHEN normalization_status = '{fixed.STATUS_EXISTS}' THEN normalization_confidence
                  ELSE confidence_score END, 6) AS report_confidence
FROM disp
"""


def q_disposition_summary(spark, sf):
    return finish(discovery.disposition_summary(_dispositions(spark, sf)))


SQL_DISPOSITION_SUMMARY = f"""
WITH {REQUESTED_SQL}, {SCORES_SQL}, {ATTEMPTS_SQL}, {DISP_SQL},
s AS (SELECT count(*) AS total_features,
             count(*) FILTER (WHERE final_status = '{fixed.STATUS_EXISTS}') AS already_exists,
             count(*) FILTER (WHERE final_status = '{fixed.FINAL_FOUND}') AS new_apis_found
      FROM disp)
SELECT total_features, already_exists, new_apis_found,
       total_features - already_exists - new_apis_found AS not_found,
       round(coalesce(already_exists / nullif(total_features, 0) * 100, 0), 6) AS already_exists_rate,
       round(coalesce(new_apis_found / nullif(total_features, 0) * 100, 0), 6) AS api_discovery_rate,
       round(coalesce((already_exists + new_apis_found) / nullif(total_features, 0) * 100, 0), 6)
         AS overall_success_rate
FROM s
"""


def q_extract_json_block(spark, sf):
    """events.props wrapped as a closed fence, bare JSON in text, an unclosed
    fence, or no JSON at all (by event id); block extracted and parsed."""
    ev = tables.spread(table(spark, sf, "events").select("event_id", "props"))  # per-row text work
    e = F.col("event_id") % 4
    text = (F.when(e == 0, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```")))
            .when(e == 1, F.concat(F.lit("result: "), F.col("props"), F.lit(" end")))
            .when(e == 2, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n")))
            .otherwise(F.concat(F.lit("no json: "), F.translate("props", "{}", "()"))))
    block = extract_json_block(text)
    ok = F.coalesce(F.try_parse_json(block).isNotNull(), F.lit(False))
    k = F.when(ok, F.from_json(block, "k bigint")["k"])
    return ev.select("event_id", block.alias("block"), ok.alias("parse_ok"), k.alias("k"))


SQL_EXTRACT_JSON_BLOCK = """
WITH t AS (
  SELECT event_id,
         CASE event_id % 4 WHEN 0 THEN '```json' || chr(10) || props || chr(10) || '```'
                           WHEN 1 THEN 'result: ' || props || ' end'
                           WHEN 2 THEN '```json' || chr(10) || props || chr(10)
                           ELSE 'no json: ' || translate(props, '{}', '()') END AS txt
  FROM events),
b AS (
  SELECT event_id,
         CASE WHEN instr(txt, '```json') > 0
                THEN regexp_replace(regexp_extract(regexp_replace(txt, '^\\s+|\\s+$', '', 'g'),
                     '(?s)```json(.*?)(```|\\z)', 1), '^\\s+|\\s+$', '', 'g')
              WHEN instr(txt, '{') > 0
                THEN nullif(regexp_extract(regexp_replace(txt, '^\\s+|\\s+$', '', 'g'), '(?s)(\\{.*\\})', 1), '')
              ELSE regexp_replace(txt, '^\\s+|\\s+$', '', 'g') END AS block
  FROM t)
SELECT event_id, block, coalesce(json_valid(block), false) AS parse_ok,
       CASE WHEN json_valid(block) THEN CAST(json_extract(block, '$.k') AS BIGINT) END AS k
FROM b
"""


# ---------------------------------------------------------------------------
# registry
# ---------------------------------------------------------------------------

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hourly_series": q_hourly_series,
    "payload_explode": q_payload_explode,
    "mixed_time_parse": q_mixed_time_parse,
    "join_on_time": q_join_on_time,
    "new_rows_anti": q_new_rows_anti,
    "upsert_keep_first": q_upsert_keep_first,
    "upsert_keep_last": q_upsert_keep_last,
    "rows_after_watermark": q_rows_after_watermark,
    "load_stats": q_load_stats,
    "log_features": q_log_features,
    "standard_scale": q_standard_scale,
    "standard_scale_null_keys": q_standard_scale_null_keys,
    "lag_features": q_lag_features,
    "lag_features_global": q_lag_features_global,
    "lag_features_split": q_lag_features_split,
    "lag_features_global_split": q_lag_features_global_split,
    "lag_features_null_keys": q_lag_features_null_keys,
    "calendar_features": q_calendar_features,
    "feature_table": q_feature_table,
    "feature_table_by_user": q_feature_table_by_user,
    "select_features": q_select_features,
    "csv_roundtrip": q_csv_roundtrip,
    "period_bounds": q_period_bounds,
    "drift_moments": q_drift_moments,
    "drift_ks": q_drift_ks,
    "drift_ks_split": q_drift_ks_split,
    "drift_report": q_drift_report,
    "drift_summary_lines": q_drift_summary_lines,
    "drift_report_by_flag": q_drift_report_by_flag,
    "drift_ks_split_by_flag": q_drift_ks_split_by_flag,
    "drift_report_null_keys": q_drift_report_null_keys,
    "report_json_roundtrip": q_report_json_roundtrip,
    "drift_report_features": q_drift_report_features,
    "match_features": q_match_features,
    "match_candidates": q_match_candidates,
    "match_top_columns": q_match_top_columns,
    "classify_probes": q_classify_probes,
    "resolve_attempts": q_resolve_attempts,
    "dispositions": q_dispositions,
    "disposition_summary": q_disposition_summary,
    "extract_json_block": q_extract_json_block,
}

ORACLE_SQL: dict[str, str] = {
    "hourly_series": SQL_HOURLY_SERIES,
    "payload_explode": SQL_PAYLOAD_EXPLODE,
    "mixed_time_parse": SQL_MIXED_TIME_PARSE,
    "join_on_time": SQL_JOIN_ON_TIME,
    "new_rows_anti": SQL_NEW_ROWS_ANTI,
    "upsert_keep_first": _upsert_sql("ASC"),
    "upsert_keep_last": _upsert_sql("DESC"),
    "rows_after_watermark": SQL_ROWS_AFTER_WATERMARK,
    "load_stats": SQL_LOAD_STATS,
    "log_features": SQL_LOG_FEATURES,
    "standard_scale": SQL_STANDARD_SCALE,
    "standard_scale_null_keys": SQL_STANDARD_SCALE_NULL_KEYS,
    "lag_features": _lag_sql("user_id"),
    "lag_features_global": _lag_sql(""),
    "lag_features_split": _lag_sql("user_id"),
    "lag_features_global_split": _lag_sql(""),
    "lag_features_null_keys": _lag_sql("user_id", NULLED_USER),
    "calendar_features": SQL_CALENDAR_FEATURES,
    "feature_table": SQL_FEATURE_TABLE,
    "feature_table_by_user": SQL_FEATURE_TABLE_BY_USER,
    "select_features": SQL_SELECT_FEATURES,
    "csv_roundtrip": SQL_FEATURE_TABLE,
    "period_bounds": SQL_PERIOD_BOUNDS,
    "drift_moments": SQL_DRIFT_MOMENTS,
    "drift_ks": SQL_DRIFT_KS,
    "drift_ks_split": SQL_DRIFT_KS,
    "drift_report": SQL_DRIFT_REPORT,
    "drift_summary_lines": SQL_DRIFT_SUMMARY_LINES,
    "drift_report_by_flag": _keyed_drift_sql(),
    "drift_ks_split_by_flag": _keyed_drift_sql(),
    "drift_report_null_keys": _keyed_drift_sql(NULLED_FLAG),
    "report_json_roundtrip": SQL_REPORT_JSON_ROUNDTRIP,
    "drift_report_features": SQL_DRIFT_REPORT_FEATURES,
    "match_features": SQL_MATCH_FEATURES,
    "match_candidates": SQL_MATCH_CANDIDATES,
    "match_top_columns": SQL_MATCH_CANDIDATES,
    "classify_probes": SQL_CLASSIFY_PROBES,
    "resolve_attempts": SQL_RESOLVE_ATTEMPTS,
    "dispositions": SQL_DISPOSITIONS,
    "disposition_summary": SQL_DISPOSITION_SUMMARY,
    "extract_json_block": SQL_EXTRACT_JSON_BLOCK,
}

