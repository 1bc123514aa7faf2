"""Registered queries of lags by the clock, back-fills, partition-wise loads and daily drift state, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..operators import features, partitioned, rolling, timelags
from ..session import materialize, scratch_dir
from . import suite
from .standins import HOURLY_WIDE_SQL, hourly_wide, table
from .suite import EVENT_LAGS, finish, q, r6, ts

#: Events that arrive late, in SQL of both engines.
LATE = "event_type = 'purchase'"
AS_OF_HOURS = [1, 24]
CLOCK_COLUMNS = ["pm10", "o3", "temp_C"]


def q_lag_by_clock(spark, sf):
    """The hourly series with the values 1, 12 and 24 hours earlier."""
    wide = hourly_wide(table(spark, sf, "events")).select("datetime", *CLOCK_COLUMNS)
    return finish(timelags.lag_by_clock(wide, CLOCK_COLUMNS))


SQL_LAG_BY_CLOCK = f"""
WITH hw AS ({HOURLY_WIDE_SQL})
SELECT {ts('a.datetime', 'datetime')}, {', '.join(r6(f'a.{q(c)}', c) for c in CLOCK_COLUMNS)},
       {', '.join(r6(f'b{k}.{q(c)}', f'{c}_{k}h_ago') for c in CLOCK_COLUMNS for k in fixed.LAGS)}
FROM hw a {' '.join(f"LEFT JOIN hw b{k} ON b{k}.datetime = a.datetime - INTERVAL {k} HOUR" for k in fixed.LAGS)}
"""


def _lags_as_of(spark, sf, **plan):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = timelags.lag_as_of(ev, ["value"], AS_OF_HOURS, ["user_id"], ["ts", "event_id"], **plan)
    return finish(out.drop("ts", "value"))


def q_lag_as_of(spark, sf):
    """Each event with its user's last value an hour and a day earlier."""
    return _lags_as_of(spark, sf)


def q_lag_as_of_split(spark, sf):
    """The plan of large series."""
    return _lags_as_of(spark, sf, rows_per_task=suite.SPLIT_ROWS)


SQL_LAG_AS_OF = f"""
WITH last AS (SELECT user_id, ts, arg_max(value, event_id) AS value FROM events GROUP BY user_id, ts)
SELECT e.event_id, e.user_id, {', '.join(r6(f'b{k}.value', f'value_{k}h_as_of') for k in AS_OF_HOURS)}
FROM events e {' '.join(f"ASOF LEFT JOIN last b{k} ON b{k}.user_id = e.user_id AND b{k}.ts <= e.ts - INTERVAL {k} HOUR"
                        for k in AS_OF_HOURS)}
"""


def _backfilled(spark, sf, keys, **plan):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value", "event_type")
    order = ["ts", "event_id"]
    late = ev.where(LATE).drop("event_type")
    held = ev.where(f"NOT ({LATE})").drop("event_type")
    have = materialize(features.lag_features(held, ["value"], EVENT_LAGS, keys, order), "lags-held")
    out = timelags.refresh_lags(have, late, ["value"], EVENT_LAGS, keys, order, **plan)
    return finish(out.select("event_id", "user_id", *[f"value_lag{k}" for k in EVENT_LAGS]))


def q_lags_after_backfill(spark, sf):
    """Lags by row of all events, where some came after the lags of the others had been made."""
    return _backfilled(spark, sf, ["user_id"])


def q_lags_after_backfill_global(spark, sf):
    """The same in one series of all events, with the plan of large series."""
    return _backfilled(spark, sf, [], rows_per_task=suite.SPLIT_ROWS)


#: Orders from this day on come (again) with another price, in SQL of both engines.
CORRECTED = "DATE '2001-01-01'"


def q_upsert_by_partition(spark, sf):
    """Orders by month; those from a day on are corrected, and their months alone are written anew."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    month = F.date_format("o_orderdate", "yyyy-MM")
    path = scratch_dir(spark, "orders-by-month")
    partitioned.upsert_partitions(spark, orders.where("o_orderdate < DATE '2001-05-01'"), path, month,
                                  ["o_orderkey"], "o_orderdate")
    again = orders.where(f"o_orderdate >= {CORRECTED}").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    partitioned.upsert_partitions(spark, again, path, month, ["o_orderkey"], "o_orderdate", keep="last")
    return finish(spark.read.parquet(path).select(*orders.columns, F.col("part").cast("string").alias("part")))


SQL_UPSERT_BY_PARTITION = f"""
SELECT o_orderkey, o_orderdate,
       {r6(f"o_totalprice + CASE WHEN o_orderdate >= {CORRECTED} THEN 1 ELSE 0 END", "o_totalprice")},
       strftime(o_orderdate, '%Y-%m') AS part
FROM orders
"""


def q_drift_report_rolling(spark, sf):
    """``drift_report`` from daily state, written in two loads whose days overlap."""
    li = table(spark, sf, "lineitem")
    path = scratch_dir(spark, "drift-days")
    for some in ("l_shipdate < DATE '2001-01-01'", "l_shipdate >= DATE '2000-12-01'"):
        rolling.write_days(li.where(some), path, suite.LI_TIME, suite.DRIFT_FEATURES_LI)
    r = rolling.rolling_report(spark, path, li, suite.LI_TIME, suite.DRIFT_FEATURES_LI)
    return finish(r.select("feature", "pos", "mean_shift", "variance_shift", "ks_statistic", "is_significant", "drift_type"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lag_by_clock": q_lag_by_clock,
    "lag_as_of": q_lag_as_of,
    "lag_as_of_split": q_lag_as_of_split,
    "lags_after_backfill": q_lags_after_backfill,
    "lags_after_backfill_global": q_lags_after_backfill_global,
    "upsert_by_partition": q_upsert_by_partition,
    "drift_report_rolling": q_drift_report_rolling,
}

ORACLE_SQL: dict[str, str] = {
    "lag_by_clock": SQL_LAG_BY_CLOCK,
    "lag_as_of": SQL_LAG_AS_OF,
    "lag_as_of_split": SQL_LAG_AS_OF,
    "lags_after_backfill": suite._lag_sql("user_id"),
    "lags_after_backfill_global": suite._lag_sql(""),
    "upsert_by_partition": SQL_UPSERT_BY_PARTITION,
    "drift_report_rolling": suite.SQL_DRIFT_REPORT,
}
