"""Driver tables re-shaped into the inputs the operators expect.

The original works on one hourly air-quality series. The driver tables are a
TPC-H-like schema plus an ``events`` stream; these functions derive the same
shapes from them, so every query's work grows with the tables:

* ``hourly_wide(events)``: one row per hour with the 11 raw metrics; each
  metric is a fixed aggregate of that hour's events (below).
* ``user_series(events)``: the keyed variant, one series per ``user_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Stand-in metric definitions (fixed for the oracle SQL to mirror):
#   pm10 / pm2_5 / co / no2 / so2 = mean value of click / view / signup /
#   purchase / error events; o3 = max(value); aqi_us = number of events;
#   temp_C = min(value); humidity_% = mean value; windspeed_kph = distinct
#   users; precip_mm = error events with value >= 100 (mostly 0).
# Values have two decimals; means are taken exactly, as a sum of whole cents
# divided by the count, so they do not depend on the order of summation.
EVENT_TYPES = {"click": "pm10", "view": "pm2_5", "signup": "co", "purchase": "no2", "error": "so2"}


def hourly_wide(events: DataFrame, keys: list[str] = ()) -> DataFrame:
    """One row per (keys, hour) with the 11 stand-in metrics.

    Two partial aggregations instead of a distinct count: first per (keys,
    hour, user) -- cents, counts, min, max -- then per (keys, hour), where
    the number of distinct users is the number of rows.
    """
    keys = list(keys)
    inner = ["user_id"] if "user_id" not in keys else []
    first = [F.expr("CAST(round(value * 100) AS BIGINT) AS _c"), "event_type", "value",
             *keys, *inner, F.expr("CAST(date_trunc('hour', ts) AS TIMESTAMP_NTZ) AS datetime")]
    e = events.select(*first)
    aggs1 = []
    for t in EVENT_TYPES:
        aggs1 += [F.expr(f"sum(_c) FILTER (WHERE event_type = '{t}') AS s_{t}"),
                  F.expr(f"count_if(event_type = '{t}') AS n_{t}")]
    aggs1 += [F.expr("max(value) AS mx"), F.expr("min(value) AS mn"), F.expr("sum(_c) AS s_all"),
              F.expr("count(1) AS n_all"),
              F.expr("count_if(event_type = 'error' AND value >= 100) AS n_rain")]
    per_user = e.groupBy(*keys, *inner, "datetime").agg(*aggs1)
    aggs2 = []
    for t, col in EVENT_TYPES.items():
        aggs2.append(F.expr(f"try_divide(CAST(sum(s_{t}) AS DOUBLE), sum(n_{t})) / 100.0 AS {col}"))
    aggs2 += [F.expr("max(mx) AS o3"), F.expr("CAST(sum(n_all) AS DOUBLE) AS aqi_us"),
              F.expr("min(mn) AS temp_C"),
              F.expr("CAST(sum(s_all) AS DOUBLE) / sum(n_all) / 100.0 AS `humidity_%`"),
              F.expr("CAST(count(1) AS DOUBLE) AS windspeed_kph"),
              F.expr("CAST(sum(n_rain) AS DOUBLE) AS precip_mm")]
    return per_user.groupBy(*keys, "datetime").agg(*aggs2).select(*keys, *[F.col(f"`{c}`") for c in
                                                                          ["datetime", *COLUMNS]])


COLUMNS = ["pm10", "pm2_5", "co", "no2", "so2", "o3", "aqi_us", "temp_C", "humidity_%",
           "windspeed_kph", "precip_mm"]


HOURLY_WIDE_SQL = """
SELECT date_trunc('hour', ts) AS datetime,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE event_type = 'click') AS DOUBLE)
         / count(*) FILTER (WHERE event_type = 'click') / 100.0 AS pm10,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE event_type = 'view') AS DOUBLE)
         / count(*) FILTER (WHERE event_type = 'view') / 100.0 AS pm2_5,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE event_type = 'signup') AS DOUBLE)
         / count(*) FILTER (WHERE event_type = 'signup') / 100.0 AS co,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE event_type = 'purchase') AS DOUBLE)
         / count(*) FILTER (WHERE event_type = 'purchase') / 100.0 AS no2,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE event_type = 'error') AS DOUBLE)
         / count(*) FILTER (WHERE event_type = 'error') / 100.0 AS so2,
       max(value) AS o3,
       CAST(count(*) AS DOUBLE) AS aqi_us,
       min(value) AS temp_C,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100.0 AS "humidity_%",
       CAST(count(DISTINCT user_id) AS DOUBLE) AS windspeed_kph,
       CAST(count(*) FILTER (WHERE event_type = 'error' AND value >= 100) AS DOUBLE) AS precip_mm
FROM events GROUP BY 1
"""


def hourly_wide_sql(keys: str = "") -> str:
    """The same stand-in, optionally per key (e.g. ``user_id``)."""
    if not keys:
        return HOURLY_WIDE_SQL
    return HOURLY_WIDE_SQL.replace("SELECT date_trunc", f"SELECT {keys}, date_trunc") \
        .replace("GROUP BY 1", f"GROUP BY {keys}, 2")

