"""Registered queries of intake (schemas, quarantine, completeness) and of the stream of late hours, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..operators import intake
from ..session import scratch_dir
from ..streaming.landing import ingest_stream
from . import suite
from .standins import HOURLY_WIDE_SQL, table
from .suite import finish, q, r6, ts

#: Events as another system lands them, in SQL of both engines: all text, with values that no type holds.
LANDED = """
SELECT CAST(event_id AS {text}) AS id,
       CASE WHEN event_type = 'signup' AND value > 50 THEN 'unknown' ELSE {time} END AS ts,
       CAST(user_id AS {text}) AS user_id,
       CASE WHEN event_type = 'purchase' THEN concat(CAST(CAST(value AS DECIMAL(12, 2)) AS {text}), ' EUR')
            ELSE CAST(CAST(value AS DECIMAL(12, 2)) AS {text}) END AS value,
       event_type, nullif(props, '{{"k": 1}}') AS props
FROM {events}
"""
LANDED_SPARK = LANDED.format(events="landed_source", text="STRING", time="date_format(ts, 'yyyy-MM-dd HH:mm:ss')")
LANDED_DUCK = LANDED.format(events="events", text="VARCHAR", time="strftime(ts, '%Y-%m-%d %H:%M:%S')")
EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id INT, value DOUBLE, event_type STRING, region STRING"


def q_conform_schema(spark, sf):
    """Landed events with the schema of events, and what didn't fit."""
    table(spark, sf, "events").createOrReplaceTempView("landed_source")
    landed = spark.sql(LANDED_SPARK)
    out = intake.conform_schema(landed, EVENT_SCHEMA, {"id": "event_id"})
    return finish(out.select("event_id", "ts", "user_id", "value", "event_type", "region",
                             *[F.col(intake.RESCUED)[c].alias(f"lost_{c}") for c in ("ts", "value", "props")]))


SQL_CONFORM_SCHEMA = f"""
WITH landed AS ({LANDED_DUCK}),
cast_ AS (SELECT *, TRY_CAST(ts AS TIMESTAMP) AS t, TRY_CAST(value AS DOUBLE) AS v FROM landed)
SELECT CAST(id AS BIGINT) AS event_id, {ts('t', 'ts')}, CAST(user_id AS INTEGER) AS user_id, {r6('v', 'value')},
       event_type, CAST(NULL AS VARCHAR) AS region, CASE WHEN t IS NULL THEN ts END AS lost_ts,
       CASE WHEN v IS NULL THEN value END AS lost_value, props AS lost_props
FROM cast_
"""

#: Rules in SQL of both engines.
ORDER_RULES = {"price": "o_totalprice BETWEEN 1000 AND 400000", "status": "nullif(o_orderstatus, 'P') IN ('O', 'F')"}
EVENT_RULES = {"value": "value > 0", "known type": "event_type <> 'error'"}


def _quarantined(df: DataFrame, key: str, name: str, **rules) -> DataFrame:
    """Both sinks, as they were written: key, rejected, and the broken rules as text."""
    sound, rejected = intake.quarantine(df, scratch_dir(df.sparkSession, name), **rules)
    return sound.select(key, F.lit(False).alias("rejected"), F.lit("").alias("errors")) \
        .unionByName(rejected.select(key, F.lit(True).alias("rejected"), F.array_join("errors", ",").alias("errors")))


def q_quarantine_orders(spark, sf):
    """Orders with rules on price and status, one order a customer and day, and customers in credit."""
    credit = table(spark, sf, "customer").where("c_acctbal >= 0").select("c_custkey")
    return _quarantined(table(spark, sf, "orders"), "o_orderkey", "quarantine-orders", rules=ORDER_RULES,
                        unique={"one a day": ["o_custkey", "o_orderdate"]},
                        references={"customer": (["o_custkey"], credit, ["c_custkey"])})


def _errors_sql(tests: dict[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({t}, false) THEN '{n}' END" for n, t in tests.items()) + ")"


SQL_QUARANTINE_ORDERS = f"""
WITH e AS (SELECT o_orderkey, {_errors_sql({**ORDER_RULES,
    "one a day": "count(*) OVER (PARTITION BY o_custkey, o_orderdate) = 1",
    "customer": "o_custkey IS NULL OR EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)"})} AS errors
           FROM orders)
SELECT o_orderkey, errors <> '' AS rejected, errors FROM e
"""


def q_quarantine_events(spark, sf):
    """Events with rules on value and type, whose user and value are those of no other event."""
    return _quarantined(table(spark, sf, "events"), "event_id", "quarantine-events", rules=EVENT_RULES,
                        unique={"repeated": ["user_id", "value"]})


SQL_QUARANTINE_EVENTS = f"""
WITH e AS (SELECT event_id, {_errors_sql({**EVENT_RULES,
    "repeated": "count(*) OVER (PARTITION BY user_id, value) = 1"})} AS errors FROM events)
SELECT event_id, errors <> '' AS rejected, errors FROM e
"""

#: Orders in three loads, the second of which comes twice; the first doesn't have the priority yet.
LOADS = {"1": "o_orderdate < DATE '1996-07-01'", "2": "o_orderdate >= DATE '1996-07-01' AND o_orderdate < DATE '2000-01-01'",
         "3": "o_orderdate >= DATE '2000-01-01'"}
GAPS = "o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, " \
       "CASE WHEN o_totalprice < 400000 THEN o_totalprice END AS o_totalprice, o_orderpriority"
GAP_COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _completeness(spark, sf, **how):
    path = scratch_dir(spark, "completeness")
    orders = table(spark, sf, "orders")
    for load in ["1", "2", "2", "3"]:
        rows = spark.sql(f"SELECT o_orderdate, {GAPS} FROM {{orders}} WHERE {LOADS[load]}", orders=orders)
        columns = GAP_COLUMNS[:-1] if load == "1" else GAP_COLUMNS
        intake.record_load(rows, path, load, F.year("o_orderdate"), columns)
    return finish(intake.completeness(intake.read_state(spark, path), threshold=fixed.DRIFT_THRESHOLD, **how))


def q_completeness(spark, sf):
    """Share of missing values of each column, over all loads."""
    return _completeness(spark, sf)


def q_completeness_by_year(spark, sf):
    """The same by year."""
    return _completeness(spark, sf, by_part=True)


def _completeness_sql(part: str) -> str:
    by, group = (f"{part} AS part, ", f"GROUP BY {part}") if part else ("", "")
    one = " UNION ALL ".join(
        f"SELECT {by}'{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_missing FROM gaps {group}"
        for c in GAP_COLUMNS)
    return f"""
WITH gaps AS (SELECT o_orderdate, {GAPS.replace("o_orderpriority", f"CASE WHEN NOT ({LOADS['1']}) THEN o_orderpriority END AS o_orderpriority")}
              FROM orders WHERE o_orderdate IS NOT NULL),
n AS ({one})
SELECT {'part, ' if part else ''}column_name, n_rows, n_missing, {r6('n_missing / n_rows', 'null_share')},
       n_missing / n_rows <= {fixed.DRIFT_THRESHOLD} AS complete
FROM n
"""


#: Up to this day of the month the weather comes in a second delivery, weeks after the newest hour.
LATE_UNTIL = 10


def q_stream_late_hours(spark, sf):
    """Payloads of all days landed in two deliveries, the early days' weather in the second: every hour arrives."""
    folders = {side: scratch_dir(spark, f"landed-{side}") for side in ("pollutant", "weather")}
    target, state = scratch_dir(spark, "streamed-hours"), scratch_dir(spark, "stream-state")
    early = F.get_json_object("payload", "$.hourly.time[0]").substr(9, 2).cast("int") <= LATE_UNTIL
    pollutant = suite.payload_text(spark, sf, fixed.POLLUTANT_FIELDS)
    weather = suite.payload_text(spark, sf, fixed.WEATHER_FIELDS)
    deliveries = ((pollutant, weather.where(~early)), (None, weather.where(early)))
    for p, w in deliveries:
        for side, rows in (("pollutant", p), ("weather", w)):
            if rows is not None:
                rows.write.mode("append").text(folders[side])
        run = ingest_stream(spark, folders["pollutant"], folders["weather"], target, f"{state}/checkpoint",
                            multi_line=False)
        run.awaitTermination()
    return finish(spark.read.parquet(target).drop("date"))


SQL_STREAM_LATE_HOURS = f"""
WITH hw AS ({HOURLY_WIDE_SQL})
SELECT {ts('datetime', 'datetime')}, {', '.join(r6(q(c)) for c in fixed.RAW_COLUMNS[1:])} FROM hw
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "conform_schema": q_conform_schema,
    "quarantine_orders": q_quarantine_orders,
    "quarantine_events": q_quarantine_events,
    "completeness": q_completeness,
    "completeness_by_year": q_completeness_by_year,
    "stream_late_hours": q_stream_late_hours,
}

ORACLE_SQL: dict[str, str] = {
    "conform_schema": SQL_CONFORM_SCHEMA,
    "quarantine_orders": SQL_QUARANTINE_ORDERS,
    "quarantine_events": SQL_QUARANTINE_EVENTS,
    "completeness": _completeness_sql(""),
    "completeness_by_year": _completeness_sql("CAST(year(o_orderdate) AS VARCHAR)"),
    "stream_late_hours": SQL_STREAM_LATE_HOURS,
}
