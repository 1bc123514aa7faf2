"""Edge-case contracts from SURVEY §2.13 not covered elsewhere."""
import datetime as dt

from pyspark.sql import functions as F

from driftline.operators import drift, features, incremental


def h(i):
    return dt.datetime(2025, 1, 1) + dt.timedelta(hours=i)


def test_e3_lag_is_by_row_not_clock(spark):
    # hour 2 is missing: lag1 of hour 3 is hour 1's value
    df = spark.createDataFrame([(h(0), 0.0), (h(1), 1.0), (h(3), 3.0)], "datetime timestamp_ntz, aqi_us double")
    for m in ("window", "ranked"):
        out = features.lag_features(df, ["aqi_us"], [1], method=m).orderBy("datetime").collect()
        assert [r["aqi_us_lag1"] for r in out] == [None, 0.0, 1.0]


def test_e13_nan_is_missing_in_drift(spark):
    rows = [(h(i), float("nan") if i % 5 == 0 else float(i % 7)) for i in range(24 * 30)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, x double")
    clean = df.filter(~F.isnan("x"))
    a = drift.drift_report(df, "datetime", ["x"]).first()
    b = drift.drift_report(clean, "datetime", ["x"]).first()
    assert (a["n_recent"], a["n_baseline"]) == (b["n_recent"], b["n_baseline"])
    assert abs(a["mean_shift"] - b["mean_shift"]) < 1e-12 and abs(a["ks_statistic"] - b["ks_statistic"]) < 1e-12


def test_e10_keep_first_ignores_corrections(spark):
    ex = spark.createDataFrame([(h(1), 1.0)], "datetime timestamp_ntz, pm10 double")
    fix = spark.createDataFrame([(h(1), 9.0)], "datetime timestamp_ntz, pm10 double")
    assert incremental.upsert(ex, fix, keep="first").first()["pm10"] == 1.0
    assert incremental.upsert(ex, fix, keep="last").first()["pm10"] == 9.0


def test_e4_history_rows_keep_their_lags(spark):
    # new rows get lags from history; history rows are not recomputed
    cols = ["datetime", "aqi_us", "pm10", "pm2_5", "co", "no2", "so2", "o3", "temp_C", "humidity_%",
            "windspeed_kph", "precip_mm"]
    schema = ", ".join(f"`{c}` {'timestamp_ntz' if c == 'datetime' else 'double'}" for c in cols)
    raw = spark.createDataFrame([(h(i), float(i)) + (1.0,) * 10 for i in range(6)], schema)
    old = features.build_features(raw.filter("aqi_us < 3"))
    new = features.build_features(raw.filter("aqi_us >= 3"), history=old)
    assert new.count() == 3 and old.count() == 3
    assert [r["aqi_us_lag1"] for r in new.orderBy("datetime").collect()] == [2.0, 3.0, 4.0]
    # scaler fitted on the new rows only: their scaled temp is 0 (constant column -> scale 1)
    assert {r["scaled_temp_C"] for r in new.collect()} == {0.0}


def test_e24_dedup_before_lag(spark):
    ex = spark.createDataFrame([(h(0), 0.0), (h(1), 1.0)], "datetime timestamp_ntz, aqi_us double")
    dup = spark.createDataFrame([(h(1), 5.0), (h(2), 2.0)], "datetime timestamp_ntz, aqi_us double")
    merged = incremental.upsert(ex, dup, keep="last")
    out = features.lag_features(merged, ["aqi_us"], [1]).orderBy("datetime").collect()
    assert [(r["aqi_us"], r["aqi_us_lag1"]) for r in out] == [(0.0, None), (5.0, 0.0), (2.0, 5.0)]
