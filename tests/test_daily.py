"""The daily jobs end to end on small landed payloads (two days + a replay)."""
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from driftline import fixed
from driftline.plans import daily


def _payloads(root, day: dt.date, seed: int, hours=24, gap=None):
    times = [(dt.datetime.combine(day, dt.time()) + dt.timedelta(hours=h)) for h in range(hours) if h != gap]
    t = [x.strftime("%Y-%m-%dT%H:%M") for x in times]
    val = lambda k: [round((i * 7 + seed * 13 + k) % 50 + 0.5, 2) for i in range(len(t))]
    pol = {"latitude": 1.0, "hourly": {"time": t, **{f: val(k) for k, f in enumerate(fixed.POLLUTANT_FIELDS)}}}
    pol["hourly"]["pm10"][0] = None
    wea = {"hourly": {"time": t, **{f: val(k + 9) for k, f in enumerate(fixed.WEATHER_FIELDS)}}}
    wea["hourly"]["precipitation"] = [0.0] * len(t)
    d = os.path.join(root, day.isoformat())
    os.makedirs(d, exist_ok=True)
    for name, obj in (("pollutant.json", pol), ("weather.json", wea)):
        with open(os.path.join(d, name), "w") as f:
            json.dump(obj, f, indent=2)
    return os.path.join(d, "pollutant.json"), os.path.join(d, "weather.json")


def test_daily_cycle(spark, tmp_dir):
    raw, feat, sel = (os.path.join(tmp_dir, n) for n in ("raw", "features", "selection"))
    days = [dt.date(2025, 9, 20) + dt.timedelta(days=i) for i in range(3)]
    s1 = daily.ingest_day(spark, *_payloads(tmp_dir, days[0], 1), raw)
    assert (s1["rows_before"], s1["rows_after"]) == (0, 24)
    assert daily.update_feature_table(spark, raw, feat)["new_rows"] == 24
    assert daily.refresh_selection(spark, feat, sel)["new_rows"] == 24

    s2 = daily.ingest_day(spark, *_payloads(tmp_dir, days[1], 2, gap=5), raw)
    assert (s2["rows_before"], s2["rows_after"]) == (24, 47)
    assert daily.update_feature_table(spark, raw, feat)["new_rows"] == 23
    assert daily.update_feature_table(spark, raw, feat)["new_rows"] == 0
    assert daily.refresh_selection(spark, feat, sel)["new_rows"] == 23
    assert daily.refresh_selection(spark, feat, sel)["new_rows"] == 0
    # replaying the day fills the missing hour only (existing hours win)
    s3 = daily.ingest_day(spark, *_payloads(tmp_dir, days[1], 9), raw)
    assert (s3["rows_added"], s3["rows_after"]) == (1, 48)
    # the back-filled hour reaches the feature table (anti-join admits it) ...
    assert daily.update_feature_table(spark, raw, feat)["new_rows"] == 1
    # ... but not the selection: it is older than the selection's last hour
    assert daily.refresh_selection(spark, feat, sel)["new_rows"] == 0

    ft = spark.read.option("header", True).csv(feat)
    assert ft.count() == 48 and len(ft.columns) == 46
    first = ft.filter(F.col("datetime") == "21/09/2025 00:00").first()
    # the first hour of day 2 takes its lags from day 1 (history)
    assert first["aqi_us_lag1"] is not None and first["aqi_us_lag24"] is not None
    st = spark.read.option("header", True).csv(sel)
    assert st.columns == fixed.SELECTED_COLUMNS and st.count() == 47
    assert st.orderBy("datetime").first()["datetime"] == "2025-09-20 00:00:00"

    rep = daily.drift_analysis(spark, feat, os.path.join(tmp_dir, "drift.json"))
    assert rep.count() == 44
    back = spark.read.json(os.path.join(tmp_dir, "drift.json")).first()
    assert isinstance(back["seasonal_shift_detected"], bool)


def test_discovery_job(spark, tmp_dir):
    from driftline.plans import suite
    table = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in suite.FEATURE_COLUMNS))
    req = spark.createDataFrame([(0, "relative_humidity_at_10m"), (1, "wind_direction"), (2, "pm25")],
                                "pos int, feature string")
    log = spark.createDataFrame([
        ("wind_direction", 1, '{"candidate_api": {"name": "w", "url": "https://w.io", "endpoint": ""}, '
                              '"confidence": 0.7, "search_keywords": ["wind"]}', "http", 200)],
        "feature string, attempt_no int, response_text string, outcome string, http_status int")
    d = {r["original_feature"]: r for r in daily.discovery(spark, req, table, log,
                                                           os.path.join(tmp_dir, "disc")).collect()}
    assert d["relative_humidity_at_10m"]["final_status"] == "already_exists"
    assert d["pm25"]["final_status"] == "already_exists" and d["pm25"]["mapped_to"] == "pm2_5"
    assert d["wind_direction"]["final_status"] == "found" and d["wind_direction"]["search_attempts"] == 1


def test_ingest_append_mode(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw_parquet")
    d1, d2 = dt.date(2025, 9, 20), dt.date(2025, 9, 21)
    assert daily.ingest_day(spark, *_payloads(tmp_dir, d1, 1), raw, mode="append")["rows_added"] == 24
    assert daily.ingest_day(spark, *_payloads(tmp_dir, d2, 2, gap=5), raw, mode="append")["rows_added"] == 23
    # a replay appends only the missing hour; a second replay appends nothing
    assert daily.ingest_day(spark, *_payloads(tmp_dir, d2, 9), raw, mode="append")["rows_added"] == 1
    assert daily.ingest_day(spark, *_payloads(tmp_dir, d2, 9), raw, mode="append")["rows_added"] == 0
    df = spark.read.parquet(raw)
    assert df.count() == 48 and df.select("datetime").distinct().count() == 48
