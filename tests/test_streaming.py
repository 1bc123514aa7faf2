"""Streaming ingest: landed payloads -> joined hours -> append-only raw table."""
import datetime as dt
import os
import shutil

import pytest

from driftline.streaming.landing import append_new_hours, ingest_stream, join_sides

from .test_daily import _payloads


def _land(tmp_dir, day, seed, gap=None):
    p, w = _payloads(os.path.join(tmp_dir, "src"), day, seed, gap=gap)
    for src, sub in ((p, "pollutant"), (w, "weather")):
        d = os.path.join(tmp_dir, sub)
        os.makedirs(d, exist_ok=True)
        shutil.copy(src, os.path.join(d, f"{day.isoformat()}-{seed}.json"))


def _run(spark, tmp_dir, log, **how):
    q = ingest_stream(spark, os.path.join(tmp_dir, "pollutant"), os.path.join(tmp_dir, "weather"),
                      os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "ckpt"), log=log, **how)
    q.awaitTermination(300)
    assert q.exception() is None


@pytest.mark.parametrize("watermark", [None, "2 days"])
def test_stream_ingest(spark, tmp_dir, watermark):
    log = []
    d1, d2 = dt.date(2025, 9, 20), dt.date(2025, 9, 21)
    _land(tmp_dir, d1, 1)
    _land(tmp_dir, d2, 2, gap=5)
    _run(spark, tmp_dir, log, watermark=watermark)
    raw = os.path.join(tmp_dir, "raw")
    assert spark.read.parquet(raw).count() == 47
    # a replay of day 2 lands later: only the missing hour is appended
    _land(tmp_dir, d2, 9)
    _run(spark, tmp_dir, log, watermark=watermark)
    df = spark.read.parquet(raw)
    assert df.count() == 48
    assert df.select("datetime").distinct().count() == 48
    # existing hours kept their first values
    first = df.filter("datetime = TIMESTAMP_NTZ'2025-09-21 01:00:00'").first()
    assert first["pm2_5"] == round((1 * 7 + 2 * 13 + 1) % 50 + 0.5, 2)
    assert sum(n for _, n in log) == 48


def test_null_hours_are_appended_once(spark, tmp_dir):
    rows = spark.createDataFrame([(dt.datetime(2025, 9, 20, 1), 1.0), (None, 2.0)], "datetime timestamp_ntz, pm10 double")
    target = os.path.join(tmp_dir, "hours")
    assert [append_new_hours(rows, target) for _ in range(2)] == [2, 0]
    only_null = rows.where("datetime IS NULL")
    assert append_new_hours(only_null, target) == 0 and spark.read.parquet(target).count() == 2


def test_late_hours_arrive(spark, tmp_dir):
    log = []
    old, new = dt.date(2025, 9, 1), dt.date(2025, 9, 25)
    _land(tmp_dir, old, 1)
    _land(tmp_dir, new, 2)
    late = os.path.join(tmp_dir, "weather", f"{old.isoformat()}-1.json")
    aside = os.path.join(tmp_dir, "late.json")
    shutil.move(late, aside)
    _run(spark, tmp_dir, log)
    raw = os.path.join(tmp_dir, "raw")
    assert spark.read.parquet(raw).count() == 24
    shutil.copy(aside, late)  # weeks behind the newest hour
    _run(spark, tmp_dir, log)
    df = spark.read.parquet(raw)
    assert df.count() == 48 and df.where("date = DATE'2025-09-01'").select("datetime").distinct().count() == 24
    assert df.where("pm2_5 IS NULL OR temp_C IS NULL").count() == 0 and sum(n for _, n in log) == 48


def test_a_batch_that_failed_half_way_is_made_whole(spark, tmp_dir):
    hour = dt.datetime(2025, 9, 20, 1)
    batch = spark.createDataFrame([("a", hour, 1, None), ("b", hour, None, 2), ("a", None, 3, None), ("b", None, None, 4)],
                                  "side string, datetime timestamp_ntz, x int, y int")
    halves, target = os.path.join(tmp_dir, "halves"), os.path.join(tmp_dir, "t")
    sides = {"a": ["x"], "b": ["y"]}
    # both sides were stored, the append to the target wasn't reached
    for side, columns in sides.items():
        append_new_hours(batch.where(f"side = '{side}'").select("datetime", *columns), f"{halves}/{side}")
    assert [join_sides(batch, sides, halves, target) for _ in range(2)] == [2, 0]
    assert sorted(tuple(r)[1:] for r in spark.read.parquet(target).select("datetime", "x", "y").collect()) == [(1, 2), (3, 4)]
    assert join_sides(batch.limit(0), sides, halves, target) == 0
