"""Scalar functions: log, time parsing, calendar, text helpers."""
import datetime as dt
import math

from pyspark.sql import functions as F

from driftline.functions import (extract_json_block, join_url, log1p_zero, normalize_name,
                                 parse_mixed_timestamp, relative_shift, squash_name)
from driftline.operators.features import calendar_features, cyclic_features


def test_log_zero_and_missing(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (None,), (-2.0,), (-1.0,)], "x double")
    got = [r[0] for r in df.select(log1p_zero("x")).collect()]
    assert got[0] == 0.0 and abs(got[1] - math.log(2)) < 1e-12
    assert got[2:] == [0.0, 0.0, 0.0]


def test_mixed_time_parse(spark):
    df = spark.createDataFrame([("2025-04-01 00:00:00",), ("01/04/2025 13:00",), ("04/13/2025 00:00",),
                                ("bad",)], "t string")
    got = [r[0] for r in df.select(parse_mixed_timestamp("t")).collect()]
    assert got == [dt.datetime(2025, 4, 1), dt.datetime(2025, 4, 1, 13), dt.datetime(2025, 4, 13), None]


def test_calendar(spark):
    days = [dt.datetime(2025, 9, 22, h) for h in (0, 6)] + [dt.datetime(2025, 9, 27), dt.datetime(2025, 9, 28)]
    df = spark.createDataFrame([(x,) for x in days], "datetime timestamp_ntz")
    out = cyclic_features(calendar_features(df)).collect()
    assert [r["day_of_week"] for r in out] == [0, 0, 5, 6]
    assert [r["is_weekend"] for r in out] == [0, 0, 1, 1]
    assert out[1]["hour"] == 6 and abs(out[1]["hour_sin"] - 1.0) < 1e-12
    assert abs(out[1]["hour_cos"]) < 1e-12


def test_relative_shift(spark):
    df = spark.createDataFrame([(2.0, 1.0), (5.0, 0.0), (None, 1.0), (1.0, None)], "r double, b double")
    got = [r[0] for r in df.select(relative_shift("r", "b")).collect()]
    assert got == [1.0, 0.0, None, None]


def test_names(spark):
    df = spark.createDataFrame([("Construction_Activity_Index",), ("pm2_5",), ("pm25",),
                                ("humidity_%",), ("traffic data",)], "n string")
    got = [(r[0], r[1]) for r in df.select(normalize_name("n"), squash_name("n")).collect()]
    assert got == [("construction_activity", "constructionactivity"), ("pm2_5", "pm25"),
                   ("pm25", "pm25"), ("humidity", "humidity"), ("traffic", "traffic")]


def test_join_url(spark):
    df = spark.createDataFrame([("https://a.com/", "/v1/x"), ("https://a.com", "v1"),
                                ("https://a.com//", ""), ("http://b", None)], "u string, e string")
    got = [r[0] for r in df.select(join_url("u", "e")).collect()]
    assert got == ["https://a.com/v1/x", "https://a.com/v1", "https://a.com//", "http://b"]


def test_extract_json_block(spark):
    cases = [
        ('```json\n{"a": 1}\n```', '{"a": 1}'),
        ('text before {"a": {"b": 2}} and after', '{"a": {"b": 2}}'),
        ('```json\n{"a": 1}\n', '{"a": 1}'),
        ('no json here', 'no json here'),
        ('  {broken  ', None),
        ('', ''),
        ('x ```json {"a": 1} ``` y {"b": 2}', '{"a": 1}'),
    ]
    df = spark.createDataFrame([(c,) for c, _ in cases], "t string")
    got = [r[0] for r in df.select(extract_json_block("t")).collect()]
    assert got == [e for _, e in cases]
