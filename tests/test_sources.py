"""Sources and sinks: payload explode, readers, first-run tables, staged writes."""
import datetime as dt
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from driftline import fixed
from driftline.plans import files
from driftline.sources import payload, sinks, tables


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_payload_explode_renames_and_nulls(spark, tmp_dir):
    obj = {"latitude": 1, "hourly": {"time": ["2025-09-22T00:00", "2025-09-22T01:00"],
                                     "pm10": [1.5, None], "pm2_5": [2.0, 3.0], "carbon_monoxide": [1, 2],
                                     "nitrogen_dioxide": [0, 0], "sulphur_dioxide": [1, 1], "ozone": [5, 6],
                                     "us_aqi": [10, 11]}}
    p = os.path.join(tmp_dir, "p.json")
    _write(p, json.dumps(obj, indent=2))
    rows = payload.read_hourly_payload(spark, p, fixed.POLLUTANT_FIELDS).orderBy("datetime").collect()
    assert [r["datetime"] for r in rows] == [dt.datetime(2025, 9, 22, 0), dt.datetime(2025, 9, 22, 1)]
    assert rows[0]["co"] == 1.0 and rows[1]["pm10"] is None and rows[1]["aqi_us"] == 11.0
    assert list(rows[0].asDict()) == ["datetime", *fixed.POLLUTANT_FIELDS.values()]


def test_payload_unequal_lengths(spark):
    df = spark.createDataFrame([(["2025-09-22T00:00", "2025-09-22T01:00"], [1.0])],
                               "time array<string>, temperature_2m array<double>")
    df = df.select(F.struct("time", "temperature_2m").alias("hourly"))
    fields = {"temperature_2m": "temp_C"}
    padded = payload.explode_payload(df, fields).collect()
    assert len(padded) == 2 and padded[1]["temp_C"] is None
    with pytest.raises(Exception):
        payload.explode_payload(df, fields, check_lengths=True).collect()


def test_read_table_strict_and_lenient(spark, tmp_dir):
    p = os.path.join(tmp_dir, "raw.csv")
    _write(p, "datetime,pm10\n2025-04-01 00:00:00,1.0\nbad,2.0\n")
    schema = "datetime string, pm10 double"
    lenient = tables.read_table(spark, p, schema=schema, on_bad="null").collect()
    assert lenient[0]["datetime"] == dt.datetime(2025, 4, 1) and lenient[1]["datetime"] is None
    with pytest.raises(Exception):
        tables.read_table(spark, p, schema=schema, on_bad="fail").collect()


def test_load_or_empty_and_catalog(spark, tmp_dir):
    e = tables.load_or_empty(spark, os.path.join(tmp_dir, "nope"), tables.raw_schema())
    assert e.count() == 0 and e.columns == fixed.RAW_COLUMNS
    assert dict(e.dtypes)["datetime"] == "timestamp_ntz"
    cat = tables.column_catalog(e).collect()
    assert [r["column_name"] for r in cat] == fixed.RAW_COLUMNS
    assert tables.resolve_time_col(e) == "datetime"
    with pytest.raises(KeyError):
        tables.resolve_time_col(e.drop("datetime"))


def test_requested_features(spark, tmp_dir):
    p = os.path.join(tmp_dir, "drift.json")
    _write(p, json.dumps({"seasonal_shift_detected": True, "features_to_add": ["a", "b", "c"]}, indent=2))
    rows = tables.read_requested_features(spark, p).collect()
    assert [(r["pos"], r["feature"]) for r in rows] == [(0, "a"), (1, "b"), (2, "c")]


def test_many_report_files(spark, tmp_dir, monkeypatch):
    for i in range(30):
        _write(os.path.join(tmp_dir, f"r{i}.json"), json.dumps({"features_to_add": [f"a{i}", f"b{i}"], "n": i}, indent=2))
    _write(os.path.join(tmp_dir, "none.json"), json.dumps({"n": 1}))
    _write(os.path.join(tmp_dir, "empty.json"), json.dumps({"features_to_add": []}))
    # files must not be read for their schema one by one: that is quadratic in the files
    given, whole, of_files = DataFrameReader.schema, DataFrameReader.json, []
    monkeypatch.setattr(DataFrameReader, "schema", lambda self, s: [setattr(self, "given", True), given(self, s)][1])
    monkeypatch.setattr(DataFrameReader, "json", lambda self, path, *a, **kw: [
        of_files.append(getattr(self, "given", False)) if isinstance(path, str) else None, whole(self, path, *a, **kw)][1])
    got = sorted((r["pos"], r["feature"]) for r in tables.read_requested_features(spark, tmp_dir).collect())
    assert got == sorted((k, f"{c}{i}") for i in range(30) for k, c in enumerate("ab"))
    assert of_files == [True]


def test_report_files_as_before(spark, tmp_dir):
    wide, odd = os.path.join(tmp_dir, "wide"), os.path.join(tmp_dir, "odd")
    for d, text, code in ((wide, {"features_to_add": ["a", "b"]}, "utf-16"), (odd, {"other": ["a"]}, "utf-8")):
        os.mkdir(d)
        with open(os.path.join(d, "r.json"), "w", encoding=code) as f:
            json.dump(text, f, indent=2)
    assert [tuple(r) for r in tables.read_requested_features(spark, wide).collect()] == [(0, "a"), (1, "b")]
    with pytest.raises(AnalysisException):
        tables.read_requested_features(spark, odd)


def test_requested_report_is_written_by_many_tasks(spark, monkeypatch):
    read, seen = tables.read_requested_features, []
    monkeypatch.setattr(tables, "read_requested_features", lambda s, path: [seen.append(path), read(s, path)][1])
    parts = spark.range(2000).selectExpr("id AS pos", "concat('f', id) AS feature")
    monkeypatch.setattr(files.suite, "requested_features", lambda *a: parts)
    rows = files.q_requested_report(spark, "")
    assert sorted(tuple(r) for r in rows.collect()) == sorted((i % 100, f"f{i}") for i in range(2000))
    names = [f for f in os.listdir(seen[0].removeprefix("file:")) if f.endswith(".json")]
    assert len(names) == 20 and len({f.split("-")[1] for f in names}) > 1


def test_staged_swap_rewrites_source(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([(dt.datetime(2025, 1, 2), 2.0), (dt.datetime(2025, 1, 1), 1.0)],
                               "datetime timestamp_ntz, x double")
    sinks.write_table(df, path, fmt="csv", time_format=fixed.FMT_DAY_FIRST)
    back = tables.read_table(spark, path, schema="datetime string, x double",
                             time_formats=fixed.FMT_DAY_FIRST)
    more = back.unionByName(spark.createDataFrame([(dt.datetime(2025, 1, 3), 3.0)], back.schema))
    sinks.replace_table(spark, more, path, os.path.join(tmp_dir, "staging"), fmt="csv",
                        time_format=fixed.FMT_DAY_FIRST)
    text = spark.read.option("header", True).csv(path).orderBy("x").collect()
    assert [r["datetime"] for r in text] == ["01/01/2025 00:00", "02/01/2025 00:00", "03/01/2025 00:00"]
