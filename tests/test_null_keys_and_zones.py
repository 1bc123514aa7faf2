"""NULL series keys, the driver's clock zone, and the table swap."""

import os
import subprocess
import sys

import pytest

from driftline.operators import drift, features
from driftline.sources import sinks
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import hashlib, sys
sys.path.insert(0, {repo!r})
from driftline.session import get_session
import __spark_entry__ as e
spark = get_session("local[2]", 2)
for name in ("rows_after_watermark", "period_bounds", "drift_report"):
    rows = sorted(map(str, e.queries()[name](spark, {sf!r}).selectExpr("to_json(struct(*)) AS j").collect()))
    print("ROWS", name, len(rows), hashlib.md5("".join(rows).encode()).hexdigest())
"""


def test_results_do_not_depend_on_the_clock_zone():
    out = []
    for zone in ("UTC", "Asia/Karachi"):
        run = subprocess.run([sys.executable, "-c", PROBE.format(repo=REPO, sf=SF_SMALL)], capture_output=True,
                             text=True, env=os.environ | {"TZ": zone}, timeout=300)
        out.append([line for line in run.stdout.splitlines() if line.startswith("ROWS")])
        assert len(out[-1]) == 3, run.stderr[-2000:]
    assert out[0] == out[1]


def test_null_key_is_a_series(spark):
    rows = spark.createDataFrame([(k, float(i)) for k in ("a", None) for i in range(4)], "k string, x double")
    got = features.standard_scale(rows, ["x"], keys=["k"]).collect()
    by = {k: sorted(round(r["scaled_x"], 6) for r in got if r["k"] == k) for k in ("a", None)}
    assert by["a"] == by[None] and by["a"][0] == -by["a"][-1] < 0


def test_ks_of_a_null_key(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    same = li.withColumn("k", F.lit("x")).unionByName(li.withColumn("k", F.lit(None).cast("string")))
    for scope in ("global", "key"):
        for ranges in (1, 8):
            flagged = drift.split_periods(same, "l_shipdate", keys=["k"], scope=scope)
            got = {r["k"]: r for r in drift.drift_metrics(flagged, ["l_quantity"], ["k"], value_buckets=ranges).collect()}
            assert got["x"]["ks_statistic"] == got[None]["ks_statistic"] > 0
            assert got["x"]["mean_shift"] == got[None]["mean_shift"]


def test_a_failed_swap_keeps_the_old_table(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    spark.range(3).write.parquet(path)
    monkeypatch.setattr(sinks, "_rename", lambda fs, src, dst: False)
    with pytest.raises(IOError):
        sinks.replace_table(spark, spark.range(5), path, f"{tmp_dir}/new", fmt="parquet", time_col=None)
    assert spark.read.parquet(path).count() == 3
    monkeypatch.undo()
    sinks.replace_table(spark, spark.range(5), path, f"{tmp_dir}/new2", fmt="parquet", time_col=None)
    assert spark.read.parquet(path).count() == 5


def test_csv_columns_are_checked_against_the_header(spark, tmp_dir):
    from driftline.sources import tables
    spark.sql("SELECT 1.5 AS pm10, '2025-01-01T00:00' AS datetime").coalesce(1).write.option("header", True).csv(f"{tmp_dir}/c")
    with pytest.raises(Exception):
        tables.read_table(spark, f"{tmp_dir}/c", "datetime string, pm10 double", on_bad="null").collect()
