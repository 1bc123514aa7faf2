"""Hand tables for the incremental-load operators (FIXTURES §10)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftline.operators import incremental as inc

T = "datetime timestamp_ntz, v string"


def d(h):
    return dt.datetime(2025, 4, 1, h)


def rows(df, order="datetime"):
    return [tuple(r) for r in df.orderBy(F.col(order).asc_nulls_first()).collect()]


def test_keep_first(spark):
    ex = spark.createDataFrame([(d(1), "a"), (d(2), "b")], T)
    b = spark.createDataFrame([(d(2), "x"), (d(3), "c")], T)
    assert rows(inc.upsert(ex, b, keep="first")) == [(d(1), "a"), (d(2), "b"), (d(3), "c")]


def test_keep_last(spark):
    ex = spark.createDataFrame([(d(1), "a"), (d(2), "b")], T)
    b = spark.createDataFrame([(d(2), "x"), (d(3), "c")], T)
    assert rows(inc.upsert(ex, b, keep="last")) == [(d(1), "a"), (d(2), "x"), (d(3), "c")]


def test_upsert_idempotent(spark):
    ex = spark.createDataFrame([(d(1), "a"), (d(2), "b")], T)
    b = spark.createDataFrame([(d(2), "x"), (d(3), "c")], T)
    once = inc.upsert(ex, b, keep="last")
    twice = inc.upsert(once, b, keep="last")
    assert rows(once) == rows(twice)


def test_null_time_is_one_group(spark):
    ex = spark.createDataFrame([(None, "a")], T)
    b = spark.createDataFrame([(None, "x"), (d(1), "c")], T)
    out = rows(inc.upsert(ex, b, keep="first"))
    assert out == [(None, "a"), (d(1), "c")]


def test_new_rows_null_safe(spark):
    src = spark.createDataFrame([(None, "a"), (d(1), "b"), (d(2), "c")], T)
    tgt = spark.createDataFrame([(None, "z"), (d(1), "y")], T)
    assert rows(inc.new_rows(src, tgt)) == [(d(2), "c")]


def test_join_on_time_null_safe(spark):
    a = spark.createDataFrame([(None, "a"), (d(1), "b")], T)
    b = spark.createDataFrame([(None, "x"), (d(1), "y"), (d(2), "z")], "datetime timestamp_ntz, w string")
    out = rows(inc.join_on_time(a, b))
    assert out == [(None, "a", "x"), (d(1), "b", "y")]


def test_watermark(spark):
    tgt = spark.createDataFrame([(d(1), "a"), (d(2), "b")], T)
    src = spark.createDataFrame([(d(1), "p"), (d(2), "q"), (d(3), "r")], T)
    assert rows(inc.rows_after_watermark(src, tgt)) == [(d(3), "r")]
    assert rows(inc.rows_after_watermark(src, tgt, eager=False)) == [(d(3), "r")]


def test_watermark_empty_target(spark):
    tgt = spark.createDataFrame([], T)
    src = spark.createDataFrame([(d(1), "p")], T)
    assert rows(inc.rows_after_watermark(src, tgt)) == []
    assert rows(inc.rows_after_watermark(src, tgt, eager=False)) == []
    assert rows(inc.rows_after_watermark(src, tgt, bootstrap=True)) == [(d(1), "p")]
    assert rows(inc.rows_after_watermark(src, tgt, bootstrap=True, eager=False)) == [(d(1), "p")]


def test_no_shrink_guard(spark):
    ex = spark.createDataFrame([(d(1), "a"), (d(1), "b"), (d(1), "c")], T)
    b = spark.createDataFrame([(d(2), "x")], T)
    merged = inc.upsert(ex, b, keep="first")
    assert merged.count() == 2
    with pytest.raises(ValueError):
        inc.assert_no_shrink(ex, merged)


def test_nothing_new(spark):
    ex = spark.createDataFrame([(d(1), "a"), (d(2), "b")], T)
    b = spark.createDataFrame([(d(2), "x")], T)
    merged = inc.upsert(ex, b, keep="first")
    s = inc.load_stats(ex, merged).first()
    assert (s["rows_added"], s["changed"]) == (0, False)
    assert rows(merged) == [(d(1), "a"), (d(2), "b")]


def test_keep_first_order_cols(spark):
    ex = spark.createDataFrame([], "datetime timestamp_ntz, v string, seq int")
    b = spark.createDataFrame([(d(1), "late", 2), (d(1), "early", 1)], "datetime timestamp_ntz, v string, seq int")
    assert rows(inc.upsert(ex, b, keep="first", order_cols=["seq"]))[0][1] == "early"
    assert rows(inc.upsert(ex, b, keep="last", order_cols=["seq"]))[0][1] == "late"
