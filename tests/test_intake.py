"""Schemas conformed to, rows set aside, shares of missing values."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from driftline.operators import intake


def test_conform_schema(spark):
    df = spark.createDataFrame([("1", "2024-01-02 03:04:05", 2.0, "x", None), ("n/a", "soon", 2.5, None, 7),
                                (None, None, 3e12, "", None)], "ID string, at string, n double, extra string, more int")
    out = intake.conform_schema(df, "id BIGINT, time TIMESTAMP_NTZ, n INT, absent DATE", {"at": "time"})
    assert out.dtypes == [("id", "bigint"), ("time", "timestamp_ntz"), ("n", "int"), ("absent", "date"),
                          ("rescued", "map<string,string>")]
    assert [tuple(r) for r in out.collect()] == [
        (1, dt.datetime(2024, 1, 2, 3, 4, 5), 2, None, {"extra": "x"}),
        (None, None, None, None, {"id": "n/a", "time": "soon", "n": "2.5", "more": "7"}),
        (None, None, None, None, {"n": "3.0E12", "extra": ""})]
    same = intake.conform_schema(df, df.schema)
    assert [r["rescued"] for r in same.collect()] == [None] * 3
    assert intake.conform_schema(df.limit(0), "id INT").count() == 0
    assert intake.conform_schema(df, "id INT", rescue_col=None).columns == ["id"]


def test_conform_schema_refuses_clashes(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    for schema, renames in (("a INT", {"b": "A"}), ("rescued INT", None), ("a INT", {"c": "a"})):
        with pytest.raises(ValueError):
            intake.conform_schema(df, schema, renames)


ROWS = [(1, "a", 5), (2, "b", -1), (3, "b", None), (4, None, 5), (5, None, 6), (6, "z", -2), (6, "c", 1)]


def test_broken_rules_and_quarantine(spark, tmp_dir):
    df = spark.createDataFrame(ROWS, "id int, k string, n int")
    known = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "code string")
    how = {"rules": {"positive": "n > 0", "small": F.col("n") < 6}, "unique": {"k once": ["k"], "id once": ["id"]},
           "references": {"k known": (["k"], known, ["code"])}}
    want = {(1, "a"): [], (2, "b"): ["positive", "k once"], (3, "b"): ["positive", "small", "k once"], (4, None): ["k once"],
            (5, None): ["small", "k once"], (6, "z"): ["positive", "id once", "k known"], (6, "c"): ["id once"]}
    marked = intake.broken_rules(df, **how)
    assert {(r["id"], r["k"]): r["errors"] for r in marked.collect()} == want and marked.count() == len(ROWS)
    path = os.path.join(tmp_dir, "q")
    sound, rejected = intake.quarantine(df, path, **how)
    assert sound.columns == df.columns and [tuple(r) for r in sound.collect()] == [(1, "a", 5)]
    assert {(r["id"], r["k"]): r["errors"] for r in rejected.collect()} == {k: v for k, v in want.items() if v}
    assert {d for d in os.listdir(path) if "=" in d} == {"rejected=false", "rejected=true"}


def test_quarantine_of_one_kind_only(spark, tmp_dir):
    df = spark.createDataFrame(ROWS, "id int, k string, n int")
    for name, rules, n in (("all", {}, 7), ("none", {"never": "false"}, 0)):
        sound, rejected = intake.quarantine(df, os.path.join(tmp_dir, name), rules)
        assert (sound.count(), rejected.count()) == (n, 7 - n)
    sound, rejected = intake.quarantine(df.limit(0), os.path.join(tmp_dir, "empty"), {"never": "false"})
    assert (sound.count(), rejected.count()) == (0, 0)
    with pytest.raises(ValueError):
        intake.broken_rules(df.withColumn("errors", F.lit(1)), {})


def test_completeness_adds_up(spark, tmp_dir):
    df = spark.createDataFrame([("x", 1.0, "a"), ("x", float("nan"), " "), ("y", None, "b"), (None, 2.0, None)],
                               "p string, v double, t string")
    path = os.path.join(tmp_dir, "state")
    for load, rows, columns in (("1", df.where("p = 'x'"), ["v"]), ("2", df.where("p = 'y' OR p IS NULL"), ["v", "t"]),
                                ("2", df.where("p = 'y' OR p IS NULL"), ["v", "t"])):
        intake.record_load(rows, path, load, F.col("p"), columns, blank_is_missing=True)
    state = intake.read_state(spark, path)
    got = {r["column_name"]: tuple(r)[1:] for r in intake.completeness(state, threshold=0.5).collect()}
    assert got == {"v": (4, 2, 0.5, True), "t": (4, 3, 0.75, False)}
    by_part = {(r["part"], r["column_name"]): r["n_missing"] for r in intake.completeness(state, by_part=True).collect()}
    assert by_part == {("x", "v"): 1, ("y", "v"): 1, (None, "v"): 0, ("x", "t"): 2, ("y", "t"): 0, (None, "t"): 1}
    # one state of all rows says the same as the loads, when all had the column
    whole = intake.completeness(intake.completeness_state(df, F.col("p"), ["v"]))
    assert whole.first()["n_missing"] == 2
    assert intake.completeness(intake.completeness_state(df.limit(0))).count() == 0
