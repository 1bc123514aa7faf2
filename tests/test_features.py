"""Feature operators: lag strategies agree, scaler invariants, feature table shape."""
import datetime as dt

from pyspark.sql import functions as F

from driftline import fixed
from driftline.operators import features, ranking
from driftline.operators.ranking import BUCKET, add_position, in_ranges
from driftline.plans import suite


def _events(spark):
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", "ts", "value")


def _lags(df, keys, method, rows_per_task=100, order=("ts", "event_id")):
    out = features.lag_features(df, ["value"], [1, 12, 24], keys=keys, order=order,
                                method=method, rows_per_task=rows_per_task)
    return sorted(tuple(r) for r in out.select("event_id", "value_lag1", "value_lag12", "value_lag24").collect())


def test_lag_ranked_equals_window_keyed(spark):
    ev = _events(spark)
    assert _lags(ev, ["user_id"], "ranked") == _lags(ev, ["user_id"], "window")


def test_lag_ranked_equals_window_global(spark):
    ev = _events(spark)
    w = _lags(ev, [], "window")
    assert _lags(ev, [], "ranked") == w
    assert _lags(ev, [], "ranked", rows_per_task=10) == w


def test_lag_hot_key(spark):
    # one key holding most rows: ranked plan cuts it into ranges, same answer
    ev = _events(spark).withColumn("user_id", F.when(F.col("event_id") % 10 < 7, F.lit(0)).otherwise(F.col("user_id")))
    assert _lags(ev, ["user_id"], "ranked") == _lags(ev, ["user_id"], "window")


def test_position_is_row_number(spark):
    ev = _events(spark)
    pos = {r["event_id"]: r["p"] for r in add_position(ev, ["user_id"], ["ts", "event_id"], pos_col="p").collect()}
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rn = {r["event_id"]: r["p"] for r in ev.select("event_id", F.row_number().over(w).alias("p")).collect()}
    assert pos == rn


def test_first_rows_have_null_lags(spark):
    rows = [(dt.datetime(2025, 1, 1) + dt.timedelta(hours=h), float(h)) for h in range(30)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, aqi_us double")
    out = features.lag_features(df, ["aqi_us"], [1, 12, 24], method="ranked").orderBy("datetime").collect()
    assert out[0]["aqi_us_lag1"] is None and out[1]["aqi_us_lag1"] == 0.0
    assert out[11]["aqi_us_lag12"] is None and out[12]["aqi_us_lag12"] == 0.0
    assert out[29]["aqi_us_lag24"] == 5.0


def test_scaler_population_std_and_zero_std(spark):
    df = spark.createDataFrame([(1.0, 5.0, "a"), (2.0, 5.0, "a"), (3.0, 5.0, "a"), (None, 5.0, "a")],
                               "x double, c double, k string")
    out = features.standard_scale(df, ["x", "c"]).collect()
    xs = [r["scaled_x"] for r in out if r["scaled_x"] is not None]
    assert abs(sum(xs)) < 1e-12
    assert abs(sum(v * v for v in xs) / len(xs) - 1.0) < 1e-12   # population std = 1
    assert all(r["scaled_c"] == 0.0 for r in out)
    assert [r["scaled_x"] for r in out][3] is None
    keyed = features.standard_scale(df, ["x"], keys=["k"]).collect()
    assert [r["scaled_x"] for r in keyed] == [r["scaled_x"] for r in out]


def test_feature_table_columns(spark):
    ft = suite.feature_table(spark, "/root/testdata/sf0.001")
    assert ft.columns == suite.FEATURE_COLUMNS and len(ft.columns) == 46
    sel = features.select_features(ft)
    assert sel.columns == fixed.SELECTED_COLUMNS and len(sel.columns) == 18


def test_history_supplies_lags(spark):
    rows = [(dt.datetime(2025, 1, 1) + dt.timedelta(hours=h), float(h)) + (1.0,) * 10 for h in range(30)]
    cols = ["datetime", "aqi_us", "pm10", "pm2_5", "co", "no2", "so2", "o3", "temp_C", "humidity_%",
            "windspeed_kph", "precip_mm"]
    raw = spark.createDataFrame(rows, ", ".join(f"`{c}` {'timestamp_ntz' if c == 'datetime' else 'double'}" for c in cols))
    old = features.build_features(raw.filter(F.col("aqi_us") < 26))
    new = raw.filter(F.col("aqi_us") >= 26)
    out = features.build_features(new, history=old).orderBy("datetime").collect()
    assert [r["aqi_us_lag1"] for r in out] == [25.0, 26.0, 27.0, 28.0]
    assert out[0]["aqi_us_lag24"] == 2.0


def test_auto_split_with_measured_ranges(spark):
    # a tiny per-task bound forces the split plan; a hot key holds 70 % of rows
    ev = _events(spark).withColumn("user_id", F.when(F.col("event_id") % 10 < 7, F.lit(0)).otherwise(F.col("user_id")))
    auto = features.lag_features(ev, ["value"], [1, 12, 24], keys=["user_id"], order=["ts", "event_id"],
                                 method="auto", rows_per_task=50)
    got = sorted(tuple(r) for r in auto.select("event_id", "value_lag1", "value_lag12", "value_lag24").collect())
    assert got == _lags(ev, ["user_id"], "window")
    # the order may be text
    text = ev.withColumn("ts", F.date_format("ts", fixed.FMT_ISO))
    assert _lags(text, [], "ranked") == _lags(text, [], "window") == _lags(text, [], "auto")


def test_one_far_timestamp_leaves_ranges_even(spark):
    rows = spark.range(20_001).selectExpr(
        "id", "CASE WHEN id = 0 THEN TIMESTAMP'1970-01-01' ELSE TIMESTAMP'2025-01-01' + make_interval(0, 0, 0, 0, 0, id) END AS t")
    sizes = [r["count"] for r in in_ranges(rows, ["t", "id"], 20, "even").groupBy(BUCKET).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 3000
    # one instant for all rows: the tie-break column cuts it
    same = rows.withColumn("t", F.lit("2025-01-01"))
    assert max(r["count"] for r in in_ranges(same, ["t", "id"], 20, "same").groupBy(BUCKET).count().collect()) < 3000


def test_small_ranges_share_tasks(spark, monkeypatch):
    staged, stage = [], ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda df, name: [staged.append(stage(df, name)), staged[-1]][1])
    rows = spark.range(20_001).selectExpr("id", "id % 7 AS t", "IF(id % 3 = 0, NULL, id % 5) AS k", "id * 1.0D AS v")
    for keys in ([], ["k"]):
        out = features.lag_features(rows, ["v"], [1, 24], keys, ["t", "id"], method="ranked", rows_per_task=200)
        want = features.lag_features(rows, ["v"], [1, 24], keys, ["t", "id"], method="window")
        assert sorted(map(repr, out.collect())) == sorted(map(repr, want.select(*out.columns).collect()))
        files = staged[-1].select(F.input_file_name()).distinct().count()
        assert files <= spark.sparkContext.defaultParallelism  # 404 ranges
        sizes = [r["count"] for r in staged[-1].groupBy(BUCKET).count().collect()]
        assert len(sizes) > 400 and max(sizes) <= 50
    # ranges follow the order
    cut = in_ranges(rows, ["t", "id"], 404, "cut", 20_001).groupBy(BUCKET).agg(
        F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", "id")).alias("hi")).orderBy(BUCKET).collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(cut, cut[1:]))


def test_keyed_scaling_leaves_rows_in_place(spark):
    # the plan as made, before any run: an input above the broadcast threshold
    rows = spark.range(1_000_000).selectExpr("id", "IF(id % 2 = 0, NULL, id % 3) AS k", "id * 1.0D AS x", "id * 2.0D AS y")
    out = features.standard_scale(rows, ["x", "y"], keys=["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    got = {r["k"]: (r["n"], r["m"], r["s"]) for r in out.groupBy("k").agg(
        F.count("id").alias("n"), F.round(F.avg("scaled_x"), 6).alias("m"), F.round(F.stddev_pop("scaled_y"), 6).alias("s"))
        .collect()}
    assert set(got) == {None, 0, 1, 2} and got[None][0] == 500_000
    assert all(abs(m) < 1e-6 and s == 1.0 for _, m, s in got.values())


def test_lag_history_slice_is_exact(spark):
    # full history vs the bounded slice give the same lags for new rows, keyed and not
    ev = _events(spark).withColumnRenamed("ts", "datetime")
    cut = ev.agg(F.expr("percentile_approx(event_id, 0.8)")).first()[0]
    hist, new = ev.filter(F.col("event_id") < cut), ev.filter(F.col("event_id") >= cut)
    for keys in ([], ["user_id"]):
        sl = features.lag_history(hist, new, keys, "datetime", 24)
        full = hist.withColumn("_n", F.lit(False)).unionByName(new.withColumn("_n", F.lit(True)))
        part = sl.withColumn("_n", F.lit(False)).unionByName(new.withColumn("_n", F.lit(True)))

        def lags(df):
            out = features.lag_features(df, ["value"], [1, 12, 24], keys=keys, order=["datetime", "event_id"],
                                        method="window").filter("_n")
            return sorted(tuple(r) for r in out.select("event_id", "value_lag1", "value_lag12", "value_lag24").collect())
        assert lags(part) == lags(full)
        assert sl.count() < hist.count()
