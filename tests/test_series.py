"""Lags by the clock and after back-fills, partition-wise loads, daily drift state."""
import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from driftline.operators import drift, features, partitioned, rolling, timelags
from driftline.session import scratch_dir

START = dt.datetime(2025, 1, 1)


def _hours(n, seed, keys=("a", "b", None)):
    """Rows (k, t, i, v): some hours missing, some values NULL, one row without a time."""
    r = random.Random(seed)
    rows = [(k, START + dt.timedelta(hours=h), i, None if r.random() < 0.1 else round(r.random(), 3))
            for i, (k, h) in enumerate((k, h) for k in keys for h in range(n) if r.random() < 0.8)]
    return [*rows, ("a", None, -1, 9.0)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k string, datetime timestamp_ntz, i int, v double").repartition(3)


def test_lag_by_clock(spark):
    rows = _hours(60, 1)
    at = {(k, t): v for k, t, _, v in rows}
    want = Counter((k, t, i, v, *[at.get((k, t - dt.timedelta(hours=h))) if t else None for h in (1, 24)])
                   for k, t, i, v in rows)
    found = timelags.lag_by_clock(_frame(spark, rows), ["v"], [1, 24], ["k"])
    assert found.columns == ["k", "datetime", "i", "v", "v_1h_ago", "v_24h_ago"]
    assert Counter(map(tuple, found.collect())) == want


@pytest.mark.parametrize("rows_per_task", [4_000_000, 20])
def test_lag_as_of(spark, rows_per_task):
    rows = _hours(60, 2)
    rows += [("b", START + dt.timedelta(hours=5), 1000 + x, float(x)) for x in range(3)]  # one time three times
    want = Counter()
    for k, t, i, v in rows:
        as_of = []
        for h in (1, 24):
            earlier = [(t2, i2, v2) for k2, t2, i2, v2 in rows if t and t2 and k2 == k and t2 <= t - dt.timedelta(hours=h)]
            as_of.append(max(earlier, key=lambda x: x[:2])[2] if earlier else None)
        want[k, t, i, v, *as_of] += 1
    found = timelags.lag_as_of(_frame(spark, rows), ["v"], [1, 24], ["k"], ["datetime", "i"], rows_per_task=rows_per_task)
    assert Counter(map(tuple, found.collect())) == want


@pytest.mark.parametrize("keys", [["k"], []])
def test_refresh_lags_equals_a_rebuild(spark, keys):
    rows = _hours(400, 3)
    r = random.Random(4)
    late = [x for x in rows if x[1] and r.random() < 0.01]
    held = [x for x in rows if x not in late]
    corrected = [(k, t, i, -1.0) for k, t, i, _ in r.sample([x for x in held if x[1]], 3)]
    order, lags = ["datetime", "i"], [1, 12, 24]
    table = features.lag_features(_frame(spark, held), ["v"], lags, keys, order).cache()
    came = _frame(spark, late + corrected)
    every = [x for x in held if x[2] not in {c[2] for c in corrected}] + late + corrected
    want = Counter(map(tuple, features.lag_features(_frame(spark, every), ["v"], lags, keys, order).collect()))
    assert Counter(map(tuple, timelags.refresh_lags(table, came, ["v"], lags, keys, order).collect())) == want
    changed = timelags.changed_lags(table, came, ["v"], lags, keys, order).count()
    assert len(late) + 3 <= changed <= 25 * (len(late) + 3) and changed < len(rows)
    if not keys:
        again = timelags.refresh_lags(table, came, ["v"], lags, keys, order, rows_per_task=50)
        assert Counter(map(tuple, again.collect())) == want
        assert timelags.refresh_lags(table, came.where("false"), ["v"], lags, keys, order).count() == len(held)


def _files(spark, path):
    return {(r.part, r.f) for r in spark.read.parquet(path).select("part", F.input_file_name().alias("f")).distinct().collect()}


def test_upsert_touches_only_its_partitions(spark):
    rows = [(k, START + dt.timedelta(days=d), d, float(d)) for d in range(6) for k in ("a", None)] + [("n", None, 0, 0.0)]
    path, day = scratch_dir(spark, "upsert-test"), F.date_format("datetime", "yyyy-MM-dd")
    partitioned.upsert_partitions(spark, _frame(spark, rows), path, day, ["k"])
    before = _files(spark, path)
    batch = [("a", START + dt.timedelta(days=2), 2, -1.0), ("c", START + dt.timedelta(days=4), 4, -1.0),
             ("d", START + dt.timedelta(days=9), 9, -1.0), ("n", None, 0, -1.0)]
    written = partitioned.upsert_partitions(spark, _frame(spark, batch), path, day, ["k"], keep="last")
    assert written.count() == 4
    after = _files(spark, path)
    touched = {dt.date(2025, 1, 3), dt.date(2025, 1, 5), dt.date(2025, 1, 10), None}
    same = {x for x in before if str(x[0]) not in {str(t) for t in touched}}
    assert len(same) >= 4 and same <= after and not (before - same) & after
    want = {(k, t): v for k, t, _, v in rows} | {(k, t): v for k, t, _, v in batch}
    assert {(r.k, r.datetime): r.v for r in spark.read.parquet(path).collect()} == want
    assert partitioned.upsert_partitions(spark, _frame(spark, batch).where("false"), path, day, ["k"]).count() == 0
    assert _files(spark, path) == after
    partitioned.upsert_partitions(spark, _frame(spark, batch), path, day, ["k"], keep="first")
    assert {(r.k, r.datetime): r.v for r in spark.read.parquet(path).collect()} == want


def _report(df):
    return {(r.k, r.feature): tuple(x if not isinstance(x, float) else round(x, 9) for x in (
        r.n_recent, r.n_baseline, r.mean_recent, r.var_baseline, r.mean_shift, r.variance_shift, r.ks_statistic,
        r.drift_type)) for r in df.collect()}


def test_rolling_report_after_each_day(spark):
    r = random.Random(6)
    rows = [(k, START + dt.timedelta(hours=h, minutes=30), r.choice([1, 2, 2, 7]), None if r.random() < 0.05 else r.gauss(5 + h / 400, 1))
            for h in range(0, 24 * 104, 2) for k in ("a", "b")]
    path, feats = scratch_dir(spark, "rolling-test"), ["i", "v"]
    have = [x for x in rows if x[1] < START + dt.timedelta(days=101, hours=24)]
    rolling.write_days(_frame(spark, have), path, "datetime", feats, ["k"])
    for day in (102, 103):
        new = [x for x in rows if START + dt.timedelta(days=day) <= x[1] < START + dt.timedelta(days=day + 1)]
        if day == 103:  # a late row of an old day comes with it: that day is made anew
            old = START + dt.timedelta(days=50)
            have.append(("a", old + dt.timedelta(minutes=1), 7, 100.0))
            new += [x for x in have if old <= x[1] < old + dt.timedelta(days=1)]
        have = have + [x for x in new if x not in have]
        rolling.write_days(_frame(spark, new), path, "datetime", feats, ["k"])
        table = _frame(spark, have)
        found = rolling.rolling_report(spark, path, table, "datetime", feats, ["k"])
        assert _report(found) == _report(drift.drift_report(table, "datetime", feats, ["k"]))
    assert rolling.rolling_report(spark, path, table.where("false"), "datetime", feats, ["k"]).count() == 0
