"""Drift: golden classification, period split, KS exactness and invariants."""
import datetime as dt

from pyspark.sql import functions as F

from driftline import fixed
from driftline.operators import drift

# Golden metric triples with their labels (copied from the original's
# checked-in drift output: 44 features, 36 significant).
GOLDEN = [
    ("temp_C", 0.04002782014769881, 0.4917104005416598, 0.3474531021962767, "variance_shift"),
    ("humidity_%", 0.005899509898275515, 0.06215680222398834, 0.06359646120440625, "no_drift"),
    ("windspeed_kph", 0.0044640536728702395, 0.3620512445332092, 0.08917359648858598, "variance_shift"),
    ("precip_mm", 1.0, 1.0, 0.06848681166126794, "mean_shift"),
    ("pm10", 0.06577214562703225, 0.027183126455384777, 0.08492945135525137, "no_drift"),
    ("pm2_5", 0.038943018352513646, 0.4511463914035868, 0.09857095526123398, "variance_shift"),
    ("co", 0.058369931460789996, 0.7913822184868625, 0.07109901453688162, "variance_shift"),
    ("no2", 0.20707784490671133, 0.4136166921403124, 0.1282744948782752, "mean_shift"),
    ("so2", 0.044773828523360475, 0.6300829072661782, 0.11978346645345542, "variance_shift"),
    ("o3", 0.2357509009479388, 0.3005599494834152, 0.2508207629056239, "mean_shift"),
    ("log_co", 0.002239842328701212, 0.22374290971768568, 0.07178903039081731, "variance_shift"),
    ("log_pm2_5", 0.007785104032277678, 0.40336664664503163, 0.09857095526123398, "variance_shift"),
    ("log_pm10", 0.018274346153960584, 0.1813560717523996, 0.08492945135525137, "variance_shift"),
    ("log_precip_mm", 1.0, 1.0, 0.06848681166126794, "mean_shift"),
    ("log_so2", 0.007220786158037963, 0.4718430451822078, 0.11978346645345542, "variance_shift"),
    ("log_windspeed_kph", 0.00980237355162504, 0.49512549713623794, 0.08917359648858598, "variance_shift"),
    ("log_no2", 0.058618220551273144, 0.22647159059905153, 0.12873724360571617, "variance_shift"),
    ("scaled_temp_C", 0.9087631865356853, 0.111463575931623, 0.06580341667374025, "mean_shift"),
    ("scaled_humidity_%", 0.9720980244697678, 0.003391216764545001, 0.09446645619357683, "mean_shift"),
    ("scaled_log_windspeed_kph", 0.48787019434065154, 0.03810457134636779, 0.08375204335051983, "mean_shift"),
    ("scaled_log_pm2_5", 0.5806610396705922, 0.05797334943938132, 0.04364624091958303, "mean_shift"),
    ("scaled_log_pm10", 1.0879881918327927, 0.05938873257627852, 0.046680120150379645, "mean_shift"),
    ("scaled_log_precip_mm", 1.0, 1.0, 0.18047200370198982, "mean_shift"),
    ("scaled_log_co", 0.06879841513895706, 0.025183189022000684, 0.09441169303056605, "no_drift"),
    ("scaled_log_no2", 0.15690040066200528, 0.025785928067179737, 0.052345369363843715, "mean_shift"),
    ("scaled_log_so2", 0.9618432784021785, 0.0049649693663781, 0.0659074666834607, "mean_shift"),
    ("scaled_o3", 0.7858555453976506, 0.04958496265740762, 0.08233641558669146, "mean_shift"),
    ("aqi_us_lag1", 0.02480936257813384, 0.5110108993476578, 0.18463674224895882, "variance_shift"),
    ("aqi_us_lag12", 0.02518151295049848, 0.5065243052208759, 0.18463674224895882, "variance_shift"),
    ("aqi_us_lag24", 0.028153193071370645, 0.46865860611758603, 0.18463674224895882, "variance_shift"),
    ("scaled_log_pm2_5_lag1", 0.48412307928515846, 0.0617481830366127, 0.04410898964702403, "mean_shift"),
    ("scaled_log_pm2_5_lag12", 0.3424387732131549, 0.03641362928863022, 0.06741345366625685, "mean_shift"),
    ("scaled_log_pm2_5_lag24", 0.628378001837243, 0.061405266280194194, 0.06741345366625685, "mean_shift"),
    ("scaled_log_pm10_lag1", 1.1183673581046447, 0.0595092281533365, 0.04621737142293865, "mean_shift"),
    ("scaled_log_pm10_lag12", 0.047130192745718086, 0.06410727106077095, 0.056343080263629865, "no_drift"),
    ("scaled_log_pm10_lag24", 1.006483825640661, 0.07110756359821217, 0.056343080263629865, "mean_shift"),
    ("hour_sin", 11.786982253585228, 0.0007307072836630965, 0.037660627202505965, "mean_shift"),
    ("hour_cos", 11.786982252348201, 0.010169288436105832, 0.0394787642144635, "mean_shift"),
    ("hour", 0.005451888181554364, 0.015034971995931786, 0.005227143909377918, "no_drift"),
    ("day_of_week", 0.001972386587771139, 0.009525976981598183, 0.007097305926195685, "no_drift"),
    ("is_weekend", 0.016385980883022278, 0.004409641399397439, 0.004731537284130457, "no_drift"),
    ("log_pm2_5_scaled_log_windspeed_kph", 0.6187628165119393, 0.021474337329470277, 0.08025541539228223, "mean_shift"),
    ("scaled_temp_C_scaled_o3", 0.10447963294991923, 0.14047144391269653, 0.08736367395108006, "no_drift"),
    ("scaled_temp_C_scaled_log_windspeed_kph", 0.3249351798395115, 0.21075021101703342, 0.1695686579465457, "mean_shift"),
]
HAND = [
    ("dist_only", 0.10, 0.10, 0.25, "distribution_shift"),
    ("strict", 0.15, 0.15, 0.2, "no_drift"),
    ("nulls", None, None, 0.1, "no_drift"),
]
SCHEMA = "feature string, mean_shift double, variance_shift double, ks_statistic double, expected string"


def test_golden_labels(spark):
    df = spark.createDataFrame(GOLDEN + HAND, SCHEMA)
    out = drift.label_drift(df, [g[0] for g in GOLDEN]).collect()
    for r in out:
        assert r["drift_type"] == r["expected"], r["feature"]
        assert r["is_significant"] == (r["expected"] != "no_drift")
    sig = [r for r in out if r["is_significant"] and r["feature"] not in dict((h[0], 1) for h in HAND)]
    assert len(sig) == 36
    types = [r["drift_type"] for r in sig]
    assert types.count("mean_shift") == 22 and types.count("variance_shift") == 14


def test_registry_order_and_missing_feature(spark):
    assert len(fixed.DRIFT_FEATURES) == 45
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1), 1.0, 2.0)], "datetime timestamp_ntz, o3 double, temp_C double")
    assert drift.present_features(df) == ["temp_C", "o3"]


def _hourly(spark, start, end, value=lambda i, t: float(i)):
    n = int((end - start).total_seconds() // 3600) + 1
    rows = [(start + dt.timedelta(hours=i), value(i, start + dt.timedelta(hours=i))) for i in range(n)]
    return spark.createDataFrame(rows, "datetime timestamp_ntz, x double")


def test_periods_share_boundary(spark):
    df = _hourly(spark, dt.datetime(2025, 4, 1), dt.datetime(2025, 9, 24, 23))
    b = drift.period_bounds(df, "datetime").first()
    assert (b["recent_rows"], b["baseline_rows"]) == (169, 2161)
    assert b["recent_start"] == dt.datetime(2025, 9, 17, 23) == b["baseline_end"]
    assert b["baseline_start"] == dt.datetime(2025, 6, 19, 23)


def test_ks_hand_case(spark):
    # recent all zero; 148 of the 2,161 baseline values positive
    start = dt.datetime(2025, 4, 1)
    end = dt.datetime(2025, 9, 24, 23)
    bstart = dt.datetime(2025, 6, 19, 23)
    rstart = dt.datetime(2025, 9, 17, 23)

    def v(i, t):
        if bstart <= t < rstart and (t - bstart).total_seconds() // 3600 < 148:
            return 1.5
        return 0.0
    df = _hourly(spark, start, end, v)
    for vb in (1, 8):
        r = drift.drift_report(df, "datetime", ["x"], value_buckets=vb).first()
        assert abs(r["ks_statistic"] - 148 / 2161) < 1e-15
        assert abs(r["ks_statistic"] - 0.06848681166126794) < 1e-15
        assert r["mean_shift"] == 1.0 and r["variance_shift"] == 1.0


def test_ks_bucketed_equals_plain_and_invariants(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    feats = ["l_quantity", "l_extendedprice", "l_discount"]
    fl = drift.split_periods(li, "l_shipdate")
    lv = drift.long_values(fl, feats)
    plain = {r["feature"]: r["ks_statistic"] for r in drift.ks_statistic(lv, value_buckets=1).collect()}
    for vb in (3, 16):
        b = {r["feature"]: r["ks_statistic"] for r in drift.ks_statistic(lv, value_buckets=vb).collect()}
        assert b.keys() == plain.keys()
        assert all(abs(b[k] - plain[k]) < 1e-12 for k in plain)
    assert all(0.0 <= v <= 1.0 for v in plain.values())
    # strictly increasing transform leaves KS unchanged
    lv2 = lv.withColumn("value", F.exp(F.col("value") / 1e5) * 3 + 7)
    t = {r["feature"]: r["ks_statistic"] for r in drift.ks_statistic(lv2, value_buckets=1).collect()}
    assert all(abs(t[k] - plain[k]) < 1e-12 for k in plain)


def test_single_row_variance_is_null_not_significant(spark):
    rows = [(dt.datetime(2025, 1, 1), 1.0), (dt.datetime(2025, 1, 2), 2.0), (dt.datetime(2025, 1, 20), 5.0)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, x double")
    r = drift.drift_report(df, "datetime", ["x"]).first()
    assert r["variance_shift"] is None and r["n_recent"] == 1


def test_empty_period_all_zero(spark):
    rows = [(dt.datetime(2025, 1, 20), 5.0), (dt.datetime(2025, 1, 21), 6.0)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, x double")
    r = drift.drift_report(df, "datetime", ["x"]).first()
    assert (r["mean_shift"], r["variance_shift"], r["ks_statistic"]) == (0.0, 0.0, 0.0)


def test_keys_empty_equals_constant_key(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").withColumn("k", F.lit(1))
    feats = ["l_quantity", "l_tax"]
    a = {r["feature"]: (r["mean_shift"], r["ks_statistic"]) for r in drift.drift_report(li, "l_shipdate", feats).collect()}
    b = {r["feature"]: (r["mean_shift"], r["ks_statistic"])
         for r in drift.drift_report(li, "l_shipdate", feats, keys=["k"], scope="key").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert abs(a[k][0] - b[k][0]) < 1e-12 and abs(a[k][1] - b[k][1]) < 1e-12


def test_summary_lines(spark):
    df = spark.createDataFrame(GOLDEN[:4], "feature string, mean_shift double, variance_shift double, ks_statistic double, e string")
    rep = drift.label_drift(df, [g[0] for g in GOLDEN])
    text = drift.summary_lines(rep).first()["summary"].split("\n")
    assert text[0] == ("- Feature: temp_C, Drift Type: variance_shift, Mean Shift: 0.040, "
                       "Variance Shift: 0.492, KS Statistic: 0.347")
    assert len(text) == 3
    none = drift.label_drift(df.limit(0), [g[0] for g in GOLDEN])
    found = drift.summary_lines(none).collect()
    assert [r["summary"] for r in found] in ([], ["No significant drift detected."]), found


def test_nested_report(spark):
    df = spark.createDataFrame(GOLDEN, SCHEMA)
    rep = drift.label_drift(df, [g[0] for g in GOLDEN])
    n = drift.nested_report(rep, features_to_add=["wind_direction"], reasoning="r").first()
    assert n["seasonal_shift_detected"] is True
    assert len(n["detailed_analysis"]["drift_metrics"]) == 44
    sig = n["detailed_analysis"]["significant_drifts"]
    assert len(sig) == 36 and sig[0]["feature"] == "temp_C" and sig[-1]["feature"].startswith("scaled_temp_C")


def test_keyed_ks_ranges_equal_plain(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    fl = drift.split_periods(li, "l_shipdate", keys=["l_returnflag"], scope="key")
    lv = drift.long_values(fl, ["l_quantity", "l_extendedprice"], ["l_returnflag"])

    def ks(vb):
        return {(r["l_returnflag"], r["feature"]): r["ks_statistic"]
                for r in drift.ks_statistic(lv, ["l_returnflag"], value_buckets=vb).collect()}
    plain = ks(1)
    ranged = ks(8)
    assert plain.keys() == ranged.keys() and len(plain) == 6
    assert all(abs(plain[k] - ranged[k]) < 1e-12 for k in plain)
