"""Probe classification, attempt resolution, dispositions and summary."""
import json

from pyspark.sql import functions as F

from driftline import fixed
from driftline.operators import discovery as disc
from driftline.sources import sinks

PROBE_SCHEMA = ("case string, candidate_api struct<name: string, url: string, endpoint: string>, "
                "outcome string, http_status int")


def _cand(url="https://api.x.com", ep="/v1"):
    return ("c", url, ep)


def test_classify_probes(spark):
    rows = [
        ("200", _cand(), "http", 200), ("401", _cand(), "http", 401), ("403", _cand(), "http", 403),
        ("404", _cand(), "http", 404), ("410", _cand(), "http", 410), ("500", _cand(), "http", 500),
        ("301", _cand(), "http", 301), ("timeout", _cand(), "timeout", None),
        ("connection", _cand(), "connection", None), ("ftp", _cand("ftp://x"), "http", 200),
        ("none", None, None, None),
    ]
    out = {r["case"]: r for r in disc.classify_probes(spark.createDataFrame(rows, PROBE_SCHEMA)).collect()}
    assert out["200"]["is_valid"] and out["200"]["reason"] is None
    assert out["200"]["probe_url"] == "https://api.x.com/v1"
    assert out["401"]["is_valid"] and out["401"]["reason"] == fixed.REASON_401
    assert out["403"]["is_valid"] and out["403"]["reason"] == fixed.REASON_403
    assert not out["404"]["is_valid"] and out["404"]["reason"] == "API endpoint not found (status: 404)"
    assert out["410"]["reason"] == "API endpoint not found (status: 410)"
    assert out["500"]["reason"] == "API returned unexpected status: 500"
    assert out["301"]["reason"] == "API returned unexpected status: 301"
    assert out["timeout"]["reason"] == fixed.REASON_TIMEOUT
    assert out["connection"]["reason"] == fixed.REASON_CONNECTION
    assert not out["ftp"]["is_valid"] and out["ftp"]["reason"] == fixed.REASON_BAD_URL
    assert not out["none"]["is_valid"] and out["none"]["reason"] == fixed.REASON_NO_CANDIDATE


def _resp(url="https://a.com", conf=0.5):
    return ('```json\n{"search_keywords": ["k"], "candidate_api": {"name": "n", "url": "%s", '
            '"endpoint": "/e"}, "confidence": %s}\n```' % (url, conf))


LOG_SCHEMA = "feature string, attempt_no int, response_text string, outcome string, http_status int"


def test_resolve_attempts(spark):
    rows = [
        # invalid, invalid, 200 -> found after 3
        ("f1", 1, _resp(), "http", 404), ("f1", 2, _resp(), "http", 500), ("f1", 3, _resp(conf=0.9), "http", 200),
        # three invalid then 200 -> not found, 3 attempts, 4th ignored
        ("f2", 1, _resp(), "http", 404), ("f2", 2, _resp(), "timeout", None),
        ("f2", 3, _resp(conf=0.3), "connection", None), ("f2", 4, _resp(), "http", 200),
        # found at once; later attempts ignored
        ("f3", 1, _resp(conf=0.87), "http", 401), ("f3", 2, _resp(), "http", 404),
        # malformed second response re-probes the first candidate
        ("f4", 1, _resp(conf=0.4), "http", 404), ("f4", 2, "not json", "http", 200),
        # malformed first response: no candidate
        ("f5", 1, "garbage {", "http", 200),
    ]
    out = {r["feature"]: r for r in disc.resolve_attempts(spark.createDataFrame(rows, LOG_SCHEMA)).collect()}
    assert (out["f1"]["api_found"], out["f1"]["search_attempts"], out["f1"]["confidence_score"]) == (True, 3, 0.9)
    assert out["f1"]["api_url"] == "https://a.com/e"
    assert (out["f2"]["api_found"], out["f2"]["search_attempts"]) == (False, 3)
    assert out["f2"]["reason"] == fixed.REASON_CONNECTION and out["f2"]["confidence_score"] == 0.3
    assert (out["f3"]["api_found"], out["f3"]["search_attempts"], out["f3"]["reason"]) == (True, 1, fixed.REASON_401)
    assert (out["f4"]["api_found"], out["f4"]["search_attempts"], out["f4"]["confidence_score"]) == (True, 2, 0.4)
    assert (out["f5"]["api_found"], out["f5"]["reason"]) == (False, fixed.REASON_NO_CANDIDATE)
    assert out["f5"]["confidence_score"] == 0.0 and out["f5"]["search_keywords"] == []


def _golden_dispositions(spark):
    # six requested features with the golden outcomes: 1 existing, 3 found, 2 not found
    matches = spark.createDataFrame([
        ("construction_activity_index", "missing", None, 0.4),
        ("traffic_volume_index", "missing", None, 0.0),
        ("industrial_emissions_index", "missing", None, 0.4),
        ("sea_surface_temperature", "missing", None, 0.0),
        ("relative_humidity_at_10m", "already_exists", "humidity_%", 0.8),
        ("wind_direction", "missing", None, 0.0),
    ], "feature string, status string, mapped_to string, confidence double") \
        .withColumn("similarity_scores", F.create_map().cast("map<string,double>"))
    log = spark.createDataFrame([
        ("construction_activity_index", 1, _resp(conf=0.4), "http", 404),
        ("construction_activity_index", 2, _resp(conf=0.4), "http", 404),
        ("construction_activity_index", 3, _resp(conf=0.4), "http", 404),
        ("traffic_volume_index", 1, _resp(), "http", 500),
        ("traffic_volume_index", 2, _resp(conf=0.87), "http", 200),
        ("industrial_emissions_index", 1, _resp(conf=0.89), "http", 200),
        ("sea_surface_temperature", 1, _resp(conf=0.91), "http", 403),
        ("wind_direction", 1, _resp("ftp://x", 0.7), "http", 200),
        ("wind_direction", 2, _resp("ftp://x", 0.7), "http", 200),
        ("wind_direction", 3, _resp("ftp://x", 0.7), "http", 200),
    ], LOG_SCHEMA)
    resolved = disc.resolve_attempts(log)
    d = disc.dispositions(matches.withColumnRenamed("feature", "original_feature")
                          .withColumn("feature", F.col("original_feature")), resolved).drop("feature")
    return d


def test_golden_dispositions_and_summary(spark):
    d = _golden_dispositions(spark)
    c = {r["original_feature"]: r for r in disc.categorize(d).collect()}
    want = {"construction_activity_index": ("not_found", 3, 0.4), "traffic_volume_index": ("found", 2, 0.87),
            "industrial_emissions_index": ("found", 1, 0.89), "sea_surface_temperature": ("found", 1, 0.91),
            "relative_humidity_at_10m": ("already_exists", 0, 0.8), "wind_direction": ("not_found", 3, 0.7)}
    for f, (final, att, conf) in want.items():
        assert (c[f]["final_status"], c[f]["search_attempts"], c[f]["report_confidence"]) == (final, att, conf), f
    s = disc.disposition_summary(d).first()
    assert (s["total_features"], s["already_exists"], s["new_apis_found"], s["not_found"]) == (6, 1, 3, 2)
    assert (round(s["already_exists_rate"], 2), round(s["api_discovery_rate"], 2),
            round(s["overall_success_rate"], 2)) == (16.67, 50.0, 66.67)
    rep = {r["category"]: r["count"] for r in disc.disposition_report(d).groupBy("category").count().collect()}
    assert [rep[k] for k in (fixed.CATEGORY_EXISTING, fixed.CATEGORY_NEW, fixed.CATEGORY_NOT_FOUND)] == [1, 3, 2]
    catalog = spark.createDataFrame([("a",), ("b",)], "column string")
    meta = disc.report_metadata(d, catalog, "2025-01-01T00:00:00").first()
    assert (meta["total_columns"], meta["total_features"], meta["run_at"]) == (2, 6, "2025-01-01T00:00:00")


def test_zero_features_rates(spark):
    empty = spark.createDataFrame([], "final_status string")
    s = disc.disposition_summary(empty).first()
    assert (s["total_features"], s["already_exists_rate"], s["overall_success_rate"]) == (0, 0.0, 0.0)


def test_remaining(spark):
    req = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos int, feature string")
    done = spark.createDataFrame([("b",)], "feature string")
    assert sorted(r["feature"] for r in disc.remaining(req, done).collect()) == ["a", "c"]


def test_whole_candidate_and_suggestions_are_kept(spark):
    text = ('{"search_keywords": ["k"], "candidate_api": {"name": "n", "url": "%s", "params": {"q": [1, 2]}, '
            '"coverage_notes": "all"}, "suggestions": ["s1", "s2"]}')
    rows = [("found", 1, text % "https://a", "http", 200), ("lost", 1, text % "https://a", "http", 404),
            ("lost", 2, "not json", "http", 404)]
    out = {r["feature"]: r for r in disc.resolve_attempts(spark.createDataFrame(rows, LOG_SCHEMA)).collect()}
    assert out["found"]["api_details_json"] == \
        '{"name":"n","url":"https://a","params":{"q":[1,2]},"coverage_notes":"all"}'
    assert out["lost"]["api_details_json"] is None and out["lost"]["suggestions"] == ["s1", "s2"]


def test_whole_report_round_trip(spark, tmp_dir):
    """Every part of the report, read back with its nested schema."""
    d = _golden_dispositions(spark).cache()
    catalog = spark.createDataFrame([("a",), ("b",)], "column string")
    place = {"lat": 1.5, "lon": 2.5, "city": "x", "country": "y"}
    header = disc.report_header(d, catalog, "2025-01-01T00:00:00", "table", place)
    sinks.write_disposition_report(disc.disposition_report(d), header, tmp_dir, mappings=disc.detailed_mappings(d))
    path = f"{tmp_dir}/detailed_feature_mappings"
    back = {r.original_feature: r for r in spark.read.schema(disc.mapping_schema()).json(path).collect()}
    want = {r.original_feature: r for r in d.select(*fixed.MAPPING_FIELDS).collect()}
    assert back == want and len(next(iter(back.values()))) == 13
    assert back["traffic_volume_index"].api_details.url.startswith("http") and back["wind_direction"].api_details is None
    line = json.loads(next(x.value for x in spark.read.text(path).collect() if "wind_direction" in x.value))
    assert list(line) == fixed.MAPPING_FIELDS and line["mapped_to"] is None
    meta = json.loads(spark.read.text(f"{tmp_dir}/metadata").first().value)
    assert meta["location"] == place and meta["csv_columns_count"] == 2 and meta["total_features_processed"] == 6
    assert meta["processing_summary"]["not_found"] == 2
    fields = {}
    for r in spark.read.text(f"{tmp_dir}/results").withColumn("file", F.input_file_name()).collect():
        fields.setdefault(r.file.split("category=")[1].split("/")[0], set()).update(json.loads(r.value))
    common = {"original_feature", "confidence", "reasoning"}
    assert fields[fixed.CATEGORY_EXISTING] == common | {"mapped_to", "similarity_scores"}
    assert fields[fixed.CATEGORY_NEW] - {"reasoning"} == common - {"reasoning"} | {
        "api_details", "api_details_json", "search_attempts"}
    assert fields[fixed.CATEGORY_NOT_FOUND] == common | {"search_attempts", "suggested_alternatives"}
    assert disc.report_header(d, catalog, "").first().location is None
