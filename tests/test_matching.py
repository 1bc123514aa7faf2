"""Feature-name matcher: golden statuses and candidate rules."""
import re

import pytest

from driftline import fixed
from driftline.operators import matching
from driftline.plans import suite

REQUESTED = ["construction_activity_index", "traffic_volume_index", "industrial_emissions_index",
             "sea_surface_temperature", "relative_humidity_at_10m", "wind_direction"]


def _run(spark, requested, catalog, **kw):
    req = spark.createDataFrame(list(enumerate(requested)), "pos int, feature string")
    cat = spark.createDataFrame([(c,) for c in catalog], "column_name string")
    return {r["feature"]: r for r in matching.match_features(req, cat, **kw).collect()}


def test_golden_statuses(spark):
    out = _run(spark, REQUESTED, suite.FEATURE_COLUMNS)
    assert out["relative_humidity_at_10m"]["status"] == "already_exists"
    assert out["relative_humidity_at_10m"]["mapped_to"] == "humidity_%"
    assert out["relative_humidity_at_10m"]["confidence"] == 0.8
    for f in REQUESTED:
        if f != "relative_humidity_at_10m":
            assert out[f]["status"] == "missing", f
            assert out[f]["mapped_to"] is None


def test_exact_alias_fuzzy(spark):
    out = _run(spark, ["pm25", "PM10 data", "air_temperature", "temperature", "pm2_5x", "nothing_like_it", "sst"],
               ["pm2_5", "pm10", "temp_C", "water_temp", "surface_temp"])
    assert out["pm25"]["mapped_to"] == "pm2_5" and out["pm25"]["confidence"] == 1.0
    assert out["PM10 data"]["mapped_to"] == "pm10"
    assert out["air_temperature"]["mapped_to"] == "temp_C" and out["air_temperature"]["confidence"] == 0.8
    # two aliases of one canonical (temperature, temp_C) do not match each other
    assert out["temperature"]["status"] == "missing"
    # fuzzy scores are capped at 0.7 and never pass the strict > 0.7 gate
    assert out["pm2_5x"]["status"] == "missing" and 0 < out["pm2_5x"]["confidence"] <= 0.7
    assert out["nothing_like_it"]["confidence"] == 0.0 and out["nothing_like_it"]["similarity_scores"] == {}
    # two aliases of one canonical do not match each other
    assert out["sst"]["status"] == "missing"


def test_deletion_variants_exact_for_two_edits(spark):
    # brute force over a small catalog: every pair within 2 edits is found
    names = ["abc", "abd", "xbc", "abcde", "zzzz", "ab", "bca", "temp", "tmp", "temps"]
    req = spark.createDataFrame([(n,) for n in names], "feature string")
    cat = spark.createDataFrame([(n,) for n in names], "column_name string")
    got = {(r["feature"], r["column_name"]) for r in matching.match_candidates(req, cat).collect()}

    def lev(a, b):
        d = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            p, d[0] = d[0], i
            for j, cb in enumerate(b, 1):
                p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (ca != cb))
        return d[-1]
    want = {(a, b) for a in names for b in names if lev(a, b) <= 2}
    assert got == want


def _plain_candidates(requested, catalog):
    """SURVEY 2.14 (1)-(3) pair by pair."""
    def norm(x):
        x = re.sub(r"^_+|_+$", "", re.sub(r"[^a-z0-9]+", "_", x.lower()))
        return re.sub(r"_(index|data|measurements)$", "", x)

    def lev(a, b):
        d = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            p, d[0] = d[0], i
            for j, cb in enumerate(b, 1):
                p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (ca != cb))
        return d[-1]

    flat = lambda x: norm(x).replace("_", "")
    alias = {(flat(c), flat(a)) for c, names in fixed.ALIASES.items() for a in names}
    out = {}
    for f in requested:
        for c in catalog:
            a, b = norm(f), norm(c)
            if flat(f) == flat(c):
                out[f, c] = 1.0
            elif (flat(f), flat(c)) in alias or (flat(c), flat(f)) in alias:
                out[f, c] = 0.8
            elif set(a.split("_")) & set(b.split("_")) or lev(a, b) <= 2:
                out[f, c] = min(0.7, 1 - lev(a, b) / max(len(a), len(b)))
    return out


def test_shared_tokens(spark):
    requested = [*REQUESTED, "Wind_direction data", "max max wind speed", "humidity", "soil moisture"]
    catalog = [*suite.FEATURE_COLUMNS, "wind_speed_10m_max", "WIND speed", "surface pressure", "direction of the wind"]
    want = _plain_candidates(requested, catalog)
    found = matching.match_candidates(spark.createDataFrame([(x,) for x in requested], "feature string"),
                                      spark.createDataFrame([(x,) for x in catalog], "column_name string")).collect()
    assert len(found) == len(want)
    assert {(r["feature"], r["column_name"]): round(r["score"], 9) for r in found} \
        == {k: round(v, 9) for k, v in want.items()}
    out = _run(spark, requested, catalog)
    for f in ("wind_direction", "sea_surface_temperature"):
        assert out[f]["status"] == "missing" and 0 < out[f]["confidence"] <= 0.7
        assert len(out[f]["similarity_scores"]) == min(5, sum(x == f for x, _ in want))


def _many_names(n, seed):
    """Names of one to five words out of few, so that tokens are shared by many, and some misspelt."""
    import random
    r = random.Random(seed)
    words = ["temperature", "wind", "speed", "max", "mean", "soil", "moisture", "of", "x", "pressure", "humidity", "radiation"]
    out = []
    for i in range(n):
        name = "_".join(r.choice(words) for _ in range(1 + i % 5))
        at = r.randrange(len(name))
        out.append(name[:at] + name[at + 1:] if i % 4 == 0 else name.upper() if i % 7 == 0 else name)
    return out


@pytest.mark.parametrize("hot", [10_000, 30])
def test_top_matches_are_those_of_all_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(matching, "HOT_NAMES", hot)
    requested = [*_many_names(60, 1), *REQUESTED, None, "", "%%", "pm25", "pm25"]
    catalog = [*_many_names(600, 2), *suite.FEATURE_COLUMNS, None, "", "??", "PM_25"]
    req = spark.createDataFrame([(x,) for x in requested], "feature string")
    cat = spark.createDataFrame([(x,) for x in catalog], "column_name string")
    every = matching.match_candidates(req, cat)
    want = {tuple(r) for r in matching.top_candidates(every).collect()}
    found, rounds = matching.top_matches(req, cat)
    assert {tuple(r) for r in found.collect()} == want and found.columns == ["feature", "column_name", "score", "rank"]
    scored = sum(r.scored_pairs for r in rounds.collect())
    pairs = every.count()
    assert 0 < scored < 0.9 * pairs, (scored, pairs)
    assert matching.token_pair_count(req, cat) >= scored
    nothing, _ = matching.top_matches(req.where("false"), cat)
    assert nothing.count() == 0 and matching.token_pair_count(req, cat.where("false")) == 0


def test_large_inputs_take_the_rounds(spark, monkeypatch):
    before = _run(spark, [*REQUESTED, "wind speed"], suite.FEATURE_COLUMNS)
    monkeypatch.setattr(matching, "MANY_PAIRS", 0)
    assert _run(spark, [*REQUESTED, "wind speed"], suite.FEATURE_COLUMNS) == before
