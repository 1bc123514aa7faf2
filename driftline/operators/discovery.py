"""Feature-source discovery as set operations over logged responses.

The original asks an external model for candidate data sources one feature
at a time, probes each candidate over HTTP and retries up to three times.
Here the model responses and probe results are an input table, the
*attempt log*, one row per (feature, attempt):

    feature, attempt_no, response_text, outcome, http_status[, detail]

and every decision the original takes in its loop is a column expression or
a per-feature aggregate over at most ``max_attempts`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.text import extract_json_block_sql

CANDIDATE_TYPE = ("struct<name: string, url: string, endpoint: string, description: string, "
                  "documentation_url: string, rate_limit: string, auth_required: boolean>")
RESPONSE_SCHEMA = (f"search_keywords array<string>, candidate_api {CANDIDATE_TYPE}, "
                   "confidence double, reason string, suggestions array<string>")


def _q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


EMPTY_STRINGS = "CAST(array() AS array<string>)"


def parse_responses(df: DataFrame, text_col: str = "response_text") -> DataFrame:
    """Add parse_ok, search_keywords, candidate_api, candidate_json, confidence, parse_reason, suggestions.

    ``candidate_api`` has the fields that rules read; ``candidate_json`` is the
    whole candidate as the response gave it, with whatever fields it has.
    """
    block = extract_json_block_sql(f"`{text_col}`")
    x = df.withColumns({"_dl_block": F.expr(block)})
    x = x.withColumns({"parse_ok": F.expr("coalesce(try_parse_json(_dl_block) IS NOT NULL, false)"),
                       "_dl_j": F.expr(f"from_json(_dl_block, {_q(RESPONSE_SCHEMA)})")})
    return x.withColumns({
        "search_keywords": F.expr(f"CASE WHEN parse_ok THEN coalesce(_dl_j.search_keywords, {EMPTY_STRINGS}) END"),
        "candidate_api": F.expr("CASE WHEN parse_ok THEN _dl_j.candidate_api END"),
        "candidate_json": F.expr("CASE WHEN parse_ok AND _dl_j.candidate_api IS NOT NULL "
                                 "THEN get_json_object(_dl_block, '$.candidate_api') END"),
        "suggestions": F.expr(f"CASE WHEN parse_ok THEN coalesce(_dl_j.suggestions, {EMPTY_STRINGS}) END"),
        "confidence": F.expr("CASE WHEN parse_ok THEN coalesce(_dl_j.confidence, 0.0D) END"),
        "parse_reason": F.expr("CASE WHEN parse_ok THEN _dl_j.reason END"),
    }).drop("_dl_block", "_dl_j")


def carry_forward(df: DataFrame, keys: Sequence[str] = ("feature",),
                  order: str = "attempt_no") -> DataFrame:
    """A failed parse keeps the previous attempt's candidate, keywords,
    suggestions and confidence (the original only replaces them after a good
    parse); before any good parse they are NULL / [] / [] / 0.0. A log parsed
    elsewhere may lack ``candidate_json`` and ``suggestions``."""
    for c, kind in (("candidate_json", "string"), ("suggestions", "array<string>")):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(kind))
    over = (f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)} ORDER BY `{order}` "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")

    def last_good(c: str) -> str:
        return f"last(CASE WHEN parse_ok THEN named_struct('v', `{c}`) END, true) {over}.v"

    return df.withColumns({
        "candidate_api": F.expr(last_good("candidate_api")),
        "candidate_json": F.expr(last_good("candidate_json")),
        "search_keywords": F.expr(f"coalesce({last_good('search_keywords')}, {EMPTY_STRINGS})"),
        "suggestions": F.expr(f"coalesce({last_good('suggestions')}, {EMPTY_STRINGS})"),
        "confidence": F.expr(f"coalesce({last_good('confidence')}, 0.0D)"),
    })


def classify_probes(df: DataFrame, candidate_col: str = "candidate_api") -> DataFrame:
    """is_valid, reason and probe_url per attempt (first matching rule wins):
    no candidate; URL not http(s); HTTP status 200/401/403 valid, 404/410 not
    found, other unexpected; timeout; connection; request error; other."""
    cand = f"`{candidate_col}`"
    detail = "coalesce(detail, '')" if "detail" in df.columns else "''"
    has = f"({cand} IS NOT NULL)"
    url = f"{cand}.url"
    good = "(" + " OR ".join(f"coalesce(startswith({url}, {_q(p)}), false)" for p in fixed.URL_PREFIXES) + ")"
    http = "(outcome = 'http')"
    valid_st = ", ".join(map(str, fixed.VALID_STATUSES))
    nf_st = ", ".join(map(str, fixed.NOT_FOUND_STATUSES))
    reason = (f"CASE WHEN NOT {has} THEN {_q(fixed.REASON_NO_CANDIDATE)} "
              f"WHEN NOT {good} THEN {_q(fixed.REASON_BAD_URL)} "
              f"WHEN {http} AND http_status = 200 THEN CAST(NULL AS STRING) "
              f"WHEN {http} AND http_status = 401 THEN {_q(fixed.REASON_401)} "
              f"WHEN {http} AND http_status = 403 THEN {_q(fixed.REASON_403)} "
              f"WHEN {http} AND http_status IN ({nf_st}) THEN format_string({_q(fixed.REASON_NOT_FOUND)}, http_status) "
              f"WHEN {http} THEN format_string({_q(fixed.REASON_UNEXPECTED)}, http_status) "
              f"WHEN outcome = 'timeout' THEN {_q(fixed.REASON_TIMEOUT)} "
              f"WHEN outcome = 'connection' THEN {_q(fixed.REASON_CONNECTION)} "
              f"WHEN outcome = 'request_error' THEN format_string({_q(fixed.REASON_REQUEST)}, {detail}) "
              f"ELSE format_string({_q(fixed.REASON_OTHER)}, {detail}) END")
    endpoint = f"coalesce({cand}.endpoint, '')"
    joined = (f"CASE WHEN {endpoint} = '' THEN {url} ELSE concat(regexp_replace({url}, '/+$', ''), '/', "
              f"regexp_replace({endpoint}, '^/+', '')) END")
    return df.withColumns({
        "is_valid": F.expr(f"coalesce({has} AND {good} AND {http} AND http_status IN ({valid_st}), false)"),
        "reason": F.expr(reason),
        "probe_url": F.expr(f"CASE WHEN {has} THEN {joined} END"),
    })


def resolve_attempts(log: DataFrame, keys: Sequence[str] = ("feature",),
                     max_attempts: int = fixed.MAX_ATTEMPTS, parsed: bool = False) -> DataFrame:
    """One row per feature from its attempt log.

    Attempts are taken in ``attempt_no`` order, up to ``max_attempts``, and
    stop at the first valid one. Output: api_found, api_details (candidate of
    the first valid attempt; api_details_json: all its fields as JSON text),
    search_attempts (attempts used), confidence_score / search_keywords /
    suggestions / reason of the last attempt used.
    Groups are at most ``max_attempts`` rows.
    """
    keys = list(keys)
    part = ", ".join(f"`{k}`" for k in keys)
    x = log.where(f"attempt_no <= {int(max_attempts)}")
    if not parsed:
        x = parse_responses(x)
    x = classify_probes(carry_forward(x, keys))
    x = x.withColumn("_first_valid", F.expr(
        f"min(CASE WHEN is_valid THEN attempt_no END) OVER (PARTITION BY {part})"))
    x = x.where("_first_valid IS NULL OR attempt_no <= _first_valid")
    r = x.groupBy(*keys).agg(
        F.expr("count(1) AS search_attempts"),
        F.expr("max_by(struct(confidence, search_keywords, suggestions, reason, is_valid, candidate_api, "
               "candidate_json, probe_url), attempt_no) AS _last"))
    return r.selectExpr(
        *[f"`{k}`" for k in keys],
        "_last.is_valid AS api_found",
        "CASE WHEN _last.is_valid THEN _last.candidate_api END AS api_details",
        "CASE WHEN _last.is_valid THEN _last.candidate_json END AS api_details_json",
        "CASE WHEN _last.is_valid THEN _last.probe_url END AS api_url",
        "_last.confidence AS confidence_score",
        "_last.search_keywords AS search_keywords",
        "_last.suggestions AS suggestions",
        "_last.reason AS reason",
        "CAST(search_attempts AS INT) AS search_attempts")


def dispositions(matches: DataFrame, resolved: DataFrame, key: str = "feature") -> DataFrame:
    """One disposition row per requested feature.

    Existing features skip the source search (0 attempts, nothing found);
    missing ones take their resolved attempts (none logged -> not found with
    0 attempts). A missing feature whose attempts all failed is ``not_found``
    and shows the responses' suggestions as alternatives.
    """
    r = resolved.withColumnRenamed(key, "_dl_key")
    keep = [c for c in matches.columns if c not in ("status", "mapped_to", "confidence",
                                                     "similarity_scores")]
    j = matches.join(r, matches[key] == r["_dl_key"], "left")
    missing = f"(status = '{fixed.STATUS_MISSING}')"
    found = f"({missing} AND coalesce(api_found, false))"
    return j.selectExpr(
        *[f"`{c}`" for c in keep],
        "status AS normalization_status", "mapped_to", "similarity_scores",
        "confidence AS normalization_confidence",
        f"CASE WHEN {missing} THEN coalesce(search_keywords, {EMPTY_STRINGS}) ELSE {EMPTY_STRINGS} END "
        "AS search_keywords",
        f"{found} AS api_found",
        f"CASE WHEN {found} THEN api_details END AS api_details",
        f"CASE WHEN {found} THEN api_details_json END AS api_details_json",
        f"CASE WHEN {found} THEN api_url END AS api_url",
        f"CASE WHEN {missing} THEN coalesce(confidence_score, 0.0D) ELSE 0.0D END AS confidence_score",
        f"CASE WHEN status = '{fixed.STATUS_EXISTS}' THEN {_q(fixed.REASON_EXISTS)} "
        f"WHEN {missing} THEN coalesce(reason, CASE WHEN NOT {found} THEN {_q(fixed.REASON_MISSING)} END) END "
        "AS reason",
        f"CASE WHEN {missing} AND NOT {found} THEN coalesce(suggestions, {EMPTY_STRINGS}) ELSE {EMPTY_STRINGS} END "
        "AS suggested_alternatives",
        f"CASE WHEN {missing} THEN coalesce(search_attempts, 0) ELSE 0 END AS search_attempts",
        f"CASE WHEN status = '{fixed.STATUS_EXISTS}' THEN '{fixed.STATUS_EXISTS}' "
        f"WHEN {found} THEN '{fixed.FINAL_FOUND}' ELSE '{fixed.FINAL_NOT_FOUND}' END AS final_status")


def categorize(disp: DataFrame) -> DataFrame:
    """Result category (first match wins) and the confidence a report shows:
    the match confidence for existing features, the source confidence else."""
    exists = f"(normalization_status = '{fixed.STATUS_EXISTS}')"
    return disp.withColumns({
        "category": F.expr(f"CASE WHEN {exists} THEN '{fixed.CATEGORY_EXISTING}' "
                           f"WHEN api_found THEN '{fixed.CATEGORY_NEW}' "
                           f"ELSE '{fixed.CATEGORY_NOT_FOUND}' END"),
        "report_confidence": F.expr(f"CASE WHEN {exists} THEN normalization_confidence "
                                    "ELSE confidence_score END"),
    })


def disposition_summary(disp: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts and percent rates; ``not_found`` = total - existing - found."""
    s = disp.groupBy(*keys).agg(
        F.expr("count(1) AS total_features"),
        F.expr(f"count_if(final_status = '{fixed.STATUS_EXISTS}') AS already_exists"),
        F.expr(f"count_if(final_status = '{fixed.FINAL_FOUND}') AS new_apis_found"))

    def rate(part: str) -> str:
        return f"coalesce(try_divide(CAST({part} AS DOUBLE), total_features) * 100.0D, 0.0D)"

    return s.selectExpr(
        *[f"`{k}`" for k in keys], "total_features", "already_exists", "new_apis_found",
        "total_features - already_exists - new_apis_found AS not_found",
        f"{rate('already_exists')} AS already_exists_rate",
        f"{rate('new_apis_found')} AS api_discovery_rate",
        f"{rate('already_exists + new_apis_found')} AS overall_success_rate")


def remaining(requested: DataFrame, processed: DataFrame, key: str = "feature") -> DataFrame:
    """Requested features not processed yet (anti-join on the feature key)."""
    p = processed.select(F.col(key).alias("_dl_key")).distinct()
    return requested.join(p, requested[key].eqNullSafe(p["_dl_key"]), "left_anti")


def disposition_report(disp: DataFrame) -> DataFrame:
    """The report's result lists as rows: ``category`` and one entry per feature, of any number.

    The one-object file of the original would need all features in one row; here a
    list is the rows of one category (``sinks.write_disposition_report``). Fields that
    a list doesn't have are NULL, so they aren't in its JSON lines.
    """
    def only(lists: Sequence[str], column: str, name: str | None = None) -> str:
        return f"CASE WHEN category IN ({', '.join(map(_q, lists))}) THEN {column} END AS {name or column}"

    new, unfound = [fixed.CATEGORY_NEW], [fixed.CATEGORY_NOT_FOUND]
    return categorize(disp).selectExpr(
        "category", "original_feature", "report_confidence AS confidence", "reason AS reasoning",
        only([fixed.CATEGORY_EXISTING], "mapped_to"), only([fixed.CATEGORY_EXISTING], "similarity_scores"),
        only(new, "api_details"), only(new, "api_details_json"), only(new + unfound, "search_attempts"),
        only(unfound, "suggested_alternatives"))


def detailed_mappings(disp: DataFrame) -> DataFrame:
    """The report's third part: every feature with all of its fields, one row each.

    ``api_details`` is NULL where nothing was found, an empty object in the original.
    """
    return disp.select(*fixed.MAPPING_FIELDS)


def mapping_schema() -> str:
    """The nested schema of the detailed mappings, to read them back."""
    kinds = {"similarity_scores": "map<string, double>", "normalization_confidence": "double",
             "search_keywords": "array<string>", "api_found": "boolean", "api_details": CANDIDATE_TYPE,
             "confidence_score": "double", "suggested_alternatives": "array<string>", "search_attempts": "int"}
    return ", ".join(f"{f} {kinds.get(f, 'string')}" for f in fixed.MAPPING_FIELDS)


def report_metadata(disp: DataFrame, catalog: DataFrame, run_at: str) -> DataFrame:
    """One row: the summary counts and rates, the catalog's column count and the run's time."""
    columns = catalog.agg(F.count(F.lit(1)).alias("total_columns"))
    return disposition_summary(disp).crossJoin(columns).withColumn("run_at", F.lit(run_at))


def report_header(disp: DataFrame, catalog: DataFrame, run_at: str, source: str = "",
                  location: dict[str, object] | None = None) -> DataFrame:
    """One row, the report's nested metadata: timestamp, location, features processed, source and number of the
    columns, processing summary. An empty ``location`` is NULL."""
    m = report_metadata(disp, catalog, run_at)
    summary = [c for c in m.columns if c not in ("total_columns", "run_at")]
    where = F.struct(*[F.lit(v).alias(k) for k, v in location.items()]) if location else F.lit(None).cast("string")
    return m.select(
        F.col("run_at").alias("timestamp"), where.alias("location"),
        F.col("total_features").alias("total_features_processed"), F.lit(source).alias("csv_file_analyzed"),
        F.col("total_columns").alias("csv_columns_count"), F.struct(*summary).alias("processing_summary"))
