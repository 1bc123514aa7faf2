"""Text helpers: name normalisation, URLs, JSON blocks in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_name_sql(x: str, suffixes=tuple(fixed.NAME_SUFFIXES)) -> str:
    """SQL text of ``normalize_name`` for an expression ``x`` (one JVM call
    when used through ``F.expr``/``selectExpr``)."""
    alt = "|".join(suffixes)
    return (f"regexp_replace(regexp_replace(regexp_replace(lower({x}), '[^\\\\p{{L}}\\\\p{{N}}]+', '_'), "
            f"'^_+|_+$', ''), '_({alt})$', '')")


def normalize_name(c, suffixes=tuple(fixed.NAME_SUFFIXES)) -> Column:
    """lower, non-alphanumerics -> ``_``, trim ``_``, drop one trailing suffix word."""
    s = F.lower(_col(c))
    s = F.regexp_replace(s, r"[^\p{L}\p{N}]+", "_")
    s = F.regexp_replace(s, r"^_+|_+$", "")
    alt = "|".join(suffixes)
    return F.regexp_replace(s, rf"_({alt})$", "")


def squash_name(c) -> Column:
    """Normalised name without underscores, so ``pm25`` equals ``pm2_5``."""
    return F.regexp_replace(normalize_name(c), "_", "")


def name_tokens(c) -> Column:
    return F.split(normalize_name(c), "_")


def is_http_url(c) -> Column:
    c = _col(c)
    return F.coalesce(c.startswith(fixed.URL_PREFIXES[0]) | c.startswith(fixed.URL_PREFIXES[1]),
                      F.lit(False))


def join_url(base, endpoint) -> Column:
    """base and endpoint with exactly one slash; base alone when endpoint is empty."""
    b, e = _col(base), _col(endpoint)
    joined = F.concat(F.regexp_replace(b, "/+$", ""), F.lit("/"), F.regexp_replace(e, "^/+", ""))
    return F.when(F.coalesce(e, F.lit("")) == "", b).otherwise(joined)


def strip_ws(c) -> Column:
    """Remove leading/trailing whitespace of any kind (``trim`` only strips spaces)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def extract_json_block_sql(x: str) -> str:
    """SQL text of ``extract_json_block`` for an expression ``x``."""
    ws = _lit(r"^\s+|\s+$")
    t = f"regexp_replace({x}, {ws}, '')"
    fenced = f"regexp_replace(regexp_extract({t}, {_lit('(?s)```json(.*?)(```|\\z)')}, 1), {ws}, '')"
    braces = f"regexp_extract({t}, {_lit('(?s)(\\{.*\\})')}, 1)"
    return (f"CASE WHEN instr({t}, '```json') > 0 THEN {fenced} "
            f"WHEN instr({t}, '{{') > 0 THEN nullif({braces}, '') ELSE {t} END")


def extract_json_block(c) -> Column:
    """JSON text inside free text.

    A fenced ```` ```json ```` block wins (to the next fence, or to the end
    when the fence is never closed), trimmed; else from the first ``{`` to
    the last ``}``; else the text itself.
    """
    t = strip_ws(_col(c))
    fenced = strip_ws(F.regexp_extract(t, r"(?s)```json(.*?)(```|\z)", 1))
    braces = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    return (F.when(F.instr(t, "```json") > 0, fenced)
            .when(F.instr(t, "{") > 0, F.when(braces == "", F.lit(None)).otherwise(braces))
            .otherwise(t))
