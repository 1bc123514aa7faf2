"""Does a requested feature already exist under another column name?

Scores per (requested feature, catalog column):

* 1.0 when the normalised names are equal once underscores are removed
  (``pm25`` = ``pm2_5``, ``construction_index`` = ``construction``);
* 0.8 when one is a canonical name and the other one of its aliases (two
  aliases of one canonical do not match each other);
* ``least(0.7, 1 - levenshtein / longer length)`` when the normalised names
  share a token, however far apart they are, or are within ``max_edits`` edits.
  The 0.7 cap keeps edit distance alone from passing the strict ``> 0.7``
  acceptance gate.

Candidates come from equi-joins only, never from a cross join: exact and alias
pairs join on the squashed name, token pairs on each token of the distinct
normalised names (a pair is made at its rarest shared token only; a token that
many columns have is split by a salt), and near pairs join on shared deletion
variants (every string reachable by deleting up to ``max_edits`` characters).
Two names within ``d`` edits always share such a variant, so the near set is
exact. The token pairs are as many as the pairs of names that share a token;
``shared_tokens=False`` leaves them out.

``top_matches`` finds the best columns without scoring all of these pairs. Names
whose lengths differ by ``g`` are at least ``g`` edits apart, so it takes token
pairs in rounds of growing difference and drops a name from further rounds when
its worst kept column beats all that a larger difference allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.text import normalize_name_sql
from ..session import materialize

#: Columns that one key of a token join holds in one task; keys with more are split by a salt.
HOT_NAMES = 10_000
#: Pairs of names with a shared token up to which all of them are scored in one pass.
MANY_PAIRS = 20_000_000


def alias_table(spark: SparkSession, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    rows = [(c, a) for c, al in (aliases or fixed.ALIASES).items() for a in al]
    return spark.createDataFrame(rows, "canonical string, alias string")


def _squash(x: str) -> str:
    return f"replace({normalize_name_sql(x)}, '_', '')"


def _alias_pairs(aliases: DataFrame) -> DataFrame:
    """Both directions, on squashed names (duplicates are harmless: candidate
    pairs are de-duplicated by the per-pair aggregate)."""
    a = aliases.selectExpr(f"{_squash('canonical')} AS a", f"{_squash('alias')} AS b")
    return a.unionByName(a.selectExpr("b AS a", "a AS b"))


def deletion_variants_sql(x: str, max_edits: int) -> str:
    """SQL: array of the distinct strings made by deleting 0..max_edits characters."""
    out = f"array({x})"
    for _ in range(max_edits):
        out = ("array_distinct(flatten(transform(" + out + ", s -> concat(array(s), "
               "transform(sequence(1, greatest(length(s), 1)), "
               "i -> concat(substr(s, 1, i - 1), substr(s, i + 1)))))))")
    return out


def _name_tokens(names: DataFrame, name: str, all_of: str) -> DataFrame:
    """Distinct names with the array of their distinct tokens."""
    return names.where(f"{name} <> ''").select(name).distinct().selectExpr(
        name, f"array_distinct(filter(split({name}, '_'), t -> t <> '')) AS {all_of}")


def _rarest_first(names: DataFrame, all_of: str, columns_with: DataFrame) -> DataFrame:
    """``names`` whose tokens that columns have (``_t, _n``) are ordered from the rarest to the most frequent."""
    rest = [c for c in names.columns if c != all_of]
    known = names.selectExpr(*rest, f"explode({all_of}) AS _t").join(columns_with, "_t")
    return known.groupBy(*rest).agg(F.expr(f"transform(array_sort(collect_list(struct(_n, _t))), x -> x._t) AS {all_of}"))


def _salted(columns: DataFrame, key: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``columns`` with ``_salt`` in keys of more than ``HOT_NAMES`` rows, and the number of salts of each key."""
    sizes = columns.groupBy(*key).agg(F.expr(f"CAST(ceil(count(*) / {HOT_NAMES}) AS INT) AS _salts"))
    return columns.join(sizes, key).selectExpr("*", f"pmod(xxhash64({name}), _salts) AS _salt").drop("_salts"), sizes


def _joined(asked: DataFrame, columns: DataFrame, sizes: DataFrame, key: list[str]) -> DataFrame:
    """Names and columns with the same key, each pair at its rarest shared token only."""
    spread = asked.join(sizes, key).selectExpr("*", "explode(sequence(0L, _salts - 1L)) AS _salt").drop("_salts")
    return spread.join(columns, [*key, "_salt"]).where("get(filter(_rt, t -> array_contains(_ct, t)), 0) = _t")


def _columns_with(tokens: DataFrame) -> DataFrame:
    return tokens.selectExpr("explode(_ct) AS _t").groupBy("_t").agg(F.expr("count(*) AS _n"))


def _token_pairs(req: DataFrame, cat: DataFrame) -> DataFrame:
    """Features and columns whose normalised names share a token, each pair once."""
    columns = _name_tokens(cat, "_cn", "_ct")
    asked = _rarest_first(_name_tokens(req, "_rn", "_rt"), "_rt", _columns_with(columns))
    salted, sizes = _salted(columns.selectExpr("_cn", "_ct", "explode(_ct) AS _t"), ["_t"], "_cn")
    names = _joined(asked.selectExpr("_rn", "_rt", "explode(_rt) AS _t"), salted, sizes, ["_t"]).select("_rn", "_cn")
    return names.join(req.select("feature", "_rn"), "_rn").join(cat.select("column_name", "_cn"), "_cn")


def token_pair_count(requested: DataFrame, catalog: DataFrame, feature_col: str = "feature",
                     column_col: str = "column_name") -> int:
    """At most so many pairs of normalised names share a token; counted without making them."""
    def counts(names: DataFrame, col: str, n: str) -> DataFrame:
        own = names.selectExpr(f"{normalize_name_sql(f'`{col}`')} AS _n")
        return _name_tokens(own, "_n", "_all").selectExpr("explode(_all) AS _t").groupBy("_t").agg(F.expr(f"count(*) AS {n}"))

    both = counts(requested, feature_col, "_a").join(counts(catalog, column_col, "_b"), "_t")
    return int(both.agg(F.expr("coalesce(sum(CAST(_a AS DECIMAL(38, 0)) * _b), 0)")).first()[0])


def _fuzzy(far: str) -> str:
    """Score of two names by edits, NULL where ``far`` says that they are no candidates."""
    return (f"CASE WHEN {far} THEN NULL ELSE least({fixed.FUZZY_CAP!r}, "
            "1.0D - levenshtein(_rn, _cn) / greatest(length(_rn), length(_cn), 1)) END")


def top_matches(requested: DataFrame, catalog: DataFrame, aliases: DataFrame | None = None,
                top_n: int = fixed.TOP_N_SCORES, max_edits: int = 2, feature_col: str = "feature",
                column_col: str = "column_name") -> tuple[DataFrame, DataFrame]:
    """The rows of ``top_candidates(match_candidates(...))``, found in rounds.

    The second table lists the rounds: smallest and largest difference in length,
    names still open, pairs scored by edits. NULL names match nothing.
    """
    spark = requested.sparkSession
    aliases = aliases if aliases is not None else alias_table(spark)
    req = materialize(requested.selectExpr(f"`{feature_col}` AS feature").distinct().selectExpr(
        "feature", f"{normalize_name_sql('feature')} AS _rn", f"{_squash('feature')} AS _rs"), "match-requested")
    cat = materialize(catalog.selectExpr(f"`{column_col}` AS column_name").distinct().selectExpr(
        "column_name", f"{normalize_name_sql('column_name')} AS _cn", f"{_squash('column_name')} AS _cs"), "match-columns")
    # columns of one normalised name have one score, so their first name stands for all of them
    firsts = cat.groupBy("_cn", "_cs").agg(F.expr("min(column_name) AS _first"))
    names = req.select("_rn", "_rs").distinct()

    tokens = _name_tokens(cat, "_cn", "_ct")
    asked = materialize(
        _rarest_first(_name_tokens(req, "_rn", "_rt"), "_rt", _columns_with(tokens)).selectExpr("*", "length(_rn) AS _rl"),
        "match-asked")
    salted, sizes = _salted(tokens.join(firsts.select("_cn", "_first"), "_cn").selectExpr(
        "_cn", "_ct", "_first", "length(_cn) AS _cl", "explode(_ct) AS _t"), ["_t", "_cl"], "_cn")
    columns, sizes = materialize(salted, "match-tokens"), materialize(sizes, "match-sizes")
    widest = max(asked.agg(F.max("_rl")).first()[0] or 0, columns.agg(F.max("_cl")).first()[0] or 0)

    # names that are equal, aliases, or a few edits apart are found at once, whatever their lengths
    exact = names.where("_rs <> ''").join(firsts, names["_rs"] == firsts["_cs"]) \
        .selectExpr("_rn", "_cn", "_first", f"{fixed.EXACT_SCORE!r} AS score")
    via = names.join(F.broadcast(_alias_pairs(aliases)), F.expr("_rs = a")).select("_rn", "b")
    found = exact.unionByName(via.join(firsts, F.expr("b = _cs")).selectExpr(
        "_rn", "_cn", "_first", f"{fixed.ALIAS_SCORE!r} AS score"))
    rounds, best = [], None
    if max_edits > 0:
        rv = names.selectExpr("_rn", f"explode({deletion_variants_sql('_rn', max_edits)}) AS _v")
        cv = firsts.selectExpr("_cn", "_first", f"explode({deletion_variants_sql('_cn', max_edits)}) AS _v")
        near = rv.join(cv, "_v").select("_rn", "_cn", "_first").distinct()
        found = found.unionByName(near.selectExpr(
            "_rn", "_cn", "_first", f"{_fuzzy(f'levenshtein(_rn, _cn) > {int(max_edits)}')} AS score").where("score IS NOT NULL"))

    low, high = 0, 1
    while low <= widest:
        open_ = asked
        if best is not None:
            worst = best.groupBy("_rn").agg(F.expr("count(*) AS _n"), F.expr("min(score) AS _worst"))
            open_ = asked.join(worst, "_rn", "left").where(
                f"coalesce(_n, 0) < {int(top_n)} OR _worst <= least({fixed.FUZZY_CAP!r}, 1.0D - {low} / (_rl + {low}))") \
                .select(*asked.columns)
        n_open = open_.count()
        if not n_open:
            break
        gaps = f"sequence({low}, {high})"
        lengths = f"concat(transform({gaps}, g -> _rl + g), transform({gaps}, g -> _rl - g))"
        around = open_.selectExpr("_rn", "_rt", "explode(_rt) AS _t", "_rl").selectExpr(
            "_rn", "_rt", "_t", f"explode(array_distinct(filter({lengths}, l -> l > 0))) AS _cl")
        new = materialize(_joined(around, columns, sizes, ["_t", "_cl"]).selectExpr(
            "_rn", "_cn", "_first", f"{_fuzzy('false')} AS score"), "match-scored")
        rounds.append((low, high, n_open, new.count()))
        every = new.unionByName(found if best is None else best)
        pairs = every.groupBy("_rn", "_cn").agg(F.expr("max(score) AS score"), F.expr("first(_first) AS _first"))
        best = materialize(pairs.withColumn("_rank", F.expr(
            "row_number() OVER (PARTITION BY _rn ORDER BY score DESC, _first)"))
            .where(f"_rank <= {int(top_n)}").select("_rn", "_cn", "_first", "score"), "match-best")
        low, high = high + 1, 2 * high + 1
    pairs = (found if best is None else best).select("_rn", "_cn", "score")
    every = pairs.join(req.select("feature", "_rn"), "_rn").join(cat.select("column_name", "_cn"), "_cn") \
        .select("feature", "column_name", "score")
    return top_candidates(every, top_n), spark.createDataFrame(
        rounds, "from_gap long, to_gap long, open_names long, scored_pairs long")


def match_candidates(requested: DataFrame, catalog: DataFrame, aliases: DataFrame | None = None,
                     max_edits: int = 2, feature_col: str = "feature",
                     column_col: str = "column_name", shared_tokens: bool = True) -> DataFrame:
    """``(feature, column_name, score)``: every scored pair, best score kept."""
    spark = requested.sparkSession
    aliases = aliases if aliases is not None else alias_table(spark)
    req = requested.selectExpr(f"`{feature_col}` AS feature").distinct() \
        .selectExpr("feature", f"{normalize_name_sql('feature')} AS _rn", f"{_squash('feature')} AS _rs")
    cat = catalog.selectExpr(f"`{column_col}` AS column_name").distinct() \
        .selectExpr("column_name", f"{normalize_name_sql('column_name')} AS _cn",
                    f"{_squash('column_name')} AS _cs")

    # candidate pairs from four equi-joins, tagged by kind; one aggregate per
    # pair afterwards (dedup + scoring), so edit distance is computed once
    # (names without a letter or digit all squash to nothing and aren't equal by that)
    exact = req.where("_rs <> ''").join(cat, req["_rs"] == cat["_cs"]).selectExpr(
        "feature", "column_name", "_rn", "_cn", "1 AS _kind")
    pairs = F.broadcast(_alias_pairs(aliases))  # fixed, small
    via = req.join(pairs, req["_rs"] == pairs["a"]).selectExpr("feature", "_rn", "b")
    alias = via.join(cat, via["b"] == cat["_cs"]).selectExpr(
        "feature", "column_name", "_rn", "_cn", "2 AS _kind")
    u = exact.unionByName(alias)
    if max_edits > 0:
        rv = req.selectExpr("feature", "_rn", f"explode({deletion_variants_sql('_rn', max_edits)}) AS _v")
        cv = cat.selectExpr("column_name", "_cn",
                            f"explode({deletion_variants_sql('_cn', max_edits)}) AS _v")
        u = u.unionByName(rv.join(cv, "_v").selectExpr("feature", "column_name", "_rn", "_cn",
                                                        "3 AS _kind"))
    if shared_tokens:
        u = u.unionByName(_token_pairs(req, cat).selectExpr("feature", "column_name", "_rn", "_cn", "4 AS _kind"))
    per_pair = u.groupBy("feature", "column_name").agg(
        F.expr("min(_kind) AS _k"), F.expr("max(_kind) = 4 AS _shared"), F.expr("first(_rn) AS _rn"), F.expr("first(_cn) AS _cn"))
    score = (f"CASE _k WHEN 1 THEN {fixed.EXACT_SCORE!r} WHEN 2 THEN {fixed.ALIAS_SCORE!r} "
             f"ELSE {_fuzzy(f'NOT _shared AND levenshtein(_rn, _cn) > {int(max_edits)}')} END")
    return per_pair.selectExpr("feature", "column_name", f"{score} AS score").where("score IS NOT NULL")


def top_candidates(cands: DataFrame, top_n: int = fixed.TOP_N_SCORES) -> DataFrame:
    """Best ``top_n`` columns per feature (score desc, then name); adds rank."""
    return (cands.withColumn("rank", F.expr("row_number() OVER (PARTITION BY feature "
                                            "ORDER BY score DESC, column_name)"))
            .where(f"rank <= {int(top_n)}"))


def match_features(requested: DataFrame, catalog: DataFrame, aliases: DataFrame | None = None,
                   threshold: float = fixed.SIMILARITY_THRESHOLD, top_n: int = fixed.TOP_N_SCORES,
                   max_edits: int = 2, feature_col: str = "feature",
                   column_col: str = "column_name", shared_tokens: bool = True) -> DataFrame:
    """One row per requested row: status, mapped_to, confidence, similarity_scores.

    ``already_exists`` when the best score is strictly above ``threshold``;
    else ``missing`` (confidence = best score, 0.0 with no candidate). Where more
    than ``MANY_PAIRS`` pairs share a token, they aren't all scored (``top_matches``).
    """
    if shared_tokens and token_pair_count(requested, catalog, feature_col, column_col) > MANY_PAIRS:
        top, _ = top_matches(requested, catalog, aliases, top_n, max_edits, feature_col, column_col)
    else:
        top = top_candidates(match_candidates(requested, catalog, aliases, max_edits,
                                              feature_col, column_col, shared_tokens), top_n)
    best = top.groupBy("feature").agg(
        F.expr("max_by(column_name, struct(score, -rank)) AS _best"),
        F.expr("max(score) AS _score"),
        F.expr("map_from_entries(collect_list(struct(column_name, score))) AS similarity_scores"))
    req = requested.withColumnRenamed(feature_col, "feature") if feature_col != "feature" else requested
    cols = req.columns
    exists = f"coalesce(_score > {threshold!r}, false)"
    return req.join(best, "feature", "left").selectExpr(
        *[f"`{c}`" for c in cols],
        f"CASE WHEN {exists} THEN '{fixed.STATUS_EXISTS}' ELSE '{fixed.STATUS_MISSING}' END AS status",
        f"CASE WHEN {exists} THEN _best END AS mapped_to",
        "coalesce(_score, 0.0D) AS confidence",
        "coalesce(similarity_scores, CAST(map() AS map<string,double>)) AS similarity_scores")
