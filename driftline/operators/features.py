"""Model features: log, standard score, lags, calendar, cyclic, interactions.

All DataFrame in, DataFrame out, built-in functions only; lazy but for what
keyed scaling and lags measure or stage first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.timeparse import scalar
from ..session import materialize
from .ranking import POS, add_position, lag_by_position
from .incremental import join_keys
from .sizing import RANGE_SPREAD, ROWS_PER_TASK, ranges_for, series_profile


def q(c: str) -> str:
    """Back-quoted column name for SQL expression strings (names may hold ``%``)."""
    return f"`{c}`"


def log_features(df: DataFrame, cols: Sequence[str] = tuple(fixed.LOG_COLUMNS),
                 prefix: str = "log_") -> DataFrame:
    """``log_<c> = log1p(c)`` with 0 and missing mapped to 0 (see ``log1p_zero``)."""
    return df.withColumns({f"{prefix}{c}": F.expr(f"coalesce(log1p(nullif({q(c)}, 0D)), 0D)")
                           for c in cols})


# FIXED VALUE: double-precision machine epsilon (2**-52), used by the
# constant-column rule of the original's scaler.
EPS = 2.220446049250313e-16


def scaler_stats(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Population mean and scale per column (per key): one row per key.

    A partial aggregate, so a hot key costs one row per map task. The scale
    is the population std, or 1 for a constant column: no values, or a
    variance within floating-point noise of zero
    (``var <= n*eps*var + (n*mean*eps)^2``) or a std below ``10*eps``.
    """
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.expr(f"avg({q(c)}) AS _m{i}"), F.expr(f"var_pop({q(c)}) AS _v{i}"),
                 F.expr(f"CAST(count({q(c)}) AS DOUBLE) AS _n{i}")]
    stats = df.groupBy(*keys).agg(*aggs)
    out = []
    for i in range(len(cols)):
        m, v, n = f"_m{i}", f"_v{i}", f"_n{i}"
        constant = (f"{v} IS NULL OR {v} <= {n} * {EPS!r} * {v} + power({n} * {m} * {EPS!r}, 2) "
                    f"OR sqrt({v}) < 10 * {EPS!r}")
        out += [m, f"CASE WHEN {constant} THEN 1D ELSE sqrt({v}) END AS _s{i}"]
    return stats.selectExpr(*[q(k) for k in keys], *out)


def standard_scale(df: DataFrame, cols: Sequence[str] = tuple(fixed.SCALE_COLUMNS),
                   keys: Sequence[str] = (), fit_on: DataFrame | None = None,
                   prefix: str = "scaled_") -> DataFrame:
    """``scaled_<c> = (c - mean) / std`` with the statistics of ``fit_on``.

    Population std; a constant column divides by 1 (see ``scaler_stats``);
    NULLs are ignored in the fit and stay NULL. ``fit_on`` defaults to the input (the original fits on the new
    batch only, so results depend on batch boundaries).

    Without keys the statistics are one row, joined as a broadcast (size 1).
    With keys they are one row per key, staged (one job) so that the join is
    planned on their size: a broadcast under the threshold, and the rows stay
    where they are. Planned on an unknown size, all rows would first be
    shuffled by key, and one task would read most of a hot key's.
    """
    keys = list(keys)
    stats = scaler_stats(fit_on if fit_on is not None else df, cols, keys)
    if keys:
        stats = materialize(stats, "scaler-stats")
    joined = df.crossJoin(F.broadcast(stats)) if not keys else \
        join_keys(df, stats, keys, "left")
    out = {f"{prefix}{c}": F.expr(f"({q(c)} - _m{i}) / _s{i}") for i, c in enumerate(cols)}
    helper = [f"_m{i}" for i in range(len(cols))] + [f"_s{i}" for i in range(len(cols))]
    return joined.withColumns(out).drop(*helper)


def lag_features(df: DataFrame, cols: Sequence[str] = tuple(fixed.LAG_SOURCES),
                 lags: Sequence[int] = tuple(fixed.LAGS), keys: Sequence[str] = (),
                 order: Sequence[str] = (fixed.TIME_COL,), method: str = "auto",
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``<c>_lag<k>``: value k ROWS earlier in ``order`` within each key.

    Lag is by row position, not by clock: a missing hour shifts the meaning,
    and the first k rows get NULL. ``order`` should be unique within a key
    (add tie-break columns).

    ``method="ranked"`` numbers rows per key through ordered ranges and joins
    each row with its predecessors by position (see ``ranking``): no
    single-partition and no single-key task, so it holds for an unkeyed
    series and for keys holding a large share of all rows. Ranges hold about
    ``rows_per_task / 4`` rows.
    ``method="window"`` is the plain ``lag().over(partitionBy(keys))``: one
    shuffle, right while every key's series fits one task.
    ``method="auto"`` (default) measures the largest series with one
    aggregate and takes "window" only when it has at most ``rows_per_task``
    rows, else "ranked".
    """
    keys, order = list(keys), list(order)
    name = (lambda c, k: f"{c}_lag{k}")
    if method != "window":
        rows, largest = series_profile(df, keys)
        if method == "auto":
            method = "ranked" if largest > rows_per_task else "window"
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({name(c, k): F.lag(c, k).over(w) for c in cols for k in lags})
    ranked = add_position(df, keys, order, ranges_for(rows, rows_per_task) * RANGE_SPREAD, POS, rows)
    return lag_by_position(ranked, keys, POS, cols, lags, name=name).drop(POS)


def calendar_features(df: DataFrame, time_col: str = fixed.TIME_COL) -> DataFrame:
    """hour (0-23), day_of_week (Monday = 0), is_weekend (Saturday/Sunday)."""
    t = q(time_col)
    weekend = ", ".join(str(d) for d in fixed.WEEKEND_DAYS)
    return df.withColumns({
        "hour": F.expr(f"hour({t})"),
        "day_of_week": F.expr(f"weekday({t})"),
        "is_weekend": F.expr(f"CAST(weekday({t}) IN ({weekend}) AS INT)"),
    })


def cyclic_features(df: DataFrame, col: str = "hour", period: int = fixed.CYCLE_HOURS,
                    prefix: str | None = None) -> DataFrame:
    p = prefix or col
    angle = f"CAST({q(col)} AS DOUBLE) * {2.0 * math.pi / period!r}"
    return df.withColumns({f"{p}_sin": F.expr(f"sin({angle})"), f"{p}_cos": F.expr(f"cos({angle})")})


def interactions(df: DataFrame, pairs=tuple(fixed.INTERACTION_PAIRS)) -> DataFrame:
    return df.withColumns({f"{a}_{b}": F.expr(f"{q(a)} * {q(b)}") for a, b in pairs})


def select_features(df: DataFrame, cols: Sequence[str] = tuple(fixed.SELECTED_COLUMNS)) -> DataFrame:
    """Project a fixed column list; every column must exist."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not in table: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def build_features(new_rows: DataFrame, history: DataFrame | None = None,
                   keys: Sequence[str] = (), time_col: str = fixed.TIME_COL,
                   lag_method: str = "auto") -> DataFrame:
    """The full feature set for ``new_rows`` (raw columns in, 46 columns out).

    Order: log -> scale (fitted on the new rows) -> lags -> calendar ->
    cyclic -> interactions. Lags are computed over history + new rows (the
    history supplies the earlier values) and then kept for the new rows only.
    """
    keys = list(keys)
    x = log_features(new_rows)
    x = standard_scale(x, keys=keys)
    x = x.withColumn("_new", F.lit(True))
    if history is not None:
        old = lag_history(history.select(*keys, time_col, *fixed.LAG_SOURCES), new_rows,
                          keys, time_col, max(fixed.LAGS))
        x = old.withColumn("_new", F.lit(False)).unionByName(x, allowMissingColumns=True)
    x = lag_features(x, keys=keys, order=[time_col], method=lag_method)
    x = x.filter("_new").drop("_new")
    x = calendar_features(x, time_col)
    x = cyclic_features(x, "hour")
    x = interactions(x)
    return x


def lag_history(history: DataFrame, new_rows: DataFrame, keys: Sequence[str], time_col: str,
                depth: int) -> DataFrame:
    """The part of ``history`` that lags of ``new_rows`` can reach.

    Lags are by position, so a new row at most ``depth`` rows after the
    earliest new row of its key needs only the last ``depth`` history rows
    before that earliest new row, plus any history rows after it (back-filled
    gaps). Everything else is skipped: the daily job touches about ``depth``
    old rows per key instead of the whole table. Exact, not a sample.
    """
    keys = list(keys)
    t = F.col(time_col)
    if not keys:
        first_new = scalar(new_rows, F.min(time_col))
        if first_new is None:
            return history.limit(0)
        before = history.filter(t < first_new).orderBy(t.desc()).limit(depth)
        return before.unionByName(history.filter(t >= first_new))
    firsts = new_rows.groupBy(*keys).agg(F.min(time_col).alias("_dl_first"))
    h = join_keys(history, firsts, keys, "inner")   # keys with no new rows drop out
    w = Window.partitionBy(*keys).orderBy(t.desc())
    before = (h.filter(t < F.col("_dl_first")).withColumn("_dl_rn", F.row_number().over(w))
              .filter(F.col("_dl_rn") <= depth).drop("_dl_rn"))
    after = h.filter(t >= F.col("_dl_first"))
    return before.unionByName(after).drop("_dl_first")
