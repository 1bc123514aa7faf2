"""Incremental loads keyed by time: join, anti-join, upsert, watermark, guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.timeparse import scalar


def _null_safe_on(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> Column:
    cond = None
    for c in cols:
        e = a[c].eqNullSafe(b[c])
        cond = e if cond is None else cond & e
    return cond


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where NULL equals NULL; the key columns of ``left`` stay."""
    own = {k: f"_dl_key{i}" for i, k in enumerate(keys)}
    cond = None
    for k, r in own.items():
        e = F.col(f"`{k}`").eqNullSafe(F.col(r))
        cond = e if cond is None else cond & e
    return left.join(right.withColumnsRenamed(own), cond, how).drop(*own.values())


def join_on_time(a: DataFrame, b: DataFrame, keys: Sequence[str] = (),
                 time_col: str = fixed.TIME_COL, how: str = "inner") -> DataFrame:
    """Equi-join two tables on ``keys + [time_col]``; key columns appear once.

    NULL keys match each other (null-safe equality, as pandas merges them);
    Spark still plans this as an equi-join on the keys.
    """
    on = [*keys, time_col]
    cond = _null_safe_on(a, b, on)
    j = a.join(b, cond, how)
    rest_b = [b[c] for c in b.columns if c not in on]
    rest_a = [a[c] for c in a.columns if c not in on]
    key_cols = [F.coalesce(a[c], b[c]).alias(c) if how in ("full", "outer", "right")
                else a[c] for c in on]
    return j.select(*key_cols, *rest_a, *rest_b)


def new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str] = (),
             time_col: str = fixed.TIME_COL) -> DataFrame:
    """Source rows whose (keys, time) is not in the target (null-safe anti-join).

    Only the key columns of the target are read, and they are de-duplicated
    (a partial aggregate) before the shuffle: existence is all the anti-join
    needs, so a key repeated many times in the target costs one row per map
    task.
    """
    on = [*keys, time_col]
    t = target.select(*on).distinct()
    return source.join(t, _null_safe_on(source, t, on), "left_anti")


def upsert(existing: DataFrame, batch: DataFrame, keys: Sequence[str] = (),
           time_col: str | None = fixed.TIME_COL, keep: str = "first",
           order_cols: Sequence[str] = ()) -> DataFrame:
    """Append ``batch`` to ``existing`` and keep one row per (keys, time).

    ``keep="first"``: the existing row wins; ``keep="last"``: the batch row
    wins. Within one side, ``order_cols`` give the row order (a file has
    one, a DataFrame does not): the first/last in that order wins. NULL keys
    form one group. Columns are unioned by name (absent -> NULL).

    Plan: one shuffle on the key with ``row_number() = 1``; Spark applies a
    partial group limit before the shuffle, so a hot key sends at most one
    row per map task.
    """
    on = [*keys] + ([time_col] if time_col else [])
    if not on:
        raise ValueError("upsert needs key columns (keys and/or time_col)")
    prio = "_dl_side"
    u = existing.withColumn(prio, F.lit(0)).unionByName(
        batch.withColumn(prio, F.lit(1)), allowMissingColumns=True)
    if keep == "first":
        order = [F.col(prio).asc(), *[F.col(c).asc() for c in order_cols]]
    elif keep == "last":
        order = [F.col(prio).desc(), *[F.col(c).desc() for c in order_cols]]
    else:
        raise ValueError("keep must be 'first' or 'last'")
    w = Window.partitionBy(*on).orderBy(*order)
    return (u.withColumn("_dl_rn", F.row_number().over(w))
            .filter(F.col("_dl_rn") == 1).drop("_dl_rn", prio))


def dedup(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] = (),
          keep: str = "first") -> DataFrame:
    """One row per key, first/last in ``order_cols`` (never ``dropDuplicates``)."""
    if not keys:
        raise ValueError("dedup needs key columns")
    order = [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in order_cols]
    w = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    return (df.withColumn("_dl_rn", F.row_number().over(w))
            .filter(F.col("_dl_rn") == 1).drop("_dl_rn"))


def watermark(df: DataFrame, time_col: str = fixed.TIME_COL):
    """Max time of a table as a literal Column, None if it has none (one-column scan).

    Resolving it before filtering lets the filter reach the Parquet scan as a
    literal (row-group skipping), which a join against a computed max cannot.
    """
    return scalar(df, F.max(time_col))


def rows_after_watermark(source: DataFrame, target: DataFrame,
                         time_col: str = fixed.TIME_COL, bootstrap: bool = False,
                         eager: bool = True) -> DataFrame:
    """Source rows strictly newer than the target's max time.

    An empty target has no max: nothing is returned unless ``bootstrap``.
    ``eager=False`` keeps it lazy (a one-row broadcast join, no pushdown).
    """
    if eager:
        m = watermark(target, time_col)
        if m is None:
            return source if bootstrap else source.limit(0)
        return source.filter(F.col(time_col) > m)
    mx = target.agg(F.max(time_col).alias("_dl_wm"))
    j = source.crossJoin(F.broadcast(mx))
    cond = F.col(time_col) > F.col("_dl_wm")
    if bootstrap:
        cond = cond | F.col("_dl_wm").isNull()
    return j.filter(cond).drop("_dl_wm")


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def load_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows_before, rows_after, rows_added, changed."""
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.agg(F.count(F.lit(1)).alias("rows_after"))
    return (b.crossJoin(a)
            .withColumn("rows_added", F.col("rows_after") - F.col("rows_before"))
            .withColumn("changed", F.col("rows_after") != F.col("rows_before")))


def assert_no_shrink(before: DataFrame, after: DataFrame) -> DataFrame:
    """Raise before any write when the result has fewer rows than before."""
    s = load_stats(before, after).first()
    if s["rows_after"] < s["rows_before"]:
        raise ValueError(
            f"merge would shrink the table: {s['rows_after']} rows after, "
            f"{s['rows_before']} before; not writing")
    return after
