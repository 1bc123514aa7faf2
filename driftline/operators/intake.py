"""Intake of foreign tables: one schema for all, rows that break rules set aside, shares of missing values.

Each works in one pass over the rows; only rules about other rows (``unique``,
``references``) add a shuffle, on de-duplicated or counted keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .incremental import join_keys
from .partitioned import overwrite_partitions

RESCUED, ERRORS, REJECTED = "rescued", "errors", "rejected"
WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONS = (T.FloatType, T.DoubleType, T.DecimalType)


# ---------------------------------------------------------------------------
# one schema
# ---------------------------------------------------------------------------

def _fitted(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` as the wanted type, NULL where it doesn't fit; a fraction doesn't fit a whole number."""
    if have == want:
        return c
    out = c.try_cast(want)
    if isinstance(have, FRACTIONS) and isinstance(want, WHOLE_NUMBERS):
        return F.when(out == c, out)
    return out


def conform_schema(df: DataFrame, schema: T.StructType | str, renames: Mapping[str, str] | None = None,
                   rescue_col: str | None = RESCUED) -> DataFrame:
    """``df`` with exactly the columns of ``schema``, matched by name, and ``rescue_col``.

    ``renames`` maps source names to schema names; names are compared without
    case. A column that ``df`` lacks is NULL. A value that its type can't hold
    becomes NULL and is kept as text in ``rescue_col`` (``map<string,string>``
    under the schema's name), with the values of columns that the schema doesn't
    have (under their own). Without any, ``rescue_col`` is NULL. Two source
    columns for one target, or a schema column named like ``rescue_col``, are an error.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if rescue_col and rescue_col.lower() in {f.name.lower() for f in schema}:
        raise ValueError(f"the schema has a column {rescue_col} of its own")
    given = {s.lower(): t for s, t in (renames or {}).items()}
    unknown = set(given) - {c.lower() for c in df.columns}
    if unknown:
        raise ValueError(f"no such columns to rename: {sorted(unknown)}")
    source: dict[str, T.StructField] = {}
    for f in df.schema:
        name = given.get(f.name.lower(), f.name).lower()
        if name in source:
            raise ValueError(f"{source[name].name} and {f.name} are both {name}")
        source[name] = f
    out, lost = [], []
    for want in schema:
        f = source.pop(want.name.lower(), None)
        if f is None:
            out.append(F.lit(None).cast(want.dataType).alias(want.name))
            continue
        c = F.col(f"`{f.name}`")
        value = _fitted(c, f.dataType, want.dataType)
        out.append(value.alias(want.name))
        if f.dataType != want.dataType:
            lost.append((want.name, F.when(value.isNull(), c.cast("string"))))
    lost += [(name, F.col(f"`{f.name}`").cast("string")) for name, f in source.items()]
    if not rescue_col:
        return df.select(*out)
    if not lost:
        return df.select(*out, F.lit(None).cast("map<string,string>").alias(rescue_col))
    entries = F.create_map(*[x for name, text in lost for x in (F.lit(name), text)])
    some = reduce(or_, [text.isNotNull() for _, text in lost])
    return df.select(*out, F.when(some, F.map_filter(entries, lambda k, v: v.isNotNull())).alias(rescue_col))


# ---------------------------------------------------------------------------
# quarantine
# ---------------------------------------------------------------------------

def broken_rules(df: DataFrame, rules: Mapping[str, Column | str], unique: Mapping[str, Sequence[str]] | None = None,
                 references: Mapping[str, tuple[Sequence[str], DataFrame, Sequence[str]]] | None = None,
                 errors_col: str = ERRORS) -> DataFrame:
    """``df`` with ``errors_col``: the names of the rules that a row breaks, in the order given; empty for a sound row.

    ``rules``: conditions on the row; a NULL outcome breaks the rule.
    ``unique``: columns whose values no other row may share; all rows of a
    repeated key break it, and NULL equals NULL. ``references``: (columns,
    table, its columns): the values must occur in the table; a row with a NULL
    among them refers to nothing and breaks nothing.

    Only repeated keys and the distinct keys of a referenced table are joined, so a
    key that holds many rows is one row of the other side.
    """
    if errors_col.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"{errors_col} is a column already")
    tests = {name: F.coalesce(F.expr(r) if isinstance(r, str) else r, F.lit(False)) for name, r in rules.items()}
    own, found, marks = df.columns, df, []
    for name, columns in (unique or {}).items():
        mark = f"_dl_repeated{len(marks)}"
        repeated = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias(mark)).where(F.col(mark) > 1)
        found = join_keys(found, repeated, columns, "left")
        tests[name] = F.col(mark).isNull()
        marks.append(mark)
    for name, (columns, table, others) in (references or {}).items():
        mark = f"_dl_known{len(marks)}"
        known = table.select(*[F.col(f"`{o}`").alias(c) for c, o in zip(columns, others, strict=True)]).distinct() \
            .withColumn(mark, F.lit(True))
        found = join_keys(found, known, columns, "left")
        unset = reduce(or_, [F.col(f"`{c}`").isNull() for c in columns])
        tests[name] = F.col(mark).isNotNull() | unset
        marks.append(mark)
    errors = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in tests.items()])) if tests \
        else F.array().cast("array<string>")
    return found.select(*[F.col(f"`{c}`") for c in own], errors.alias(errors_col))


def quarantine(df: DataFrame, path: str, rules: Mapping[str, Column | str],
               unique: Mapping[str, Sequence[str]] | None = None,
               references: Mapping[str, tuple[Sequence[str], DataFrame, Sequence[str]]] | None = None,
               errors_col: str = ERRORS) -> tuple[DataFrame, DataFrame]:
    """Write sound rows and rejected ones to two folders of ``path`` in one job; returns both as read from there.

    ``path/rejected=false`` has the columns of ``df``, ``path/rejected=true`` also
    ``errors_col``. Every row is in one of them. Columns named ``rejected`` are an error.
    """
    if REJECTED in {c.lower() for c in df.columns}:
        raise ValueError(f"{REJECTED} is a column already")
    marked = broken_rules(df, rules, unique, references, errors_col)
    marked.withColumn(REJECTED, F.size(errors_col) > 0).write.mode("overwrite").partitionBy(REJECTED).parquet(path)
    # the schema is given, as a folder without rows doesn't exist
    both = df.sparkSession.read.schema(marked.schema.add(REJECTED, "boolean")).parquet(path)
    sound, rejected = both.where(~F.col(REJECTED)), both.where(F.col(REJECTED))
    return sound.drop(REJECTED, errors_col), rejected.drop(REJECTED)


# ---------------------------------------------------------------------------
# completeness
# ---------------------------------------------------------------------------

LOAD, PART_OF = "load", "part"


def _present(f: T.StructField, blank_is_missing: bool) -> Column:
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        return F.count_if(c.isNotNull() & ~F.isnan(c))
    if blank_is_missing and isinstance(f.dataType, T.StringType):
        return F.count_if(F.btrim(c) != "")
    return F.count(c)


def completeness_state(df: DataFrame, part: Column | None = None, columns: Sequence[str] | None = None,
                       blank_is_missing: bool = False) -> DataFrame:
    """``(part, column_name, n_rows, n_present)``: how many rows a partition has, and how many hold a value.

    NaN is no value, nor is a text of white space with ``blank_is_missing``. One
    partial aggregate of all columns; only its rows, one a partition, become
    a row for each column. States of disjoint rows add up.
    """
    part = F.lit(None).cast("string") if part is None else part.cast("string")
    fields = [df.schema[c] for c in (columns or df.columns)]
    wide = df.groupBy(part.alias(PART_OF)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array(*[F.struct(F.lit(f.name).alias("column_name"), _present(f, blank_is_missing).alias("n_present"))
                  for f in fields]).alias("columns"))
    return wide.select(PART_OF, F.explode("columns").alias("c"), "n_rows") \
        .select(PART_OF, "c.column_name", "n_rows", "c.n_present")


def record_load(df: DataFrame, path: str, load: str, part: Column | None = None, columns: Sequence[str] | None = None,
                blank_is_missing: bool = False) -> None:
    """Put the state of a load in ``path``; the same load recorded again takes its own place."""
    state = completeness_state(df, part, columns, blank_is_missing)
    overwrite_partitions(state.withColumn(LOAD, F.lit(load)), path, LOAD)


def completeness(state: DataFrame, by_part: bool = False, threshold: float = 0.05) -> DataFrame:
    """``(part,) column_name, n_rows, n_missing, null_share, complete`` from the state of one or more loads.

    A load that didn't have a column yet misses it in all its rows. ``complete``:
    at most ``threshold`` of the rows lack the value.
    """
    by = [PART_OF] if by_part else []
    loads = [LOAD] if LOAD in state.columns else []
    names = [r[0] for r in state.select("column_name").distinct().collect()]  # the columns of one table
    total = state.groupBy(*loads, PART_OF).agg(F.max("n_rows").alias("n_rows")) \
        .groupBy(*by).agg(F.sum("n_rows").alias("n_rows"))
    wanted = total.withColumn("column_name", F.explode(F.array(*map(F.lit, names)).cast("array<string>")))
    held = state.groupBy(*by, "column_name").agg(F.sum("n_present").alias("n_present"))
    found = join_keys(wanted, held, [*by, "column_name"], "left")
    missing = F.col("n_rows") - F.coalesce("n_present", F.lit(0))
    share = missing / F.col("n_rows")
    return found.where("n_rows IS NOT NULL").select(
        *by, "column_name", "n_rows", missing.alias("n_missing"), share.alias("null_share"),
        (share <= threshold).alias("complete"))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{PART_OF} string, column_name string, n_rows long, n_present long, {LOAD} string") \
        .parquet(path)
