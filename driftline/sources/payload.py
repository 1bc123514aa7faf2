"""Hourly payloads: a JSON object whose ``hourly`` member holds parallel
arrays (``time`` plus one array per metric), turned into one row per hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..functions.numeric import nan_to_null
from ..functions.timeparse import parse_time


def payload_schema(fields: dict[str, str], time_field: str = fixed.PAYLOAD_TIME_FIELD,
                   extra: T.StructType | None = None) -> T.StructType:
    hourly = T.StructType([T.StructField(time_field, T.ArrayType(T.StringType()))] +
                          [T.StructField(f, T.ArrayType(T.DoubleType())) for f in fields])
    base = [T.StructField("hourly", hourly)]
    return T.StructType(base + (list(extra.fields) if extra else []))


def explode_payload(df: DataFrame, fields: dict[str, str], keys: list[str] = (),
                    time_field: str = fixed.PAYLOAD_TIME_FIELD, time_col: str = fixed.TIME_COL,
                    time_format: str = fixed.FMT_PAYLOAD, hourly_col: str = "hourly",
                    check_lengths: bool = False) -> DataFrame:
    """One row per array position: keys, time, then the renamed metrics.

    Shorter arrays are padded with NULL by ``arrays_zip``; ``check_lengths``
    raises instead (the original fails on unequal lengths). NaN -> NULL.
    """
    h = F.col(hourly_col)
    srcs = [time_field, *fields]
    zipped = F.arrays_zip(*[h[s].alias(s) for s in srcs])
    if check_lengths and len(srcs) > 1:
        # part of the exploded expression itself, so it cannot be pruned away
        sizes = [F.size(h[s]) for s in srcs]
        zipped = F.when(F.greatest(*sizes) == F.least(*sizes), zipped).otherwise(
            F.raise_error(F.lit("payload arrays differ in length")))
    rows = df.select(*keys, F.inline(zipped))
    out = [*[F.col(k) for k in keys],
           parse_time(F.col(time_field), time_format).alias(time_col)]
    out += [nan_to_null(F.col(src)).alias(dst) for src, dst in fields.items()]
    return rows.select(*out)


def read_hourly_payload(spark: SparkSession, path: str, fields: dict[str, str],
                        multi_line: bool = True, **kw) -> DataFrame:
    """Read landed payload files (one object per file, or JSON lines with
    ``multi_line=False``) with a fixed schema and explode them."""
    df = spark.read.schema(payload_schema(fields)).option("multiLine", multi_line).json(path)
    return explode_payload(df, fields, **kw)


def parse_payload_text(c: Column, fields: dict[str, str]) -> Column:
    """JSON text of a payload -> the payload struct (fixed schema)."""
    return F.from_json(c, payload_schema(fields))
