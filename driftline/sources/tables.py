"""Reading hourly tables from CSV/JSON/Parquet with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..functions.timeparse import parse_mixed_timestamp, parse_time


def raw_schema(time_as_text: bool = True) -> T.StructType:
    """The 12-column raw hourly table (time as text for CSV reads)."""
    t = T.StringType() if time_as_text else T.TimestampNTZType()
    return T.StructType([T.StructField(fixed.TIME_COL, t)] +
                        [T.StructField(c, T.DoubleType()) for c in fixed.RAW_COLUMNS[1:]])


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "csv", time_col: str | None = fixed.TIME_COL,
               time_formats: Sequence[str] | str | None = (fixed.FMT_ISO,),
               on_bad: str = "fail") -> DataFrame:
    """Read a table and parse its time column.

    ``on_bad="fail"``: one format, text that does not match raises (read
    errors propagate before anything is written). ``on_bad="null"``: bad
    text -> NULL; several formats are tried in order (mixed files).
    """
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        # columns are checked against the header: one in another place is an error, not shifted values
        df = r.option("header", True).option("enforceSchema", False).csv(path)
    elif fmt == "json":
        df = r.json(path)
    else:
        df = r.format(fmt).load(path)
    if time_col is None or time_col not in df.columns:
        return df
    if isinstance(df.schema[time_col].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df.withColumn(time_col, F.col(time_col).cast("timestamp_ntz"))
    formats = [time_formats] if isinstance(time_formats, str) else list(time_formats or [])
    if on_bad == "fail":
        parsed = parse_time(F.col(time_col), formats[0] if formats else None, "fail")
    elif len(formats) > 1:
        parsed = parse_mixed_timestamp(F.col(time_col), formats)
    else:
        parsed = parse_time(F.col(time_col), formats[0] if formats else None, "null")
    return df.withColumn(time_col, parsed)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin redistribute a scan that has fewer splits than the
    cluster has cores (``spark.default.parallelism``).

    A Parquet row group is the smallest unit a scan can split, so a small
    file written as one row group is read by ONE task, and every per-row
    step fused into that stage runs single-threaded. Large inputs have many
    splits and pass through unchanged: the gate never adds a shuffle there.
    Filters and column pruning still reach the scan below the repartition.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    n = df.rdd.getNumPartitions()
    return df.repartition(want) if n < want else df


def read_parquet(spark: SparkSession, path: str, parallel: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    return spread(df) if parallel else df


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def load_or_empty(spark: SparkSession, path: str, schema: T.StructType, **kw) -> DataFrame:
    """The table at ``path``, or an empty table with the full schema when it
    does not exist yet (first run). Read errors of an existing table raise."""
    if path_exists(spark, path):
        return read_table(spark, path, schema=schema, **kw)
    empty = spark.createDataFrame([], schema)
    tc = kw.get("time_col", fixed.TIME_COL)
    if tc in empty.columns and isinstance(schema[tc].dataType, T.StringType):
        empty = empty.withColumn(tc, F.col(tc).cast("timestamp_ntz"))
    return empty


def resolve_time_col(df: DataFrame, candidates: Sequence[str] = ("datetime", "date")) -> str:
    for c in candidates:
        if c in df.columns:
            return c
    raise KeyError(f"none of {list(candidates)} in {df.columns}")


def column_catalog(df: DataFrame, name: str = "column_name") -> DataFrame:
    """The table's column names as a one-column DataFrame (no data scan)."""
    spark = df.sparkSession
    return spark.createDataFrame([(i, c) for i, c in enumerate(df.columns)],
                                 f"pos int, {name} string")


def read_requested_features(spark: SparkSession, path: str,
                            member: str = "features_to_add") -> DataFrame:
    """``(pos, feature)`` from the list member of JSON report files.

    The schema is inferred from the files' texts: inference on files of many
    lines puts all their names into the settings of each one, so its work is
    quadratic in the files. That is left for files whose texts don't show the
    member (in UTF-16, say).
    """
    schema = spark.read.json(spark.read.text(path, wholetext=True).rdd.map(lambda row: row[0])).schema
    reader = spark.read.option("multiLine", True)
    if member in schema.names:
        reader = reader.schema(schema)
    return reader.json(path).select(F.posexplode(member).alias("pos", "feature"))
