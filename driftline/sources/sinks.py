"""Writing tables and reports. Never overwrite a path that is being read:
write to a staging path, then swap."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..functions.timeparse import format_time
from ..session import drop_dir


def format_for_text(df: DataFrame, time_col: str = fixed.TIME_COL,
                    time_format: str = fixed.FMT_ISO) -> DataFrame:
    if time_col in df.columns and isinstance(df.schema[time_col].dataType,
                                             (T.TimestampType, T.TimestampNTZType)):
        return df.withColumn(time_col, format_time(F.col(time_col), time_format))
    return df


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                time_col: str | None = fixed.TIME_COL, time_format: str = fixed.FMT_ISO,
                partition_by: Sequence[str] = (), sort: str = "global",
                observe: tuple[Observation, Sequence[Column]] | None = None) -> str:
    """Write a table; CSV gets a header and the time as text.

    ``sort="global"``: rows ordered by time, NULLs last, across the output
    files in name order (a distributed range sort: sampled bounds, one
    shuffle, no single task). ``"within"``: each file sorted only.
    ``"none"``: as is. ``observe``: metrics of the rows written, taken in
    the tasks that write them.
    """
    out = df
    if time_col and time_col in df.columns and sort != "none":
        key = F.col(time_col).asc_nulls_last()
        out = out.orderBy(key) if sort == "global" else out.sortWithinPartitions(key)
    if fmt in ("csv", "json") and time_col:
        out = format_for_text(out, time_col, time_format)
    if observe:
        out = out.observe(observe[0], *observe[1])
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def replace_table(spark, df: DataFrame, path: str, staging: str, check: Callable[[], None] | None = None,
                  **kw) -> str:
    """Write ``df`` beside ``path``, then swap the two.

    Lets a job rewrite the table it read from, which Spark cannot do in place.
    The new table is complete before anything moves; the old one is renamed
    aside and deleted only once the new one has its place, and comes back if
    that fails. All names are in one folder, so renames stay in one file system.
    ``staging`` gives the name of the new table until then. ``check`` is called
    once it is written; if it raises, the new table is deleted and the old one
    stays.
    """
    staging = f"{path.rstrip('/')}._{staging.rstrip('/').rsplit('/', 1)[-1]}"
    write_table(df, staging, **kw)
    if check:
        try:
            check()
        except Exception:
            drop_dir(spark, staging)
            raise
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dst = jvm.org.apache.hadoop.fs.Path(path)
    src = jvm.org.apache.hadoop.fs.Path(staging)
    fs = dst.getFileSystem(conf)
    old = jvm.org.apache.hadoop.fs.Path(f"{staging}-old")
    had = fs.exists(dst)
    if had and not fs.rename(dst, old):
        raise IOError(f"could not set {path} aside; the new table is {staging}")
    if not _rename(fs, src, dst):
        if had:
            fs.rename(old, dst)
        raise IOError(f"could not move {staging} to {path}; the old table is kept")
    if had:
        fs.delete(old, True)
    return path


def _rename(fs, src, dst) -> bool:
    return fs.rename(src, dst)


def publish(df: DataFrame, uri: str, fmt: str = "csv", **kw) -> str:
    """Publish to any Hadoop file system URI (object stores included)."""
    return write_table(df, uri, fmt=fmt, **kw)


def write_disposition_report(rows: DataFrame, metadata: DataFrame, path: str, mode: str = "overwrite",
                             mappings: DataFrame | None = None) -> str:
    """The discovery report: ``path/metadata`` (one JSON line), ``path/results``, JSON lines by category, and
    ``path/detailed_feature_mappings`` if they are given, with their NULL fields. Nothing is gathered in one row."""
    metadata.write.mode(mode).json(f"{path}/metadata")
    rows.write.mode(mode).partitionBy("category").json(f"{path}/results")
    if mappings is not None:
        mappings.write.mode(mode).option("ignoreNullFields", False).json(f"{path}/detailed_feature_mappings")
    return path


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A nested report as JSON (one object per row)."""
    report.write.mode(mode).json(path)
    return path
