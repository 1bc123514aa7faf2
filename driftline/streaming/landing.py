"""The daily ingest as a Structured Streaming job.

Payload files landed in two folders (pollutants, weather) are read as file
streams, exploded to hourly rows, joined on the hour and appended to the
raw table. The sink keeps the first row per hour (existing rows win), like
the batch ``ingest_day``:

* by default no hour is too late: each side's new hours are kept in a table of
  its own, by date, and a micro-batch joins the two sides on the dates that it
  brought rows of. State lies in files, so it isn't held in memory, nothing
  expires, and an hour whose other side comes weeks later is joined then;
* with ``watermark`` the two streams are joined in Spark's state store instead,
  and state of old hours is dropped. **Hours that land later than the
  watermark may then be left out without a message, and for good**;
* ``foreachBatch`` appends only the hours that are not in the target yet.
  The anti-join reads just the key columns of the target partitions (by
  date) that the micro-batch touches, so its cost follows the batch, not the
  table; and a retried batch finds its rows already present and appends
  nothing, so retries are idempotent.

Run with ``available_now=True`` for a scheduled daily job (process what has
landed, then stop) or without it for a continuous job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed
from ..operators.incremental import join_on_time, new_rows
from ..sources.payload import explode_payload, payload_schema
from ..sources.tables import path_exists

DATE_COL, SIDE = "date", "side"


def payload_stream(spark: SparkSession, folder: str, fields: dict[str, str],
                   multi_line: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming hourly rows from payload files landing in ``folder``."""
    r = spark.readStream.schema(payload_schema(fields)).option("multiLine", multi_line)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return explode_payload(r.json(folder), fields)


def of_dates(rows: DataFrame) -> Column | None:
    """A filter for the dates (one value a day) that ``rows`` have, which prunes partitions; None without rows."""
    dates = [r[0] for r in rows.select(DATE_COL).distinct().collect()]
    if not dates:
        return None
    touched = F.col(DATE_COL).isin([d for d in dates if d is not None])
    return touched | F.col(DATE_COL).isNull() if None in dates else touched


def append_new_hours(batch: DataFrame, target: str, keys: Sequence[str] = (),
                     time_col: str = fixed.TIME_COL, fmt: str = "parquet") -> int:
    """Append the batch rows whose (keys, hour) is not in ``target`` yet.

    The target is partitioned by ``date``; only the partitions of the dates
    in the batch are read (literal filter -> partition pruning). Returns the
    number of rows appended.
    """
    keys = list(keys)
    on = [*keys, time_col]
    w = Window.partitionBy(*on).orderBy(F.lit(1))
    b = (batch.withColumn("_dl_rn", F.row_number().over(w)).filter("_dl_rn = 1").drop("_dl_rn")
         .withColumn(DATE_COL, F.to_date(time_col)))
    spark = batch.sparkSession
    if path_exists(spark, target):
        touched = of_dates(b)
        if touched is None:
            return 0
        existing = spark.read.format(fmt).load(target).filter(touched).select(*on)
        b = new_rows(b, existing, keys=keys, time_col=time_col)
    b = b.persist()
    n = b.count()
    if n:
        b.write.mode("append").partitionBy(DATE_COL).format(fmt).save(target)
    b.unpersist()
    return n


def join_sides(batch: DataFrame, sides: dict[str, Sequence[str]], halves: str, target: str,
               keys: Sequence[str] = (), time_col: str = fixed.TIME_COL, fmt: str = "parquet") -> int:
    """Keep each side's new hours under ``halves`` and append those hours to ``target`` that now have all sides.

    ``batch`` has a column ``side`` and the columns of all sides; ``sides`` gives
    those of each. The join takes the stored hours of the batch's dates, so a
    batch that failed half-way is made whole when it is run again. Returns
    the number of hours appended.
    """
    spark, on = batch.sparkSession, [*keys, time_col]
    batch = batch.persist()
    try:
        touched = of_dates(batch.withColumn(DATE_COL, F.to_date(time_col)))
        if touched is None:
            return 0
        for side, columns in sides.items():
            own = batch.where(F.col(SIDE) == side).select(*on, *[F.col(f"`{c}`") for c in columns])
            append_new_hours(own, f"{halves}/{side}", keys, time_col, fmt)
        if not all(path_exists(spark, f"{halves}/{side}") for side in sides):
            return 0
        joined = None
        for side in sides:
            rows = spark.read.format(fmt).load(f"{halves}/{side}").filter(touched).drop(DATE_COL)
            joined = rows if joined is None else join_on_time(joined, rows, keys, time_col)
        return append_new_hours(joined, target, keys, time_col, fmt)
    finally:
        batch.unpersist()


def ingest_stream(spark: SparkSession, pollutant_dir: str, weather_dir: str, target: str,
                  checkpoint: str, watermark: str | None = None, available_now: bool = True,
                  fmt: str = "parquet", log: list | None = None, halves: str | None = None,
                  multi_line: bool = True):
    """Start the ingest stream; returns the StreamingQuery.

    ``halves`` is the folder of the hours of each side, ``target`` with ``-halves``
    behind it if not given; a ``watermark`` ("2 days") goes without it.
    """
    halves = halves or f"{target.rstrip('/')}-halves"
    pol = payload_stream(spark, pollutant_dir, fixed.POLLUTANT_FIELDS, multi_line)
    wea = payload_stream(spark, weather_dir, fixed.WEATHER_FIELDS, multi_line)
    if watermark is None:
        sides = {side: [c for c in df.columns if c != fixed.TIME_COL] for side, df in (("pollutant", pol), ("weather", wea))}
        rows = pol.withColumn(SIDE, F.lit("pollutant")).unionByName(
            wea.withColumn(SIDE, F.lit("weather")), allowMissingColumns=True)
    else:
        # event time must be TIMESTAMP for watermarks; the session zone is UTC,
        # so the cast keeps the wall-clock hour
        pol = pol.withColumn("_dl_et", F.col(fixed.TIME_COL).cast("timestamp")).withWatermark("_dl_et", watermark)
        wea = wea.withColumn("_dl_et2", F.col(fixed.TIME_COL).cast("timestamp")).drop(fixed.TIME_COL) \
            .withWatermark("_dl_et2", watermark)
        rows = pol.join(wea, F.col("_dl_et") == F.col("_dl_et2"), "inner").drop("_dl_et", "_dl_et2")

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        if watermark is None:
            n = join_sides(batch_df, sides, halves, target, fmt=fmt)
        else:
            n = append_new_hours(batch_df.select(*[F.col(f"`{c}`") for c in fixed.RAW_COLUMNS]), target, fmt=fmt)
        if log is not None:
            log.append((batch_id, n))

    w = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()
