"""Loads that rewrite only the partitions they touch.

The table is partitioned by one column that is a function of the time (a day, a
month), so rows of one key and time are in one partition. An upsert reads the
partitions of its batch, and dynamic partition overwrite puts the merged ones in
their place; all others keep their files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..session import materialize
from ..sources.tables import path_exists
from .incremental import upsert

PART = "part"


def overwrite_partitions(df: DataFrame, path: str, part_col: str = PART) -> None:
    """Write ``df`` in place of those partitions of ``path`` that it has rows of; also the first write of a table.

    Large partitions become several files (a rebalancing exchange splits them).
    """
    df.hint("rebalance", part_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(part_col).parquet(path)


def touched_partitions(spark: SparkSession, path: str, parts: DataFrame, part_col: str = PART) -> DataFrame:
    """The rows of ``path`` in the partitions that ``parts`` names; the others aren't read.

    The smallest and largest name are literals that prune the folders; inside of
    them a semi-join does. A NULL partition is one of its own.
    """
    table, name = spark.read.parquet(path), f"`{part_col}`"
    kind = table.schema[part_col].dataType.simpleString()
    named = parts.select(F.col(name).cast(kind).alias("_dl_part")).distinct()
    low, high, nulls = named.agg(F.min("_dl_part"), F.max("_dl_part"), F.max(F.col("_dl_part").isNull())).first()
    inside = F.col(name).between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)
    pruned = table.where(inside | F.col(name).isNull() if nulls else inside)
    return pruned.join(named, F.col(name).eqNullSafe(F.col("_dl_part")), "left_semi")


def upsert_partitions(spark: SparkSession, batch: DataFrame, path: str, partition: Column, keys: Sequence[str] = (),
                      time_col: str | None = fixed.TIME_COL, keep: str = "first", order_cols: Sequence[str] = (),
                      part_col: str = PART) -> DataFrame:
    """``incremental.upsert`` of ``batch`` into the table at ``path``, partition by partition; returns the partitions
    written (``part_col``). ``partition`` is the partition of a row, a function of its time or keys.

    The merged rows are staged before anything is replaced, as the job reads the
    table that it writes. An empty batch writes nothing.
    """
    rows = materialize(batch.withColumn(part_col, partition), "upsert-batch")
    if rows.isEmpty():
        return rows.select(part_col)
    merged = rows
    if path_exists(spark, path):
        existing = touched_partitions(spark, path, rows, part_col)
        merged = upsert(existing, rows.select(*existing.columns), keys=[*keys, part_col], time_col=time_col, keep=keep,
                        order_cols=order_cols)
    else:
        merged = upsert(rows.limit(0), rows, keys=[*keys, part_col], time_col=time_col, keep=keep, order_cols=order_cols)
    overwrite_partitions(materialize(merged, "upsert-merged"), path, part_col)
    return rows.select(part_col).distinct()
