"""Exact deduplication by sorting whole contents.

Rows are range-partitioned by sampled splitters over their normalised bytes,
sorted externally inside the ranges, and neighbours are compared in full, so
equal texts form runs whose smallest identifier stays. Everything is
DataFrame functions.

A group of copies may hold a third of all rows. One counting pass finds the
texts with more than ``rows / (4 * partitions)`` copies (there can be at most
``4 * partitions`` of them, so the list may be broadcast); their rows get a
salt, which splits the run into several. The few sub-runs of each such text
are then joined again, once more by full comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions, text_or_empty

#: Leading characters that the splitters see; the hash of the whole text
#: places texts that share a longer prefix, so splitters stay small.
PREFIX = 64


def normalised(col: str) -> Column:
    """Every run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(col), "[ \\t-\\r]+", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256.

    Null text is an empty text. Null ids sort last, so such a row stays only if
    all its copies have null ids (keep_id is null then). Of rows that repeat
    both text and id exactly one has ``kept``. An empty table gives an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    rows = docs.select(F.col(id_col).alias("__id"), normalised(text_col).alias("__norm")) \
        .withColumn("__h", F.xxhash64("__norm"))
    limit = max(1, docs.count() // (4 * n))
    hot = rows.groupBy("__h").count().where(F.col("count") > limit) \
        .select("__h", F.ceil(F.col("count") / limit).alias("__salts"))

    salted = rows.join(F.broadcast(hot), "__h", "left").select(
        "__id", "__norm", "__h", F.substring("__norm", 1, PREFIX).alias("__p"),
        F.when(F.col("__salts").isNull(), F.lit(-1).cast("bigint"))
        .otherwise(F.pmod(F.xxhash64("__id"), F.col("__salts"))).alias("__salt"))
    # The partition columns of the window contain those of the range exchange,
    # so the window needs no second shuffle of the texts.
    run = Window.partitionBy("__p", "__h", "__salt", "__norm").orderBy(F.asc_nulls_last("__id"))
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = salted.repartitionByRange(n, "__p", "__h", "__salt").select(
        "__id", "__salt", "__norm",
        F.row_number().over(run).alias("__rn"),
        F.first("__id").over(whole).alias("__keep"),
        F.count(F.lit(1)).over(whole).alias("__n")) \
        .select("__id", "__salt", "__rn", "__keep", "__n", F.sha2("__norm", 256).alias("__sha"),
                F.when((F.col("__rn") == 1) & (F.col("__salt") >= 0), F.col("__norm")).alias("__text"))
    runs = materialize(runs, "exact-runs")

    # At most 8 * partitions sub-runs of hot texts: their texts are compared in full again.
    merged = runs.where(F.col("__text").isNotNull()).groupBy("__text", "__sha").agg(
        F.sum("__n").alias("__all"),
        F.min(F.struct(F.col("__keep").isNull().alias("none"), F.col("__keep").alias("id"),
                       F.col("__salt").alias("salt"))).alias("__first")) \
        .select(F.col("__sha").alias("__msha"), "__all", "__first")
    is_hot = F.col("__salt") >= 0
    return runs.join(F.broadcast(merged), is_hot & (F.col("__sha") == F.col("__msha")), "left").select(
        F.col("__id").alias(id_col),
        F.when(is_hot, F.col("__first.id")).otherwise(F.col("__keep")).alias("keep_id"),
        F.when(is_hot, F.col("__all")).otherwise(F.col("__n")).alias("group_size"),
        ((F.col("__rn") == 1) & (~is_hot | (F.col("__salt") == F.col("__first.salt")))).alias("kept"),
        F.col("__sha").alias("text_sha256"))
