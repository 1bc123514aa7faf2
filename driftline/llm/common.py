"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_dir, materialize, scratch_dir  # noqa: F401  (re-exported)

#: The white space of all contracts: space, tab, line feed, vertical tab, form feed, return.
WS = " \t\n\x0b\x0c\r"

#: Rows in one Arrow batch that goes to a Python worker. Texts may be long, so
#: the default of 10,000 rows would not bound a batch's memory well.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df.mapInArrow(fn, schema)


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def chunks(batch: pa.RecordBatch, column: str, limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of ``batch`` whose texts hold about ``limit`` bytes; a longer text is alone."""
    size, start = 0, 0
    for i, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
        if size and size + (n or 0) > limit:
            yield start, i
            size, start = 0, i
        size += n or 0
    if batch.num_rows > start:
        yield start, batch.num_rows



def join_by_size(left: DataFrame, right: DataFrame, keys: list[str], rows: str, total: int) -> DataFrame:
    """``left`` inner-joined to ``right``, which has one row per key and in ``rows`` how many rows of
    ``left`` its key has (``total`` in all).

    A key may have a third of all rows. At most 4 * partitions keys have more than
    total / (4 * partitions) rows; these are broadcast, all others are joined by a shuffle.
    """
    limit = max(1, total // (4 * shuffle_partitions(left.sparkSession)))
    often = F.broadcast(right.where(F.col(rows) > limit).withColumn("__often", F.lit(True)))
    marked = left.join(often, keys, "left")
    rest = marked.where(F.col("__often").isNull()).select(*left.columns)
    return marked.where("__often").drop("__often").unionByName(
        rest.join(right.where(F.col(rows) <= limit), keys))


def in_chunks(array: Column, size: int = 256) -> Column:
    """An array as an array of its chunks, all of ``size`` elements but the last. An empty one has empty chunks.

    Appending to an array copies it, and a place in a text is found from its
    start, so a scan that goes chunk by chunk copies and walks only chunks.
    """
    last = F.floor((F.size(array) - 1) / size)
    return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0)).cast("int")),
                       lambda k: F.slice(array, k * size + 1, size))
