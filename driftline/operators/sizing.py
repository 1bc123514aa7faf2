"""Runtime size checks that pick a plan, the way AQE picks a broadcast.

A window over one group runs in one task. That is fine while the group is
small and a straggler (or an out-of-memory spill) when one key holds a large
share of the rows. These helpers measure the largest group with one
aggregate (partial, so it is cheap) and let an operator choose between the
one-shuffle plan and the split plan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows one task may sort in a window before the operator splits the group.
ROWS_PER_TASK = 4_000_000
# Ranges per that many rows in a split plan.
RANGE_SPREAD = 4


def ranges_for(rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Number of ordered ranges so that each holds about ``rows_per_task``."""
    return max(1, math.ceil(rows / max(1, rows_per_task)))


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Number of tasks to sort that many rows: the cluster's cores or, of many rows, as many as ranges by default."""
    return max(spark.sparkContext.defaultParallelism, ranges_for(rows) * RANGE_SPREAD)


def series_profile(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """One job: all rows, and the rows of the largest key."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    r = per.agg(F.sum("n").alias("t"), F.max("n").alias("m")).first()
    return int(r["t"] or 0), int(r["m"] or 0)
