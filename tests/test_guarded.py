"""Guards that count while they write."""
import os

import pytest
from pyspark.sql import functions as F

from driftline.operators.incremental import upsert
from driftline.sources.guarded import GuardError, replace_guarded
from driftline.sources.sinks import write_table


def _table(spark, path, n):
    write_table(spark.range(n).select(F.col("id"), (F.col("id") % 7).alias("v")), path, fmt="parquet", time_col=None)
    return spark.read.parquet(path)


@pytest.mark.parametrize("how", [{"time_col": None}, {"time_col": "id"}])  # as is, and sorted
def test_counts_are_those_of_the_tables(spark, tmp_dir, how):
    path = os.path.join(tmp_dir, "t")
    existing = _table(spark, path, 1000)
    batch = spark.range(900, 1500).select("id", F.lit(0).cast("bigint").alias("v"))
    stats = replace_guarded(spark, existing, lambda seen: upsert(seen, batch, ["id"], None), path, fmt="parquet", **how)
    assert stats == {"rows_before": 1000, "rows_after": 1500, "rows_added": 500, "changed": True}
    assert spark.read.parquet(path).count() == 1500
    again = replace_guarded(spark, spark.read.parquet(path), lambda seen: upsert(seen, batch, ["id"], None), path, fmt="parquet", **how)
    assert again["rows_added"] == 0 and not again["changed"]


def test_first_load_of_an_empty_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    empty = spark.createDataFrame([], "id long, v long")
    batch = spark.range(10).select("id", F.col("id").alias("v"))
    for rows in (batch.limit(0), batch):
        stats = replace_guarded(spark, empty, lambda seen: upsert(seen, rows, ["id"], None), path, fmt="parquet", time_col=None)
        assert (stats["rows_before"], stats["rows_after"]) == (0, rows.count())


def test_refused_loads_leave_the_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    existing = _table(spark, path, 100)
    keep = spark.range(60)
    merges = {"shrink": (lambda seen: seen.join(keep, "id", "left_semi"), {}),
              "odd": (lambda seen: upsert(seen, existing.limit(0), ["id"], None), {"never": {"odd": F.col("v") == 3, "none": F.col("v") > 9}})}
    for word, (merge, how) in merges.items():
        with pytest.raises(GuardError, match=word) as refused:
            replace_guarded(spark, existing, merge, path, fmt="parquet", time_col=None, **how)
        assert refused.value.stats["rows_before"] == 100
        assert spark.read.parquet(path).count() == 100 and os.listdir(tmp_dir) == ["t"]
    stats = replace_guarded(spark, existing, merges["shrink"][0], path, may_shrink=True, fmt="parquet", time_col=None)
    assert stats["rows_added"] == -40 and spark.read.parquet(path).count() == 60
