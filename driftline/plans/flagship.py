"""The flagship job: hourly series -> feature table -> drift report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import fixed
from ..operators import drift
from ..session import materialize
from . import suite


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    ft = materialize(suite.feature_table(spark, sf_dir), "feature-table")
    rep = drift.drift_report(ft, fixed.TIME_COL, fixed.DRIFT_FEATURES)
    return rep.select("feature", "pos", "n_recent", "n_baseline", "mean_shift", "variance_shift",
                      "ks_statistic", "is_significant", "drift_type")
