"""Every registered query against its DuckDB oracle (sf0.001; a few at sf0.01)."""
import pytest

import __spark_entry__ as entry
from driftline.plans import files, intake, series, suite
from tests.oracle import compare

from .conftest import SF_ORACLE, SF_SMALL

NAMES = [*suite.QUERIES, *files.QUERIES, *series.QUERIES, *intake.QUERIES]  # those of driftline.llm have tests of their own


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_small(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    ok, msg = compare(df, entry.oracle_sql()[name], SF_SMALL)
    assert ok, msg


@pytest.mark.parametrize("name", ["drift_report", "feature_table", "lag_features_global", "dispositions"])
def test_query_matches_oracle_sf001(spark, name):
    df = entry.queries()[name](spark, SF_ORACLE)
    ok, msg = compare(df, entry.oracle_sql()[name], SF_ORACLE)
    assert ok, msg


def test_every_query_has_oracle():
    assert set(NAMES) == set(suite.ORACLE_SQL) | set(files.ORACLE_SQL) | set(series.ORACLE_SQL) | set(intake.ORACLE_SQL) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 44
    assert df.columns[:2] == ["feature", "pos"]
