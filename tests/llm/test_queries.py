"""The registered queries against their SQL, and the pipeline stage by stage."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from driftline.llm import queries
from driftline.session import materialize
from tests.conftest import SF_SMALL
from tests.llm.test_operators import plain_components, plain_quality, tokenized
from tests.oracle import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_sql(spark, con, name):
    ok, message = compare(queries.QUERIES[name](spark, SF_SMALL), queries.ORACLE_SQL[name], SF_SMALL, con=con)
    assert ok, message


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLE_SQL])
def test_one_row_for_each_input(spark, con, name):
    table, key = ("pages", "page_id") if "html" in name else ("documents", "doc_id")
    found = {r[0] for r in queries.QUERIES[name](spark, SF_SMALL).select(key).collect()}
    assert found == {r[0] for r in con.execute(f"SELECT {key} FROM {table}").fetchall()}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, after = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF_SMALL), name)
        after[name] = docs
        if name != "sequence_packing":
            assert docs.columns == columns and docs.dtypes == before.dtypes
    rows = {n: {r.doc_id: r for r in d.collect()} for n, d in after.items() if n != "sequence_packing"}
    first = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert all(r == rows["quality_rules"][r.doc_id] for r in first if r.doc_id in rows["quality_rules"])
    assert not any(plain_quality(r.text)[-1] for r in rows["quality_rules"].values())
    assert rows["line_dedup"].keys() == rows["quality_rules"].keys()
    given = [(r.doc_id, r.text) for r in rows["line_dedup"].values()]
    assert rows["near_dedup"].keys() == {i for i, _, least in plain_components(given) if i == least}
    mixed = after["source_mixing"].collect()
    assert all(r.n_chars == len(r.text) and rows["near_dedup"][r.doc_id].text.startswith(r.text) for r in mixed)
    pieces = after["sequence_packing"].collect()
    assert sum(p.length for p in pieces) == sum(len(tokenized(r.text)) + 1 for r in mixed)


def test_near_dedup_of_repeated_and_missing_ids(spark):
    def text(mark: str, n: int = 30) -> str:
        return " ".join(f"{mark}{i}" for i in range(n))

    rows = [(1, text("a")), (1, text("a")),                   # an id and text twice: one stays
            (2, text("b")), (3, text("c")), (3, text("b")),   # the second row of id 3 is a copy of 2
            (None, text("d")), (None, text("d")),             # copies without an id: one stays
            (None, text("e")), (4, text("e", 31)),            # 4 stays, its near copy without an id goes
            (None, text("f")), (None, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = corpus_pipeline.near_dedup(spark, docs, SF_SMALL)
    assert found.columns == docs.columns
    assert Counter(map(tuple, found.collect())) == Counter([
        (1, text("a")), (2, text("b")), (3, text("c")), (None, text("d")), (4, text("e", 31)), (None, text("f")),
        (None, None), (5, "")])


def test_empty_pipeline(spark, tmp_dir):
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false").write.parquet(f"{tmp_dir}/documents.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).collect() == []


def test_pipeline_with_clashing_columns(spark):
    """Extra columns named like an operator's own pass through every stage as they were."""
    names = ["size", "source_size", "target", "taken", "n_words", "n_lines", "n_dropped", "kept", "base_failed", "__row", "row",
             "__key", "key", "__id", "n_shingles", "component_id", "__text", "h", "__carried"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).select(
        *[F.concat(F.lit(f"{c}:"), F.col("doc_id")).alias(c) for c in names], "*")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF_SMALL), name)
        if name != "sequence_packing":
            assert docs.columns == before.columns
            for r in docs.collect():
                assert all(r[c] == f"{c}:{r.doc_id}" for c in names)
    assert docs.count()
