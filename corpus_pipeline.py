"""From raw documents to packed training sequences, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir), where
``docs`` has the columns of ``documents``, and returns what it keeps with the
same columns (whatever extra ones there are and whatever their names), the last one the packed pieces. Nulls, empty and repeated rows are
handled as the operators of ``driftline.llm`` say; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import lines, mixing, near, packing, quality, tokens
from driftline.session import materialize

VOCABULARY = "byte_bpe_50k.json"
#: Column of the stages that holds the rest of a document.
DOC = "__document"


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``docs``, and all others but the text in one struct, so that no name clashes with an operator's."""
    return docs.select(*columns, F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias(DOC))


def _unpacked(rows: DataFrame, docs: DataFrame, new_text: bool = False) -> DataFrame:
    """The columns of ``docs`` in their order; n_chars as the text has them now if that is ``new_text``."""

    def column(name: str) -> Column:
        if name == "text":
            return rows["text"]
        if name == "n_chars" and new_text:
            return F.length(rows["text"]).cast(docs.schema[name].dataType).alias(name)
        return rows[DOC].getField(name).alias(name)

    return rows.select(*[column(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others stay as they are."""
    return _unpacked(quality.quality_rules(_packed(docs, "text")).where("kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; every document stays, with its other lines."""
    return _unpacked(lines.line_dedup(_packed(docs, "doc_id", "text")), docs, new_text=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, the one with the smallest id (null is the largest)."""
    # ids may repeat or be null; written, as the row numbers must be the same in every read
    rows = materialize(_packed(docs, "text").withColumn("row", F.monotonically_increasing_id()), "near-rows")
    own = F.col(DOC).getField("doc_id")
    keyed = rows.select("text", F.struct(own.isNull().alias("without"), own.alias("doc_id"), "row").alias("key"))
    kept = near.near_duplicates(keyed, id_col="key").where("kept").select("key.row")
    return _unpacked(rows.join(kept, "row", "left_semi"), docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, each source's last one cut at its budget."""
    mixed = mixing.mix(_packed(docs, "doc_id", "text", "source"), carry=("text", DOC))
    return _unpacked(mixing.repeated(mixed), docs, new_text=True)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.pack_documents(docs, tokens.default_path(VOCABULARY))


STAGES = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("source_mixing", source_mixing), ("sequence_packing", sequence_packing),
]

#: The first, third and last stage have no SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
