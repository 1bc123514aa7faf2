"""Token counts: pieces are counted once per distinct pre-token and joined to
per-document pre-token frequencies; no ids are kept.

Frequencies follow Zipf's law: a few pre-tokens are in nearly every document.
A bounded sample of documents tells which ones are frequent; their counts (at
most ``HOT``) go to every task, which adds them up in place. All other
(document, pre-token) frequencies are joined to the distinct pre-tokens by a
shuffle. The sample only decides which way a pre-token takes, the counts are
the same.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import arrow_map, materialize, text_or_empty

#: Documents in the sample, and pre-tokens whose counts are sent to the tasks (about 2 MB).
SAMPLE, HOT = 10_000, 60_000


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """One row per input row: ``id_col``, n_bytes, n_tokens, over_limit (n_tokens > ``limit``).

    Null text is an empty text of 0 tokens. Rows that repeat an id or a text
    are counted each on their own, null ids too. An empty table gives an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"))

    total = docs.count()
    part = rows.sample(min(1.0, SAMPLE / max(1, total)), seed=7)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(set(tokens.pieces(text, vocabulary)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found.keys()), pa.string()), pa.array(list(found.values()), pa.int64())],
            names=["piece", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([tokens.count(x, vocabulary) for x in own], pa.int64())],
                names=["piece", "pieces"])

    top = arrow_map(part.select("__text"), frequent, "piece string, n long") \
        .groupBy("piece").agg(F.sum("n").alias("n")).where("n > 1") \
        .orderBy(F.desc("n"), "piece").limit(HOT).select("piece")
    hot = spark.sparkContext.broadcast(
        {r.piece: r.pieces for r in arrow_map(top, count, "piece string, pieces long").collect()})

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hot.value
        for batch in batches:
            sums, bytes_, names, freqs = [], [], [], []
            for text in batch.column(1).to_pylist():
                total, own_names, own_freqs = 0, [], []
                for piece, n in Counter(tokens.pieces(text, vocabulary)).items():
                    if (m := known.get(piece)) is None:
                        own_names.append(piece)
                        own_freqs.append(n)
                    else:
                        total += n * m
                sums.append(total)
                bytes_.append(len(text.encode()))
                names.append(own_names)
                freqs.append(own_freqs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bytes_, pa.int64()), pa.array(sums, pa.int64()),
                 pa.array(names, pa.list_(pa.string())), pa.array(freqs, pa.list_(pa.int32()))],
                names=["__id", "n_bytes", "__sum", "__names", "__freqs"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = materialize(arrow_map(
        rows, frequencies,
        f"__id {kind}, n_bytes long, __sum long, __names array<string>, __freqs array<int>")
        .withColumn("__row", F.monotonically_increasing_id()), "piece-frequencies")
    pairs = found.select("__row", F.explode(F.arrays_zip("__names", "__freqs")).alias("p")) \
        .select("__row", F.col("p.__names").alias("piece"), F.col("p.__freqs").alias("n"))
    counted = arrow_map(pairs.select("piece").distinct(), count, "piece string, pieces long")
    rest = pairs.join(counted, "piece").groupBy("__row").agg(F.sum(F.col("n") * F.col("pieces")).alias("__rest"))
    n_tokens = F.col("__sum") + F.coalesce("__rest", F.lit(0))
    return found.select("__row", "__id", "n_bytes", "__sum").join(rest, "__row", "left").select(
        F.col("__id").alias(id_col), "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"))
