"""Importance resampling towards a target distribution.

Texts are bags of hashed runs of one to three words. The buckets of all
documents and of all target texts are counted; a bucket's gain is the scaled log
ratio of its shares, and a document's weight the sum of the gains of its
features, which a task adds up from arrays. Weights and Gumbel noise that
depends on the id alone make a score, and the highest scores are a sample drawn
without replacement with chances as the weights say.

The cutoff is sought by bisection of the score, then of the id among rows of
that score: each step is an exact count over the persisted scores. The drawn
rows are range-partitioned for their ranks, so no task or group holds them all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, materialize, shuffle_partitions, text_or_empty
from .terms import terms

BUCKETS, RUN = 10_000, 3
#: Cuts that one counting job tries at once, which is four halvings.
CUTS = 15


def buckets(text: str, n_buckets: int = BUCKETS, run: int = RUN) -> np.ndarray:
    """The bucket of every feature of a text.

    A longer run's checksum goes on from that of the run without its last word.
    """
    words = terms(text)
    sums = list(map(crc32, words))
    out = [np.array(sums, dtype=np.int64)]
    spaced = [b" " + w for w in words]
    for k in range(1, run):
        sums = list(map(crc32, spaced[k:], sums))
        out.append(np.array(sums, dtype=np.int64))
    return np.concatenate(out) % n_buckets


def bucket_counts(texts: DataFrame, text_col: str = "text", n_buckets: int = BUCKETS, run: int = RUN) -> DataFrame:
    """``bucket, n``: how many features of all texts each bucket holds. Every task adds up in place."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(buckets(text, n_buckets, run), minlength=n_buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return arrow_map(texts.select(text_or_empty(text_col).alias("__text")), count, "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", n_buckets: int = BUCKETS,
          run: int = RUN) -> np.ndarray:
    """The gain of every bucket."""
    found = []
    for texts in (docs, target):
        count = np.zeros(n_buckets, dtype=np.int64)
        for row in bucket_counts(texts, text_col, n_buckets, run).collect():  # n_buckets rows at most
            count[row.bucket] = row.n
        found.append(count)
    (own, wanted), (total, total_wanted) = found, (int(x.sum()) for x in found)
    return np.array([math.floor(1000 * math.log(
        float(int(t) + 1) * float(total + n_buckets) / (float(int(s) + 1) * float(total_wanted + n_buckets))))
        for s, t in zip(own, wanted)], dtype=np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, text_col: str = "text", run: int = RUN) -> DataFrame:
    """``docs`` without its text, with __features, __words and __weight."""
    known = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket
    own = [c for c in docs.columns if c != text_col]
    rows = docs.select(*own, text_or_empty(text_col).alias("__text"))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = known.value
        for batch in batches:
            found = [buckets(text, len(gain), run) for text in batch.column(len(own)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([len(x) for x in found], pa.int64()),
                 pa.array([int(gain[x].sum()) for x in found], pa.int64())],
                names=[*own, "__features", "__weight"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return arrow_map(rows, weigh, f"{fields}__features long, __weight long")


def features_of(words: int, run: int = RUN) -> int:
    """The features of a text of so many words."""
    return sum(max(0, words - k) for k in range(run))


def noise(seed: int, id_col: str) -> Column:
    """Gumbel noise in thousandths, a function of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256),
                           1, 8), 16, 10).cast("bigint")
    return -1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))


def first_rows(rows: DataFrame, order: list[str], k: int) -> Column | None:
    """The condition that holds for the ``k`` first of ``rows`` by the long columns ``order``, which tell all rows apart.

    Column by column, bisection finds the least value up to which enough rows go; those below it are in, and those
    that have it are told apart by the next column. ``None`` if k is 0.
    """
    if k <= 0:
        return None
    inside, tied, left = F.lit(False), F.lit(True), k
    for name in order:
        part = rows.where(tied)
        low, high = part.agg(F.min(name), F.max(name)).first()
        while low < high:
            # cuts are below high, so what isn't enough up to the last of them is enough up to high
            step = max(1, -(-(high - low) // (CUTS + 1)))
            cuts = list(range(low + step - 1, high, step))
            up_to = part.agg(*[F.count(F.when(F.col(name) <= F.lit(cut), 1)) for cut in cuts]).first()
            enough = next((i for i, n in enumerate(up_to) if n >= left), len(cuts))
            low, high = (cuts[enough - 1] + 1 if enough else low), (cuts[enough] if enough < len(cuts) else high)
        inside = inside | tied & (F.col(name) < F.lit(low))
        left -= part.where(F.col(name) < F.lit(low)).count()
        tied = tied & (F.col(name) == F.lit(low))
        if rows.where(tied).count() == left:
            break
    return inside | tied


def ranked(rows: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """``rows`` with their place by ``order`` from 1 on: ranges sorted apart, and the ranges' sizes added up."""
    n = shuffle_partitions(rows.sparkSession)
    # the number holds the range above bit 33 and the place in it below; written, as ranges are sampled
    placed = materialize(rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn("__place", F.monotonically_increasing_id()), "resample-ranges")
    inside = F.col("__place").bitwiseAND((1 << 33) - 1)
    placed = placed.select("*", F.shiftright("__place", 33).alias("__range"), (inside + 1).alias("__inside"))
    before = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("__range").agg(F.max("__inside").alias("__size")).select(
        "__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))  # one row for each of the n ranges
    return placed.join(F.broadcast(offsets), "__range") \
        .withColumn(name, F.col("__offset") + F.col("__inside")).drop("__place", "__range", "__inside", "__offset")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text", n_buckets: int = BUCKETS) -> DataFrame:
    """One row per input row: ``id_col``, n_features, weight, score, rank (null for rows that aren't drawn).

    Of the rows with at least ``least_words`` words, ``percent`` in a hundred are drawn (rounded down), those with
    the highest scores, ties to the smaller id, null ids last. Ids are integers. Rows that repeat an id have the
    same noise and are drawn each on its own; equal ones are told apart arbitrarily, with the same result. Null and
    empty texts have no features, weight 0, and are never drawn. Empty target texts only smooth; an empty table
    gives an empty result. Other columns are ignored.
    """
    gain = gains(docs, target, text_col, n_buckets)
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).cast("bigint").alias("__id"), F.col(text_col).alias("__given"))
    score = F.col("__weight") + F.floor(noise(seed, "__id")).cast("bigint")
    rows = materialize(weighed(slim, gain, "__given").select(
        "__id", "__features", "__weight", score.alias("__score"), (-score).alias("__falling"),
        F.col("__id").isNull().cast("bigint").alias("__none"), F.coalesce("__id", F.lit(0)).alias("__known"),
        F.monotonically_increasing_id().alias("__row")), "resample-scores")
    may = F.col("__features") >= features_of(least_words)
    order = ["__falling", "__none", "__known", "__row"]
    could = rows.where(may)
    drawn = first_rows(could, order, percent * could.count() // 100)

    def result(some: DataFrame, rank: Column) -> DataFrame:
        return some.select(F.col("__id").cast(kind).alias(id_col), F.col("__features").alias("n_features"),
                           F.col("__weight").alias("weight"), F.col("__score").alias("score"), rank.alias("rank"))

    none = F.lit(None).cast("bigint")
    if drawn is None:
        return result(rows, none)
    return result(rows.where(~(may & drawn)), none).unionAll(
        result(ranked(rows.where(may & drawn), order), F.col("rank")))
