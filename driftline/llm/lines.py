"""Line deduplication against levelled sorted runs of line hashes.

Documents come in batches of rising ids. The hashes already seen are kept in
sorted runs, tables that are bucketed and sorted by hash, so joining a batch to
them moves only the batch. A batch is anti-joined to all runs, and what is new
in it becomes a run of level 0; when a level has ``fanout`` runs they are merged
into one of the next. Everything is DataFrame functions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS, join_by_size, scratch_dir, shuffle_partitions, text_or_empty

MIN_CHARS = 10
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case.

    ``lower`` does the same, and faster, unless the line has other letters that
    have a lower case.
    """
    bare = F.btrim(line, F.lit(WS))
    return F.when(bare.rlike(r"[\p{Lu}\p{Lt}\p{IsUppercase}&&[^A-Z]]"), F.translate(bare, UPPER, UPPER.lower())) \
        .otherwise(F.lower(bare))


def line_hash(line: Column, min_chars: int = MIN_CHARS) -> Column:
    """The 128-bit hash of a line's key, null for keys that are too short to count."""
    key = line_key(line)
    return F.when(F.length(key) >= min_chars, F.md5(key))


#: Hashes up to which a line's is sought one by one; in more, by halving.
FEW = 32


def holds(ordered: Column, value: Column, powers: Column) -> Column:
    """Whether the sorted array holds ``value``, by binary search; ``powers``: of two, falling to 1, up to its size.

    Between two lookups the place of the largest element up to ``value`` is known to the next binary digit.
    """
    place = F.aggregate(powers, F.lit(0), lambda at, step: F.when(
        F.get(ordered, at + step) <= value, at + step).otherwise(at))
    return F.get(ordered, place) == value


class Runs:
    """Levels of sorted runs of distinct line hashes."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.buckets = shuffle_partitions(spark)
        self.name = f"line_runs_{uuid.uuid4().hex[:12]}"
        self.levels: list[list[str]] = []
        self.made: list[str] = []

    def _write(self, hashes: DataFrame) -> str:
        name = f"{self.name}_{len(self.made)}"
        hashes.repartition(self.buckets, "h").write.bucketBy(self.buckets, "h").sortBy("h").saveAsTable(name)
        self.made.append(name)
        return name

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` whose hash is in no run."""
        for level in self.levels:
            for run in level:
                keys = keys.join(self.spark.table(run), "h", "left_anti")
        return keys

    def add(self, hashes: DataFrame) -> None:
        """Add hashes that are in no run; merge full levels."""
        new, level = self._write(hashes), 0
        while True:
            if len(self.levels) == level:
                self.levels.append([])
            self.levels[level].append(new)
            if len(self.levels[level]) < self.fanout:
                return
            merged = [self.spark.table(run) for run in self.levels[level]]
            union = merged[0]
            for run in merged[1:]:
                union = union.unionAll(run)
            new = self._write(union)
            for run in self.levels[level]:
                self.spark.sql(f"DROP TABLE {run}")
            self.levels[level] = []
            level += 1

    def drop(self) -> None:
        for name in self.made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def line_dedup(docs: DataFrame, batches: int = 4, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` with the remaining lines in ``text_col``, and n_lines, n_dropped.

    A line whose key has at least ``min_chars`` characters stays only in the
    smallest id that holds it, there as often as it occurs. A null or empty text
    is one empty line and stays empty. Ids are numbers; rows that repeat an id
    are one holder and are all cut alike; null ids count as one largest id.
    Hashes are gathered by id and text, so no more than a text's lines come
    together, however many rows an id has. An empty table gives an empty result. Columns named like the results are
    replaced, others stay.
    """
    spark = docs.sparkSession
    docs = docs.select(*[text_or_empty(c).alias(c) if c == text_col else docs[c] for c in docs.columns])
    own = docs.columns
    lines = F.split(F.col(text_col), "\n", -1)

    # Distinct (id, hash) pairs by batch, batches cut at quantiles of the id.
    cuts = docs.approxQuantile(id_col, [i / batches for i in range(1, batches)], 0.01)
    cuts = sorted(set(cuts))
    batch = F.when(F.col(id_col).isNull(), len(cuts))
    for i, cut in enumerate(cuts):
        batch = batch.when(F.col(id_col) <= cut, i)
    pairs_dir, drops_dir = scratch_dir(spark, "line-pairs"), scratch_dir(spark, "line-drops")
    of = F.xxhash64(F.col(text_col))  # texts of one id that share it are cut alike by the union of their hashes
    docs.select(F.col(id_col).alias("__id"), of.alias("__of"), batch.otherwise(len(cuts)).alias("__batch"),
                F.explode(F.array_distinct(F.filter(F.transform(
                    lines, lambda x: line_hash(x, min_chars)), lambda x: x.isNotNull()))).alias("h")) \
        .write.partitionBy("__batch").parquet(pairs_dir)
    kind = docs.schema[id_col].dataType.simpleString()
    pairs = spark.read.schema(f"__id {kind}, __of long, h string, __batch int").parquet(pairs_dir)

    # For every hash that drops lines in a batch: the id in the batch that keeps them, if any.
    runs = Runs(spark)
    try:
        for i in range(len(cuts) + 1):
            keys = pairs.where(F.col("__batch") == i).groupBy("h").agg(
                F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
            new = runs.unseen(keys)
            new.write.parquet(f"{drops_dir}/new/__batch={i}")
            new = spark.read.schema(f"h string, __first {kind}, __n long").parquet(f"{drops_dir}/new/__batch={i}")
            keys.join(new.select("h", F.lit(True).alias("__new")), "h", "left") \
                .where(F.col("__new").isNull() | (F.col("__n") > 1)) \
                .select("h", F.when(F.col("__new"), F.col("__first")).alias("__first"),
                        F.coalesce("__new", F.lit(False)).alias("__new"), "__n") \
                .write.parquet(f"{drops_dir}/drops/__batch={i}")
            runs.add(new.select("h"))
    finally:  # tables of the warehouse outlive the session
        runs.drop()
    drops = spark.read.schema(f"h string, __first {kind}, __new boolean, __n long, __batch int") \
        .parquet(f"{drops_dir}/drops")

    marked = join_by_size(pairs, drops, ["h", "__batch"], "__n", pairs.count())
    goes = ~F.col("__new") | F.col("__id").isNull() & F.col("__first").isNotNull() | (F.col("__id") > F.col("__first"))
    gone = marked.where(goes).groupBy(F.col("__id").alias("__gone"), "__of") \
        .agg(F.sort_array(F.collect_set("h")).alias("__hashes")) \
        .withColumn("__powers", F.transform(F.sequence(F.floor(F.log2(F.size("__hashes"))), F.lit(0), F.lit(-1)),
                                            lambda k: F.pow(F.lit(2), k).cast("int")))

    def without(search) -> Column:
        hashed = F.transform(lines, lambda x: F.struct(x.alias("line"), line_hash(x, min_chars).alias("h")))
        return F.transform(F.filter(hashed, lambda x: F.coalesce(~search(x["h"]), F.lit(True))), lambda x: x["line"])

    found = docs.join(gone, docs[id_col].eqNullSafe(F.col("__gone")) & (of == F.col("__of")), "left")
    stays = F.when(F.col("__hashes").isNull(), lines) \
        .when(F.size("__hashes") <= FEW, without(lambda h: F.array_contains("__hashes", h))) \
        .otherwise(without(lambda h: holds(F.col("__hashes"), h, F.col("__powers"))))
    kept = found.select(*own, F.size(lines).cast("bigint").alias("__n_lines"), stays.alias("__stays"))
    names = {c.lower() for c in ("n_lines", "n_dropped")}
    return kept.select(
        *[F.array_join("__stays", "\n").alias(c) if c == text_col else kept[c] for c in own if c.lower() not in names],
        F.col("__n_lines").alias("n_lines"), (F.col("__n_lines") - F.size("__stays")).alias("n_dropped"))
