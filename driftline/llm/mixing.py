"""Mixing sources to target weights.

Every document has a hash-random key. Inside each source, documents are sorted
by ranges of the key; sums per range give every range its offset, so the prefix
sums of word counts are distributed however large one source is. A source's
documents are taken whole as many times as its target holds all of it; the
rest of the target is cut at exactly that many words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions, text_or_empty

#: Weights of the sources in code point order (null last), repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix as a share of all words, and times a source may be repeated.
TOTAL, MOST = 1.5, 2
#: Most documents that one range of keys holds on average.
RANGE_ROWS = 20_000


def n_words(col: str) -> Column:
    """Words: runs of anything but white space."""
    return F.regexp_count(text_or_empty(col), F.lit("[^ \\t-\\r]+")).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """``__source, source_size`` (one row per source) with ``target``.

    The sources share ``TOTAL`` of all words by weight, and none gets over
    ``MOST`` times its own; what is over goes to the others by weight, until
    none is above. In the order of size to weight, all sources up to some place
    stop at their own limit and the others share what is left, so the place
    follows from prefix sums. The table has one row per source, in one task.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("__source"))
    everything = Window.partitionBy(F.lit(0))
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    ranked = sizes.select(
        "*", F.element_at(weights, (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).alias("__w"),
        (F.lit(float(MOST)) * F.col("source_size")).alias("__cap"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("__cap") / F.col("__w"), F.asc_nulls_last("__source"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(0, Window.unboundedFollowing)
    shared = ranked.select(
        "*",
        ((F.lit(TOTAL) * F.sum("source_size").over(everything) -
          F.coalesce(F.sum("__cap").over(earlier), F.lit(0.0))) / F.sum("__w").over(later)).alias("__unit"))
    # the first source that isn't above its limit at the unit share of those from it on
    below = F.min(F.when(F.col("__cap") >= F.col("__unit") * F.col("__w"),
                         F.struct((F.col("__cap") / F.col("__w")).alias("ratio"), F.col("__unit").alias("unit"))))
    fair = shared.select("*", below.over(everything).alias("__fair"))
    return fair.select("__source", "source_size",
                       F.least("__cap", F.coalesce(F.col("__fair.unit") * F.col("__w"), "__cap")).alias("target"))


def mix(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, size, source_size, target, taken (words), and the columns ``carry``
    (but for those named like one of the former).

    Null texts have no words; null sources form one source, the last. Rows that
    repeat an id share its key and are ordered by size. A source without words
    has target 0. An empty table gives an empty result; other columns are
    ignored. The key depends on the id and ``seed`` alone, so reruns agree.
    """
    carry = tuple(c for c in carry if c.lower() not in {id_col.lower(), "size", "source_size", "target", "taken"})
    rows = materialize(docs.select(
        F.col(id_col).alias("__id"), F.col(source_col).cast("string").alias("__source"),
        n_words(text_col).alias("size"), F.struct(*carry).alias("__carried") if carry else F.lit(0).alias("__carried"),
        F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("__key")),
        "mix-sizes")
    ranges = max(2 * shuffle_partitions(docs.sparkSession), rows.count() // RANGE_ROWS)
    place = F.conv(F.substring("__key", 1, 8), 16, 10).cast("bigint")
    # null sources get a name that no other source can have
    rows = rows.withColumn("__name", F.coalesce(F.concat(F.lit("s"), F.col("__source")), F.lit(""))) \
        .withColumn("__range", F.floor(place * ranges / F.lit(float(1 << 32))).cast("bigint"))

    sums = rows.groupBy("__name", "__range").agg(F.first("__source").alias("__source"), F.sum("size").alias("__sum"))
    goals = targets(sums.groupBy("__name").agg(F.first("__source").alias("__source"),
                                               F.sum("__sum").alias("source_size"))) \
        .withColumn("__name", F.coalesce(F.concat(F.lit("s"), F.col("__source")), F.lit(""))).drop("__source")
    budget = F.floor(F.col("target") + 0.5).cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.expr("__budget div source_size")).otherwise(F.lit(0)).cast("bigint")
    before = Window.partitionBy("__name").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__name", "__range", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset")) \
        .join(goals, "__name").withColumn("__budget", budget).withColumn("__epochs", epochs) \
        .withColumn("__rest", F.col("__budget") - F.col("__epochs") * F.col("source_size"))

    inside = Window.partitionBy("__name", "__range").orderBy("__key", "__id", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    part = F.least(F.col("size"), F.greatest(F.lit(0).cast("bigint"), F.col("__rest") - start))
    return rows.join(offsets, ["__name", "__range"]).select(
        F.col("__id").alias(id_col), "size", "source_size", "target",
        (F.col("__epochs") * F.col("size") + part).cast("bigint").alias("taken"),
        *[F.col(f"__carried.`{c}`").alias(c) for c in carry])


def repeated(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """The mix itself: each row of ``mixed`` as often as it is taken whole, and its first words for the rest.

    ``mixed``: the result of ``mix`` with ``text_col`` carried. Rows that aren't taken, and those without
    words, go.
    """
    rest = (F.col("taken") % F.col("size")).cast("int")
    # possessive, so that many words need no stack
    first_words = F.regexp_substr(F.col(text_col), F.concat(
        F.lit("^(?:[ \\t-\\r]*+[^ \\t-\\r]++){"), rest.cast("string"), F.lit("}+")))
    copies = F.concat(F.array_repeat(F.col(text_col), F.expr("cast(taken div size as int)")),
                      F.when(rest > 0, F.array(first_words)).otherwise(F.expr("cast(array() as array<string>)")))
    others = [c for c in mixed.columns if c != text_col]
    return mixed.where("taken > 0").select(*others, F.explode(copies).alias(text_col))
