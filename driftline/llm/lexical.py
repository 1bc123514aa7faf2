"""Ranked lexical search as a search for the largest inner products.

A document is the vector of its impacts (saturated, length-corrected term
frequencies) over the terms that queries use, a query that of its terms' weights.
Vectors are ordered by length, falling, and go through in norm buckets: ranges
of the order, one range, then ``GROWTH`` times as many, and so on. What a bucket
finds gives every query its threshold for the next, the score it must reach.
Inside a task vectors come in small buckets of like lengths:

1. By Cauchy-Schwarz a bucket whose longest vector can't reach a query's
   threshold is skipped for that query.
2. A query's heaviest coordinates are its focus: as many as leave so little
   weight to the others that no vector without any focus coordinate can reach
   the threshold. Only vectors found under those coordinates are looked at, and
   each is dropped if its focus part, and Cauchy-Schwarz over the rest of both
   vectors, stay below the threshold.
3. The survivors' scores are added up exactly in 64-bit integers.

The bounds are widened by a hair, so rounding drops nothing. Queries go in blocks
of bounded size against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, materialize, shuffle_partitions, text_or_empty
from .terms import terms

#: Query terms in one block, unless a single query has more.
BLOCK_TERMS = 50_000
#: How many times the ranges of the bucket before a norm bucket has, and vectors of a bucket inside a task.
GROWTH, TASK_BUCKET = 16, 4096
#: By how much the bounds are widened against rounding.
HAIR = 1e-9


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, __item_id, term, n``: the distinct terms of every item, and how often each occurs."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("__item_id"),
                        text_or_empty(text_col).alias("__text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(2).to_pylist()):
                found, n = np.unique(np.array(terms(text), dtype=object), return_counts=True)
                if len(found):
                    same = pa.array(np.full(len(found), i))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(same), batch.column(1).take(same),
                         pa.array([x.decode() for x in found], pa.string()), pa.array(n, pa.int64())],
                        names=["item", "__item_id", "term", "n"])

    kind = items.schema[id_col].dataType.simpleString()
    return materialize(arrow_map(rows, split, f"item long, __item_id {kind}, term string, n long"), "queries")


def query_blocks(queries: DataFrame, most: int) -> list[DataFrame]:
    """``queries`` in blocks of at most ``most`` rows, or of one item."""
    sizes = queries.groupBy("item").agg(F.count(F.lit(1)).alias("rows"))
    total, n_items = sizes.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count(F.lit(1))).first()
    n = max(1, -(-total // most))
    while n > 1:
        block = F.pmod(F.xxhash64("item"), F.lit(n))
        full = sizes.groupBy(block.alias("block")).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("items"))
        if n >= 64 * n_items or not full.where((F.col("rows") > most) & (F.col("items") > 1)).head(1):
            return [queries.where(block == k) for k in range(n)]
        n *= 2
    return [queries] if total else []


class Queries:
    """A block of queries, as tasks need it: weights by falling size, and what is left of their length behind each."""

    def __init__(self, rows: list, weights: np.ndarray, place: dict[str, int]):
        by_item: dict[int, list[tuple[int, int]]] = {}
        for r in rows:
            if w := int(weights[place[r.term]]):
                by_item.setdefault(r.item, []).append((w * r.n, place[r.term]))
        self.items = sorted(by_item)
        self.weight, self.term, self.rest = [], [], []
        for item in self.items:
            own = sorted(by_item[item], reverse=True)
            w = np.array([x for x, _ in own], dtype=np.int64)
            self.weight.append(w)
            self.term.append(np.array([t for _, t in own], dtype=np.int64))
            # rest[i]: length of the coordinates from i on
            self.rest.append(np.sqrt(np.r_[np.cumsum((w.astype(np.float64) ** 2)[::-1])[::-1], 0.0]))
        self.length = np.array([r[0] for r in self.rest])


def document_terms(docs: DataFrame, place: dict[str, int], id_col: str, text_col: str) -> DataFrame:
    """``__id, __row, n, terms, tfs`` of every document with a term; terms are numbers of ``place``."""
    known = docs.sparkSession.sparkContext.broadcast({t.encode(): i for t, i in place.items()})
    rows = docs.select(F.col(id_col).cast("bigint").alias("__id"), text_or_empty(text_col).alias("__text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for batch in batches:
            at, n, own, tfs = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if words := terms(text):
                    at.append(i)
                    n.append(len(words))
                    found, tf = np.unique(np.array([t for t in map(number, words) if t is not None], dtype=np.int32),
                                          return_counts=True)
                    own.append(found)
                    tfs.append(tf.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(n, pa.int64()), *_lists(own, tfs)],
                names=["__id", "n", "terms", "tfs"])

    found = arrow_map(rows, count, "__id long, n long, terms array<int>, tfs array<int>")
    return materialize(found.withColumn("__row", F.monotonically_increasing_id()), "document-terms")


def _lists(*columns: list[np.ndarray]) -> list[pa.ListArray]:
    out = []
    for arrays in columns:
        ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
        values = np.concatenate([*arrays, np.empty(0, np.int32)])
        out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))
    return out


def document_frequencies(found: DataFrame, size: int) -> np.ndarray:
    """In how many documents each of the block's ``size`` terms occurs. Every task adds up in place."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    out = np.zeros(size, dtype=np.int64)
    rows = arrow_map(found.select("terms"), count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in rows.collect():  # the terms of a block at most
        out[r.term] = r.df
    return out


def impact_vectors(found: DataFrame, weights: np.ndarray, documents: int, all_terms: int) -> DataFrame:
    """``__id, range, length, terms, impacts``: vectors in ranges of falling length; range 0 has the longest."""
    spark = found.sparkSession
    useful = spark.sparkContext.broadcast(weights > 0)

    def impacts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(3)).to_numpy())
            own, tf = batch.column(3).flatten().to_numpy(), batch.column(4).flatten().to_numpy().astype(np.int64)
            keep = useful.value[own]
            doc, own, tf = doc[keep], own[keep], tf[keep]
            m = 75 + (25 * batch.column(2).to_numpy() * documents) // all_terms
            impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
            length = np.sqrt(np.bincount(doc, weights=impact.astype(np.float64) ** 2, minlength=batch.num_rows))
            sizes = np.bincount(doc, minlength=batch.num_rows)
            some = np.flatnonzero(sizes)
            ends = pa.array(np.r_[0, np.cumsum(sizes[some])].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(some)), batch.column(1).take(pa.array(some)), pa.array(length[some]),
                 pa.ListArray.from_arrays(ends, pa.array(own.astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(impact.astype(np.int32)))],
                names=["__id", "__row", "length", "terms", "impacts"])

    vectors = arrow_map(found.select("__id", "__row", "n", "terms", "tfs"), impacts,
                        "__id long, __row long, length double, terms array<int>, impacts array<int>")
    # the row parts vectors of one length
    order = [F.desc("length"), F.asc("__row")]
    return materialize(vectors.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
                       .drop("__row").withColumn("range", F.spark_partition_id()), "impact-vectors")


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


class Bucket:
    """Vectors of like lengths, with the vectors that have a term by term."""

    def __init__(self, table: pa.Table):
        self.ids = table.column(0).fill_null(0).to_numpy()
        self.none = table.column(0).is_null().to_numpy()
        self.length = table.column(1).to_numpy()
        lists = table.column(2).combine_chunks()
        rows = np.repeat(np.arange(len(self.ids)), pc.list_value_length(lists).to_numpy())
        own = lists.flatten().to_numpy()
        by = np.argsort(own, kind="stable")
        self.rows = rows[by]
        self.impacts = table.column(3).combine_chunks().flatten().to_numpy().astype(np.int64)[by]
        self.terms, starts = np.unique(own[by], return_index=True)
        self.starts = np.r_[starts, len(own)]

    def under(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vectors that have any of ``terms``: row, impact and weight for each such coordinate."""
        at = np.searchsorted(self.terms, terms)
        has = at < len(self.terms)
        has[has] = self.terms[at[has]] == terms[has]
        at, weights = at[has], weights[has]
        sizes = self.starts[at + 1] - self.starts[at]
        # places of all coordinates: each term's run from its start on
        total = int(sizes.sum())
        place = np.repeat(self.starts[at] - np.r_[0, np.cumsum(sizes)[:-1]][:len(sizes)], sizes) + np.arange(total)
        return self.rows[place], self.impacts[place], np.repeat(weights, sizes)

    def reaching(self, queries: Queries, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows whose score for query ``q`` is ``least`` or more, and the scores."""
        terms, weights, rest = queries.term[q], queries.weight[q], queries.rest[q]
        n = len(self.ids)
        # the first place from which on the rest alone can't reach the threshold
        focus = int(np.argmax(rest * self.length.max() * (1 + HAIR) < least)) if least > 0 else len(terms)
        rows, impacts, w = self.under(terms[:focus], weights[:focus])
        part = np.bincount(rows, weights=impacts * w.astype(np.float64), minlength=n)
        square = np.bincount(rows, weights=impacts.astype(np.float64) ** 2, minlength=n)
        bound = part + rest[focus] * np.sqrt(np.maximum(0.0, self.length ** 2 * (1 + HAIR) - square))
        good = np.flatnonzero((part > 0) & (bound * (1 + HAIR) >= least))
        if not len(good):
            return good, good
        place = np.full(n, -1)
        place[good] = np.arange(len(good))
        rows, impacts, w = self.under(terms, weights)
        of = place[rows]
        score = np.zeros(len(good), dtype=np.int64)
        np.add.at(score, of[of >= 0], (impacts * w)[of >= 0])
        reach = score >= max(least, 1)
        return good[reach], score[reach]


def searched(queries: Queries, least: np.ndarray, k: int):
    """A task's best ``k`` documents of each query, among those that reach its threshold ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        threshold = least.copy()
        empty = np.empty(0, dtype=np.int64)
        best = {}  # by query: scores, ids, whether the id is null
        for table in _gathered(batches, TASK_BUCKET):
            bucket = Bucket(table)
            for q in np.flatnonzero(queries.length * bucket.length.max() * (1 + HAIR) >= threshold):
                rows, score = bucket.reaching(queries, q, int(threshold[q]))
                if not len(rows):
                    continue
                old = best.get(q, (empty, empty, empty.astype(bool)))
                score, ids, none = (np.concatenate(x) for x in zip(old, (score, bucket.ids[rows], bucket.none[rows])))
                first = np.lexsort((ids, none, -score))[:k]
                best[q] = score[first], ids[first], none[first]
                if len(first) == k:
                    threshold[q] = max(threshold[q], score[first[-1]])
        for q, (score, ids, none) in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(score), queries.items[q])), pa.array(ids, mask=none), pa.array(score)],
                names=["item", "__id", "score"])

    return run


def norm_buckets(vectors: DataFrame) -> list[tuple[int, int]]:
    """First and last range of every bucket."""
    last = vectors.agg(F.max("range")).first()[0]
    out, start, size = [], 0, 1
    while last is not None and start <= last:
        out.append((start, min(last, start + size - 1)))
        start, size = start + size, size * GROWTH
    return out


def best_of_block(docs: DataFrame, block: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame | None:
    """``item, __id, score``: for each query of a block its best documents, and some others."""
    spark: SparkSession = docs.sparkSession
    rows = block.collect()  # at most BLOCK_TERMS, or one item
    place = {t: i for i, t in enumerate(sorted({r.term for r in rows}))}
    found = document_terms(docs, place, id_col, text_col)
    documents, all_terms = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents or not place:
        return None
    df = document_frequencies(found, len(place))
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) if x else 0 for x in df])
    queries = Queries(rows, weights, place)
    if not queries.items:
        return None
    vectors = impact_vectors(found, weights, documents, all_terms)
    shared = spark.sparkContext.broadcast(queries)
    number = {item: q for q, item in enumerate(queries.items)}
    least, out = np.zeros(len(number), dtype=np.int64), None
    best = Window.partitionBy("item").orderBy(F.desc("score"))
    for first, last in norm_buckets(vectors):
        def run(batches, least=least):
            return searched(shared.value, least, k)(batches)

        new = materialize(arrow_map(vectors.where(F.col("range").between(first, last))
                                    .select("__id", "length", "terms", "impacts"), run,
                                    "item long, __id long, score long"), "found")
        out = new if out is None else out.unionAll(new)
        least = least.copy()
        for r in out.withColumn("__rn", F.row_number().over(best)).where(F.col("__rn") == k).collect():
            least[number[r.item]] = r.score  # one number for each query of the block
    return out


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", item_col: str = "item_id",
           text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` highest-scoring documents of every item, or all with a score above 0 if they are fewer: ``item_col``,
    rank (from 1), ``id_col``, score. Equal scores are ranked by rising id, null ids last.

    Null and empty texts have no terms, and such documents don't count as documents. Document ids are integers; rows
    that repeat one are documents of their own. Every row of ``items`` gets its own list, also if its id repeats or
    is null; items without terms that documents have get none. Empty tables give an empty result; other columns are
    ignored.
    """
    queries = query_terms(items, item_col, text_col)
    blocks = query_blocks(queries, block_terms)
    found = [x for x in (best_of_block(docs, b, k, id_col, text_col) for b in blocks) if x is not None]
    kind = docs.schema[id_col].dataType.simpleString()
    names = queries.groupBy("item").agg(F.first("__item_id").alias("__item_id"))
    every = found[0] if found else docs.sparkSession.createDataFrame([], "item long, __id long, score long")
    for more in found[1:]:
        every = every.unionAll(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("__id"))
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(names, "item").select(
        F.col("__item_id").alias(item_col), "rank", F.col("__id").cast(kind).alias(id_col), "score")
