"""Near-duplicate detection with an LSH forest over MinHash signatures.

1. Every document becomes the set of its 5-word shingles, and documents with
   equal sets one class with one signature of minimum hashes.
2. A tree of the forest is one order of the signature's values; each starts at
   another value and goes on around. Classes are sorted in every tree, and
   candidates are neighbours with a long common prefix. The depth adapts to the
   region: where few classes share the first values, all of them are paired;
   where many do, deeper prefixes part them, and a class is paired with its next
   neighbour and with those of its own deeper region.
3. The signatures' agreement drops candidates that are far from the limit. The
   best candidate of every class is checked on the full sets, and so is every
   other one whose classes aren't connected yet.
4. In a region with more classes than neighbours reach, classes outside the
   region's main component are open. A few of them are compared with all of that
   component, and with each other, on the full sets, block by block; where there
   are many, a join on the rarest shingles of each set finds every pair that can
   reach the similarity, and the full sets confirm it. Then the components are final.

A tree's region may hold a third of all classes: the trees are range-partitioned
over whole prefixes and the class, so a region spreads over many tasks, and a
class has a bounded number of candidates in each tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, chunks, join_by_size, materialize, shuffle_partitions
from .components import components

WORDS = 5
#: Values of a signature (16 bits each), and trees; a tree's order starts at every fourth value.
VALUES, TREES = 128, 32
#: Neighbours on each side that a class is paired with at most in one tree.
NEIGHBOURS = 8
#: Classes in one block of the comparison inside crowded regions, and open classes of one component
#: up to which it is done in blocks.
BLOCK = 512
#: Bits of a shingle's hash that choose its counter; there are so many counters whatever the input.
COUNTER_BITS = 18
#: Candidates are checked on full sets if this share of their signatures agrees. At a true similarity
#: of 0.75 fewer than 64 of 128 values agree with a chance of 3 in 10^10 by the binomial tail; the
#: trees miss such a link with a chance of 5 in 10^6.
AGREEMENT = 0.5

_RANDOM = np.random.RandomState(2024)
_FACTOR = _RANDOM.randint(1, 1 << 62, VALUES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RANDOM.randint(0, 1 << 62, VALUES, dtype=np.int64).astype(np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles; A-Z count as lower case."""
    parts = [(t or "").encode().lower().split() for t in texts]  # bytes: A-Z and white space of ASCII only
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for p in parts for w in p], dtype=np.int64)
    hashes = pd.util.hash_array(np.array([*known, b""], dtype=object), categorize=False)
    words = hashes[ids]
    n = max(0, len(words) - WORDS + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    for i in range(WORDS):
        rolled = rolled * _MIX + words[i:i + n]
    rolled = _mixed(rolled)
    out, start = [], 0
    for p in parts:
        end = start + len(p)
        if len(p) >= WORDS:
            out.append(np.unique(rolled[start:end - WORDS + 1]))
        elif p:  # the whole sequence is one shingle, other than any of five words
            digest = hashlib.blake2b(b" ".join(p), digest_size=8, person=b"short")
            out.append(np.frombuffer(digest.digest(), dtype=np.uint64))
        else:
            out.append(np.empty(0, dtype=np.uint64))
        start = end
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of VALUES 16-bit minimum hashes for every set that isn't empty."""
    full = [s for s in sets if len(s)]
    out = np.empty((len(full), VALUES), dtype=np.uint16)
    if full:
        starts = np.cumsum([0, *(len(s) for s in full[:-1])])
        x = np.concatenate(full)
        for i in range(VALUES):
            least = np.minimum.reduceat(x * _FACTOR[i] + _SHIFT[i], starts)
            out[:, i] = _mixed(least) >> np.uint64(48)
    return out


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j in chunks(batch, "__text"):
            part = batch.slice(i, j - i)
            sets = shingle_sets(part.column(1).to_pylist())
            rows = iter(signatures(sets))
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                         pa.binary()),
                pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary())],
                names=["__id", "__hash", "n_shingles", "__set", "__signature"])


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every tree: the first twelve values of its order, four in a long."""
    step = VALUES // TREES
    for batch in batches:
        n = batch.num_rows
        found = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16).reshape(n, VALUES)
        groups = found.reshape(n, TREES, step).copy().view(np.int64)[:, :, 0]  # four values in one
        nodes = batch.column(0).to_numpy()
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(TREES, dtype=np.int32), n)), pa.array(groups.T.ravel()),
            pa.array(np.roll(groups, -1, axis=1).T.ravel()), pa.array(np.roll(groups, -2, axis=1).T.ravel()),
            pa.array(np.tile(nodes, TREES))], names=["tree", "p1", "p2", "p3", "node"])


def _runs(same: np.ndarray) -> np.ndarray:
    """For every row, the rows of its run; ``same``: whether a row belongs to the run of the one before."""
    number = np.cumsum(~same)
    return np.bincount(number)[number]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in the order of (tree, p1, p2, p3, node): candidate pairs (a, b), and (a, tree, p1)
    for each row of a crowded region. What partitions cut apart, other trees have together."""
    carried: list[np.ndarray] | None = None
    for table in _gathered(batches, 200_000):
        columns = [table.column(i).to_numpy() for i in range(5)]
        old = 0
        if carried is not None:
            old = len(carried[0])
            columns = [np.concatenate(x) for x in zip(carried, columns)]
        tree, p1, p2, _, node = columns
        four = np.r_[False, (tree[1:] == tree[:-1]) & (p1[1:] == p1[:-1])]
        eight = four & np.r_[False, p2[1:] == p2[:-1]]
        small = NEIGHBOURS + 1
        r4, r8 = _runs(four), _runs(eight)
        pairs = []
        in4, in8 = four.copy(), eight.copy()
        for lag in range(1, NEIGHBOURS + 1):
            if lag > 1:  # all rows in between share the prefix
                shift = lag - 1
                in4[shift:] &= four[:-shift]
                in8[shift:] &= eight[:-shift]
                in4[:shift] = in8[:shift] = False
            take = in4 & (r4 <= small) | in8 & (r8 <= small) | (in4 if lag == 1 else False)
            at = np.flatnonzero(take)
            at = at[at >= old]
            if len(at):
                pairs.append(np.stack([node[at], node[at - lag]]))
        names = ["a", "b", "tree", "p1"]
        if pairs:
            both = np.concatenate(pairs, axis=1)
            both = np.unique(np.sort(both, axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([
                pa.array(both[0]), pa.array(both[1]), pa.nulls(both.shape[1], pa.int32()),
                pa.nulls(both.shape[1], pa.int64())], names=names)
        crowd = np.flatnonzero(r4 > small)
        crowd = crowd[crowd >= old]
        if len(crowd):
            yield pa.RecordBatch.from_arrays([
                pa.array(node[crowd]), pa.nulls(len(crowd), pa.int64()), pa.array(tree[crowd]), pa.array(p1[crowd])],
                names=names)
        carried = [c[-NEIGHBOURS:] for c in columns]


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8) for i in (2, 3))
        share = (x == y).reshape(batch.num_rows, VALUES).mean(axis=1)
        good = pa.array(share >= AGREEMENT)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(good), batch.column(1).filter(good), pa.array(share).filter(good)],
            names=["a", "b", "share"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The full set of a class from a text that has it (a row of the same id may have another)."""
    for batch in batches:
        for i, j in chunks(batch, "__text"):
            part = batch.slice(i, j - i)
            found = [s.tobytes() for s in shingle_sets(part.column(2).to_pylist())]
            right = pa.array([hashlib.blake2b(s, digest_size=16).digest() == own
                              for s, own in zip(found, part.column(1).to_pylist())])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).filter(right), pa.array(found, pa.binary()).filter(right)], names=["node", "members"])


def _linked(similarity: float):
    percent = round(similarity * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            good = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])

    return run


def _compared(similarity: float):
    percent = round(similarity * 100)

    def run(open_: pa.Table, members: pa.Table) -> pa.Table:
        """Links of each open class to the block's classes of other components, one for each component."""
        out: list[tuple[int, int]] = []
        if open_.num_rows and members.num_rows:
            sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in members["members"].combine_chunks()]
            sizes = np.array([len(x) for x in sets])
            known, place = np.unique(np.concatenate(sets), return_inverse=True)
            starts = np.cumsum(sizes) - sizes
            nodes, of = members["node"].to_numpy(), members["component"].to_numpy()
            mask = np.zeros(len(known), dtype=np.int64)
            for node, component, x in zip(open_["node"].to_pylist(), open_["component"].to_pylist(),
                                          open_["members"].combine_chunks()):
                x = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                at = np.minimum(np.searchsorted(known, x), len(known) - 1)
                at = at[known[at] == x]
                mask[at] = 1
                both = np.add.reduceat(mask[place], starts)
                mask[at] = 0
                good = np.flatnonzero((100 * both >= percent * (len(x) + sizes - both)) & (of != component))
                _, first = np.unique(of[good], return_index=True)
                out += [(node, int(nodes[i])) for i in good[first]]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles of the sets fall to each counter."""
    total = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    for batch in batches:
        flat = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.uint64)
        total += np.bincount((flat >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["counter", "n"])


def _prefixes(similarity: float, counters):
    percent = round(similarity * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rarest shingles of each set; ``indexed``: also a shingle of the shorter prefix."""
        total = counters.value
        for batch in batches:
            for i, j in chunks(batch, "members"):
                part = batch.slice(i, j - i)
                shingles, sizes, places, indexed = [], [], [], []
                for value in part.column(3):
                    x = np.frombuffer(value.as_buffer(), dtype=np.uint64)
                    n = len(x)
                    probe = n + 1 + (-percent * n) // 100
                    index = n + 1 + (-2 * percent * n) // (100 + percent)
                    shingles.append(x[np.lexsort((x, total[x >> np.uint64(64 - COUNTER_BITS)]))[:probe]])
                    sizes.append(n)
                    places.append(np.arange(probe))
                    indexed.append(np.arange(probe) < index)
                row = np.repeat(np.arange(len(places)), [len(p) for p in places])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(shingles).view(np.int64)), *[part.column(c).take(pa.array(row)) for c in range(3)],
                    pa.array(np.array(sizes, dtype=np.int64)[row]), pa.array(np.concatenate(places)),
                    pa.array(np.concatenate(indexed))],
                    names=["shingle", "node", "component", "open", "size", "place", "indexed"])

    return run


def prefix_links(members: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between ``members`` (node, component, open, members) of different components, one of them open.

    Every set is ordered from rare to frequent shingles. Of two linked sets the
    smaller has one of their common shingles among its first n - 2tn/(1+t) + 1,
    and the larger has it among its first n - tn + 1; what can follow the first
    one that they share must suffice for the similarity t. Shingles of a
    template, which all sets have, come last and are hardly ever joined. Rarity
    is estimated by a fixed number of counters: any order that is the same for
    all sets is right, and the frequent ones stand out.
    """
    spark = members.sparkSession
    percent = round(similarity * 100)
    counts = arrow_map(members.select("members"), _counted, "counter long, n long") \
        .groupBy("counter").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    total[counts["counter"].to_numpy(dtype=np.int64)] = counts["n"].to_numpy(dtype=np.int64)
    rows = materialize(arrow_map(
        members.select("node", "component", "open", "members"), _prefixes(similarity, spark.sparkContext.broadcast(total)),
        "shingle long, node long, component long, open boolean, size long, place long, indexed boolean"), "prefixes")

    # Shingles with more rows than this number 4 * partitions at most; each is split by its own number of salts.
    limit = max(BLOCK, rows.count() // (4 * shuffle_partitions(spark)))
    often = F.broadcast(materialize(
        rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
        .select("shingle", F.ceil(F.col("n") / limit).alias("salts")), "frequent-shingles"))
    salted = rows.join(often, "shingle", "left").withColumn("salts", F.coalesce("salts", F.lit(1).cast("bigint")))
    own = salted.where("indexed").select("shingle", F.pmod(F.xxhash64("node"), F.col("salts")).alias("salt"),
                                         *[F.col(c).alias(f"a_{c}") for c in ("node", "component", "open", "size", "place")])
    others = salted.select("shingle", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"),
                           *[F.col(c).alias(f"b_{c}") for c in ("node", "component", "open", "size", "place")])
    common = F.least(F.col("a_size") - F.col("a_place"), F.col("b_size") - F.col("b_place"))
    pairs = own.join(others, ["shingle", "salt"]).where(
        (F.col("a_component") != F.col("b_component")) & (F.col("a_open") | F.col("b_open"))
        & (F.col("a_size") <= F.col("b_size")) & (100 * F.col("a_size") >= percent * F.col("b_size"))
        & ((100 + percent) * common >= percent * (F.col("a_size") + F.col("b_size"))))
    pairs = pairs.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()
    full = pairs.join(members.select(F.col("node").alias("a"), F.col("members").alias("x")), "a") \
        .join(members.select(F.col("node").alias("b"), F.col("members").alias("y")), "b")
    return arrow_map(full.select("a", "b", "x", "y"), _linked(similarity), "a long, b long")


def crowded_links(crowd: DataFrame, near: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) inside crowded regions that neighbours alone may miss.

    ``crowd``: (tree, p1, node) of such regions; ``near``: (node, component);
    ``sets``: (node, members). Classes that aren't in their region's main
    component are open; they are compared with that component's classes and with
    the other open classes of it: in blocks of ``BLOCK``, which is linear in the
    component, up to ``BLOCK`` open classes, else by ``prefix_links``.
    """
    labelled = materialize(
        crowd.join(near, "node", "left").withColumn("component", F.coalesce("component", "node")), "crowd")
    counts = labelled.groupBy("tree", "p1", "component").agg(F.count(F.lit(1)).alias("n"))
    mains = counts.groupBy("tree", "p1").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("rows")) \
        .select("tree", "p1", F.col("main.component").alias("main"), "rows")
    open_ = materialize(join_by_size(labelled, mains, ["tree", "p1"], "rows", labelled.count())
                        .where("component <> main").select("node", "component", "main").distinct(), "open")
    owners = open_.groupBy("main").agg(F.count(F.lit(1)).alias("n_open"))
    every = near.select("node", "component").withColumn("main", F.col("component")).unionAll(
        open_.select("node", "component", "main"))
    # a main component of one class has no row in near
    alone = owners.join(near.select(F.col("component").alias("main")).distinct(), "main", "left_anti")
    every = every.unionAll(alone.select(F.col("main").alias("node"), F.col("main").alias("component"), "main"))
    every = materialize(every, "crowd-members")
    # counted before the join, as one component may hold most of the rows
    sizes = every.groupBy("main").agg(F.count(F.lit(1)).alias("n")).join(owners, "main", "left")
    blocks = materialize(sizes.select("main", "n", F.coalesce("n_open", F.lit(0)).alias("n_open"),
                                      F.ceil(F.col("n") / BLOCK).alias("m_blocks"),
                                      F.ceil(F.col("n_open") / BLOCK).alias("o_blocks")), "crowd-blocks")

    few, many = blocks.where(f"n_open BETWEEN 1 AND {BLOCK}"), blocks.where(f"n_open > {BLOCK}")

    def dealt(rows: DataFrame, count: str, own: str, other: str) -> DataFrame:
        """Each row to its own block, against all blocks of the other side."""
        placed = join_by_size(rows, few, ["main"], count, rows.count())
        # new names, as both sides come from the same tables
        return placed.join(sets, "node").select(
            *[F.col(c).alias(c) for c in ("main", "node", "component", "members")],
            F.pmod(F.xxhash64("node"), F.col(f"{own}_blocks")).alias(f"{own}_block"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block"))

    grid = ["main", "m_block", "o_block"]
    left = dealt(open_, "n_open", "o", "m").groupBy(*grid)
    right = dealt(every, "n", "m", "o").groupBy(*grid)
    links = left.cogroup(right).applyInArrow(_compared(similarity), "a long, b long")
    if many.isEmpty():
        return links
    # a class may be open in one region and belong to the main component of another
    members = join_by_size(every, many, ["main"], "n", every.count()).groupBy("node").agg(
        F.first("component").alias("component"), F.max(F.col("component") != F.col("main")).alias("open"))
    return links.unionAll(prefix_links(materialize(members.join(sets, "node"), "crowd-sets"), similarity))


def component_of(edges: DataFrame, near: DataFrame, end: str) -> DataFrame:
    """``edges`` with the component of one end, the end itself where it has no row in ``near``."""
    own = near.select(F.col("node").alias(end), F.col("component").alias(f"{end}_in"))
    return edges.join(own, end, "left").withColumn(f"{end}_in", F.coalesce(f"{end}_in", end))


def near_duplicates(docs: DataFrame, similarity: float = 0.75, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id, kept.

    Documents are linked if their shingle sets have a Jaccard similarity of
    ``similarity`` (in whole percent) or more; component_id is the smallest id
    that links lead to. Null and empty texts have no shingles and are linked with
    nothing. Rows that repeat a text are one class; rows that repeat an id are
    judged by their own texts. Null ids are larger than all others, so a null
    component_id means that the whole component has none; such rows are kept.
    An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    # ids may be null or repeat, so a row is known by its id and its text's hash
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")) \
        .withColumn("__hash", F.xxhash64("__text"))
    rows = materialize(arrow_map(
        texts, _described, f"__id {kind}, __hash long, n_shingles long, __set binary, __signature binary"), "shingles")
    classes = materialize(
        rows.where("__set IS NOT NULL").groupBy("__set").agg(
            F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__rows"),
            F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"),
                           F.col("__hash").alias("hash"))).alias("__at"),
            F.first("__signature").alias("__signature"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")

    order = ["tree", "p1", "p2", "p3", "node"]
    forest = arrow_map(classes.select("node", "__signature"), _ordered,
                       "tree int, p1 long, p2 long, p3 long, node long") \
        .repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    found = materialize(arrow_map(forest, _neighbours, "a long, b long, tree int, p1 long"), "forest")
    pairs = found.where("b IS NOT NULL").select("a", "b").distinct()
    crowd = found.where("b IS NULL").select("tree", "p1", F.col("a").alias("node"))

    # The low byte of each value is enough to compare signatures.
    short = classes.select("node", F.unhex(F.regexp_replace(F.hex("__signature"), "(..)..", "$1")).alias("s"))
    candidates = materialize(arrow_map(
        pairs.join(short.select(F.col("node").alias("a"), F.col("s").alias("x")), "a")
        .join(short.select(F.col("node").alias("b"), F.col("s").alias("y")), "b").select("a", "b", "x", "y"),
        _agreement, "a long, b long, share double"), "candidates")

    ends = candidates.select(F.col("a").alias("node")).unionAll(candidates.select(F.col("b").alias("node"))) \
        .unionAll(crowd.select("node")).distinct()
    wanted = classes.join(ends, "node").select("node", "__set", F.col("__at.id").alias("__own"), F.col("__at.hash").alias("__of"))
    found_texts = wanted.join(texts, F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__hash")))
    # equal rows with one id are one: their sets are the same
    sets = materialize(arrow_map(
        found_texts.groupBy("node", "__set").agg(F.first("__text").alias("__text")).select("node", "__set", "__text"),
        _sets, "node long, members binary"), "sets")

    def confirmed(some: DataFrame) -> DataFrame:
        full = some.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("members").alias("x")), "a") \
            .join(sets.select(F.col("node").alias("b"), F.col("members").alias("y")), "b")
        return materialize(arrow_map(full.select("a", "b", "x", "y"), _linked(similarity), "a long, b long"), "links")

    # The best candidate of every class, then all others that aren't connected yet.
    both = candidates.select("a", "b", "share").unionAll(
        candidates.select(F.col("b").alias("a"), F.col("a").alias("b"), "share"))
    best = both.groupBy("a").agg(F.max(F.struct("share", "b")).alias("best")) \
        .select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct()
    near = materialize(components(confirmed(best)), "near")

    def merged(links: DataFrame, before: DataFrame) -> DataFrame:
        """Components after ``links`` join some of the components ``before``."""
        ends = component_of(component_of(links, before, "a"), before, "b")
        joined = components(ends.select(F.col("a_in").alias("a"), F.col("b_in").alias("b")))
        joined = joined.select(F.col("node").alias("component"), F.col("component").alias("joined"))
        after = before.groupBy("component").agg(F.count(F.lit(1)).alias("rows")).join(joined, "component", "left")
        # classes that were alone have no row before
        return materialize(
            join_by_size(before, after, ["component"], "rows", before.count())
            .select("node", F.coalesce("joined", "component").alias("component"))
            .unionAll(joined.join(before, joined["component"] == before["node"], "left_anti")
                      .select(F.col("component").alias("node"), F.col("joined").alias("component"))), "components")

    apart = component_of(component_of(candidates.select("a", "b"), near, "a"), near, "b").where("a_in <> b_in")
    near = merged(confirmed(apart), near)
    near = merged(materialize(crowded_links(crowd, near, sets, similarity), "crowded-links"), near)
    labelled = classes.select("node", "__set", "__first", "__rows").join(near, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("__first").alias("component_id"), F.count(F.lit(1)).alias("nodes"))
    of_set = materialize(join_by_size(labelled, least, ["component"], "nodes", classes.count())
                         .select("__set", "component_id", "__rows"), "set-components")
    result = join_by_size(rows.select("__id", "n_shingles", "__set"), of_set, ["__set"], "__rows", rows.count())
    result = result.select("__id", "n_shingles", "component_id").unionAll(
        rows.where("__set IS NULL").select("__id", "n_shingles", F.col("__id").alias("component_id")))
    return result.select(F.col("__id").alias(id_col), "n_shingles", "component_id",
                        F.col("__id").eqNullSafe(F.col("component_id")).alias("kept"))
