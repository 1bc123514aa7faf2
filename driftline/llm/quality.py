"""Quality rules: repetition measured with a suffix array over words.

A batch of documents is one sequence of (document, word) symbols. Prefix
doubling sorts its suffixes; the ranks of every doubling step give the longest
common prefix (LCP) of neighbours, or, where these would be too many to keep
(long texts that repeat much), one scan in text order gives it. The deepest LCP interval that holds a
suffix has the larger of the suffix's two neighbouring LCPs as depth: that many
words from its position on occur again in the document. Positions that can't
be extended to the left with the same depth start the maximal repeats; their
spans, united, give the covered share of the text, the deepest interval the
longest repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS, arrow_map, chunks

SYMBOLS = "#*$%&|<>"

#: A repeat counts from this many words on; shorter ones are phrases of the language.
MIN_REPEAT = 8
#: Ranks of doubling steps that are kept at once; beyond that, the LCPs come from a scan.
LEVEL_RANKS = 12_000_000
#: Share of the words that repeats may cover.
MAX_COVERED = 0.4
#: Longest repeat, as a share of the words.
MAX_LONGEST = 0.25

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered_words long, longest_repeat long")


def repeat_depths(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every position, the words from there on that occur again in its document.

    ``words``: symbols (equal only for equal words of one document), documents
    one after the other; ``ends``: for every position the end of its document.
    """
    n = len(words)
    depth = np.zeros(n, dtype=np.int64)
    if n < 2:
        return depth
    # rank = place of the first suffix of the group that shares the prefix so far
    order = np.argsort(words, kind="stable")
    new = np.r_[True, words[order][1:] != words[order][:-1]]
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, k = [rank.astype(np.int32)], 1
    keep = n <= LEVEL_RANKS
    while True:
        count = np.bincount(rank[:n], minlength=n)
        active = np.flatnonzero(count[rank[:n]] > 1)
        if not len(active):
            break
        first = rank[active]
        second = np.where(active + k < ends[active], rank[np.minimum(active + k, n)], -1)
        key = first * (n + 1) + second + 1
        by = np.argsort(key, kind="stable")
        first, key = first[by], key[by]
        at = np.arange(len(by))
        group = np.maximum.accumulate(np.where(np.r_[True, first[1:] != first[:-1]], at, 0))
        part = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], at, 0))
        rank[active[by]] = first + part - group
        keep = keep and (len(levels) + 1) * n <= LEVEL_RANKS
        levels = [*levels, rank.astype(np.int32)] if keep else []
        k *= 2
    suffixes = np.empty(n, dtype=np.int64)
    suffixes[rank[:n]] = np.arange(n)
    a, b = suffixes[:-1], suffixes[1:]
    if not keep:
        common = scanned(words, a, b)
        depth[a] = common
        depth[b] = np.maximum(depth[b], common)
        return depth
    common = np.zeros(n - 1, dtype=np.int64)
    for step in range(len(levels) - 1, -1, -1):
        same = levels[step][np.minimum(a + common, n)] == levels[step][np.minimum(b + common, n)]
        common += np.where(same & (np.maximum(a, b) + common < n), 1 << step, 0)
    np.maximum.at(depth, a, common)
    np.maximum.at(depth, b, common)
    return depth


def scanned(words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The LCPs of neighbouring suffixes ``a`` and ``b``, in text order: from one position to the
    next, the LCP with the suffix that sorts before shrinks by one at most."""
    n = len(words)
    before = np.full(n, -1, dtype=np.int64)
    before[b] = a
    found = np.zeros(n, dtype=np.int64)
    w, previous, out = memoryview(words), memoryview(before), memoryview(found)
    h = 0
    for i in range(n):
        j = previous[i]
        if j < 0:
            h = 0
            continue
        top = n - max(i, j)
        while h < top and w[i + h] == w[j + h]:
            h += 1
        out[i] = h
        if h:
            h -= 1
    return found[b]


def covered(depth: np.ndarray, least: int, width: int | None = None) -> np.ndarray:
    """Positions in the union of the spans of repeats of ``least`` words or more
    (of ``width`` words each instead of their depth, if given)."""
    n = len(depth)
    starts = depth >= least
    if width is None:  # maximal repeats start where the one to the left isn't the same, one longer
        starts &= ~np.r_[False, depth[:-1] == depth[1:] + 1]
    at = np.flatnonzero(starts)
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + (depth[at] if width is None else width), -1)
    return np.cumsum(change[:-1]) > 0


def measure(texts: list[str | None], min_repeat: int = MIN_REPEAT) -> list[np.ndarray]:
    """The columns of ``SCHEMA`` for a list of texts."""
    texts = [t or "" for t in texts]
    parts = [t.encode().split() for t in texts]  # bytes split at white space only
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for p in parts for w in p), dtype=np.int64)
    del parts
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(texts)), sizes)
    depth = repeat_depths(doc * max(1, len(known)) + ids, ends[doc] if len(doc) else doc)

    def by_doc(marked: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=marked, minlength=len(texts)).astype(np.int64)

    longest = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(longest, doc, depth)
    chars = [len(t) - sum(map(t.count, WS)) for t in texts]
    symbols = [sum(map(t.count, SYMBOLS)) for t in texts]
    lines = []
    for t in texts:
        own = [x for x in t.split("\n") if x.strip(WS)]
        lines.append(len(own) - len(set(own)))
    return [sizes, np.array(chars, dtype=np.int64), np.array(symbols, dtype=np.int64),
            np.array(lines, dtype=np.int64), by_doc(covered(depth, 3, 3)),
            by_doc(covered(depth, min_repeat)), longest]


def quality_rules(docs: DataFrame, text_col: str = "text", min_repeat: int = MIN_REPEAT,
                  max_covered: float = MAX_COVERED, max_longest: float = MAX_LONGEST) -> DataFrame:
    """``docs`` with the columns of ``SCHEMA``, base_failed and kept.

    ``base_failed``: fewer than 50 words, or more than half of the words lie in
    3-word windows that occur twice or more. ``kept``: not base_failed, repeats
    of ``min_repeat`` words or more cover at most ``max_covered`` of the words,
    and none is longer than ``max_longest`` of them. A null or empty text has no
    words and fails. Every row is judged alone, so repeated rows get the same
    verdict; columns of ``docs`` that carry a result's name are replaced.
    """
    results = [c.split()[0] for c in SCHEMA.split(", ")]
    own = [c for c in docs.columns if c.lower() not in {*results, "base_failed", "kept"}]
    docs = docs.select(*[docs[c] for c in own])
    place = own.index(text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in chunks(batch, text_col):
                part = batch.slice(i, j - i)
                found = measure(part.column(place).to_pylist(), min_repeat)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *map(pa.array, found)], names=[*part.schema.names, *results])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = arrow_map(docs, judge, f"{fields}, {SCHEMA}")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    good = (F.col("covered_words") <= max_covered * F.col("n_words")) & \
        (F.col("longest_repeat") <= max_longest * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & good)
