"""Hierarchical multi-length packing into training sequences.

Documents (their ids and the end id) are cut into whole windows of the longest
context; what remains of each goes to the tier of the shortest window that
holds it. Every tier is packed by best fit of falling lengths, the gaps of
long windows are filled with documents of the shorter tiers, and the last gap
with a cut. Sequences then have no padding: a window that can't be filled any
more ends as sequences of powers of two. Sequences of all lengths are dealt to
step groups so that their token sums are alike.

Each task packs its own rows in blocks, so nothing is shuffled and memory is
bounded by the block; a block's unfilled rest is all that one more task costs.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import arrow_map, text_or_empty

LONGEST = 1024
#: Window lengths of the tiers, powers of two.
TIERS = (1024, 512, 256, 128)
END_OF_DOCUMENT = 0
#: Ids of the rests that are packed together, and ids of one step group.
BLOCK, STEP = 2_000_000, 64 * 1024

SCHEMA = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "tier long, step_id long")


class Rests:
    """Pieces that still have no place, by length."""

    def __init__(self, pieces: list[tuple[int, int, int]]):
        self.sorted = sorted((n, doc, start) for doc, start, n in pieces)

    def __len__(self) -> int:
        return len(self.sorted)

    def longest(self, most: int) -> tuple[int, int, int] | None:
        """Take the longest piece of at most ``most`` ids."""
        at = bisect_right(self.sorted, (most, 1 << 62, 1 << 62))
        return self.sorted.pop(at - 1) if at else None

    def add(self, n: int, doc: int, start: int) -> None:
        insort(self.sorted, (n, doc, start))

    def least(self) -> tuple[int, int, int]:
        return self.sorted.pop(0)


def fill(windows: list[list[tuple[int, int, int]]], rests: Rests, gap: int,
         window: list[tuple[int, int, int]]) -> int:
    """Put pieces into ``window`` until it has no gap or no piece is left; returns the gap."""
    while gap and rests.sorted:
        if (piece := rests.longest(gap)) is None:
            n, doc, start = rests.least()  # longer than the gap: its head fills it
            rests.add(n - gap, doc, start + gap)
            piece = (gap, doc, start)
        window.append(piece)
        gap -= piece[0]
    windows.append(window)
    return gap


def pack(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Sequences of (length, document, start) for rests (document, start, length) under LONGEST.

    Tier by tier, from the longest: each document of the tier opens a window of
    the tier's length, and its gap takes whole documents of this and the shorter
    tiers, the longest that fit first.
    """
    rests, out = Rests(pieces), []
    for tier, below in zip(TIERS, (*TIERS[1:], 0)):
        while rests.sorted and rests.sorted[-1][0] > below:
            n, doc, start = rests.sorted.pop()
            window: list[tuple[int, int, int]] = []
            gap = fill(out, rests, tier - n, window)
            window.insert(0, (n, doc, start))
            if gap:  # nothing is left: lengths of powers of two need no padding
                out.pop()
                out += powers(window)
    return out


def powers(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The same ids as sequences whose lengths are the binary digits of their number."""
    left, out = sum(n for n, _, _ in window), []
    todo = window[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        own = []
        while room:
            n, doc, start = todo.pop()
            take = min(n, room)
            own.append((take, doc, start))
            room -= take
            if take < n:
                todo.append((n - take, doc, start + take))
        out.append(own)
    return out


def steps(lengths: list[int], size: int = STEP) -> list[int]:
    """A step group for every sequence: the longest first, each to the group with the fewest ids."""
    groups = [(0, g) for g in range(max(1, -(-sum(lengths) // size)))]
    out = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n, g = groups[0]
        out[i] = g
        heapq.heapreplace(groups, (n + lengths[i], g))
    return out


def packed(docs: list[tuple[object, bytes]], serial: int) -> tuple[list[tuple], int]:
    """The rows of ``SCHEMA``, after the id, of one block; sequences are numbered from ``serial``."""
    sequences: list[list[tuple[int, int, int]]] = []
    rests = []
    for doc, (_, ids) in enumerate(docs):
        n = len(ids) // 4
        whole = n - n % LONGEST
        sequences += [[(LONGEST, doc, start)] for start in range(0, whole, LONGEST)]
        if n > whole:
            rests.append((doc, whole, n - whole))
    sequences += pack(rests)
    lengths = [sum(n for n, _, _ in s) for s in sequences]
    rows = []
    for i, (sequence, length, step) in enumerate(zip(sequences, lengths, steps(lengths))):
        tier, offset = next((t for t in reversed(TIERS) if length <= t)), 0
        for n, doc, start in sequence:
            key, ids = docs[doc]
            rows.append((key, start, n, zlib.crc32(ids[4 * start:4 * (start + n)]), len(ids) // 4,
                         serial + i, offset, tier, serial + step))
            offset += n
    return rows, serial + len(sequences)


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``id_col`` and the columns of ``SCHEMA``.

    A document is the ids of its text and the end id, so a null or empty text
    is one id. Rows that repeat an id are packed as documents of their own.
    ``sequence_id`` and ``step_id`` are unique over all tasks and the same in a
    rerun over the same input splits. An empty table gives an empty result;
    other columns are ignored.
    """
    end = END_OF_DOCUMENT.to_bytes(4, "little")
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, *(c.split()[0] for c in SCHEMA.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, serial = tokens.ids(vocabulary).encode, TaskContext.get().partitionId() << 40
        block: list[tuple[object, bytes]] = []
        size = 0

        def result() -> pa.RecordBatch:
            nonlocal serial
            rows, serial = packed(block, serial)
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], key_type), *(pa.array(c, pa.int64()) for c in columns[1:])], names=names)

        for batch in batches:
            key_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block.append((key, encode(text) + end))
                size += len(block[-1][1]) // 4
                if size >= BLOCK:
                    yield result()
                    block, size = [], 0
        if block:
            yield result()

    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("__text"))
    return arrow_map(rows, run, f"`{id_col}` {kind}, {SCHEMA}")
