"""Byte-level BPE: texts to ids and back.

A pre-token starts as a doubly linked list of byte symbols. A priority queue
holds the merges that its neighbours allow, by rank and then place; each merge
taken from it joins two symbols and adds the merges with the new neighbours.
Entries whose symbols have changed since are stale and skipped. A pre-token of n
bytes so takes O(n log n) however long it is, and short ones are kept with their
ids. Decoding concatenates the vocabulary's strings, byte by byte.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from . import tokens
from .common import arrow_map, chunks, text_or_empty

#: Pre-tokens and words kept with their ids in a worker, and the most characters of one that is kept.
KEPT, KEPT_CHARS = 250_000, 64
#: Bits of a queue entry that hold the place; the rank lies above.
PLACE = 40
#: Bytes from which a pre-token's list of symbols is kept in arrays.
LONG = 10_000
#: Stands for a null id.
NO_ID = -1


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte: visible Latin-1 characters themselves, the others from 256 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Known(dict):
    """Ids as little-endian 32-bit integers by string; ``made`` gives those that aren't kept.

    What wasn't used since the memory was last full is forgotten when it is full again.
    """

    def __init__(self, made: Callable[[str], bytes]):
        super().__init__()
        self.made, self.older = made, {}

    def __missing__(self, key: str) -> bytes:
        out = self.older.get(key) or self.made(key)
        if len(key) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[key] = out
        return out


class Bpe:
    """The merges and strings of one ``.json`` vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        model = made["model"]
        if model["type"] != "BPE" or (made["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError(f"{path} is no byte-level BPE vocabulary")
        vocab, symbols = model["vocab"], byte_symbols()
        self.bytes_ = [vocab[symbols[b]] for b in range(256)]
        #: by left id and right id the rank, shifted to its bits of a queue entry; by rank the merged id
        self.merges: dict[int, dict[int, int]] = {i: {} for i in vocab.values()}
        self.results: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[vocab[left]][vocab[right]] = rank << PLACE
            self.results.append(vocab[left + right])
        special = {t["content"]: t["id"] for t in made["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in made["added_tokens"]):
            raise ValueError(f"{path} has added tokens that depend on their surroundings")
        self.special = special
        longest_first = sorted(filter(None, special), key=len, reverse=True)
        self.special_strings = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        back = {c: b for b, c in symbols.items()}

        def string(token: str) -> bytes:
            return bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()

        self.strings = {i: string(token) for token, i in (vocab | special).items()}
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.pieces = Known(lambda piece: self.merged(piece.encode()))
        #: ids of a word and the space before it
        self.words = Known(self.of_word)

    def merged(self, piece: bytes) -> bytes:
        """The ids of one pre-token."""
        merges, results = self.merges, self.results
        n = len(piece)
        # lists are faster, arrays take an eighth of their memory
        numbers = list if n < LONG else partial(array, "q")
        ids = numbers(map(self.bytes_.__getitem__, piece))
        after, before = numbers(range(1, n + 1)), numbers(range(-1, n - 1))
        #: the entry of each symbol's merge with the next one, -1 if there is none
        current = numbers([merges[x].get(y, -1) for x, y in pairwise(ids)])
        current.append(-1)
        queue = []
        for at, entry in enumerate(current):
            if entry >= 0:
                current[at] = entry = entry | at
                queue.append(entry)
        heapify(queue)
        while queue:
            entry = heappop(queue)
            at = entry & (1 << PLACE) - 1
            if current[at] != entry:
                continue  # stale
            ids[at] = made = results[entry >> PLACE]
            right = after[at]
            ids[right] = current[right] = -1
            after[at] = right = after[right]
            if right < n:
                before[right] = at
                if (found := merges[made].get(ids[right], -1)) >= 0:
                    found |= at
                    heappush(queue, found)
                current[at] = found
            else:
                current[at] = -1
            if (left := before[at]) >= 0:
                if (found := merges[ids[left]].get(made, -1)) >= 0:
                    found |= left
                    heappush(queue, found)
                current[left] = found
        return array("i", [i for i in ids if i >= 0]).tobytes()

    def of_word(self, word: str) -> bytes:
        spaced = " " + word
        if word.isalpha():  # one piece
            return self.merged(spaced.encode())
        return b"".join(map(self.pieces.__getitem__, tokens.PIECES.findall(spaced)))

    def plain(self, text: str) -> Iterator[bytes]:
        """The ids of a text without special strings, part by part.

        Where only Latin letters and tight spaces occur, a pre-token starts at
        every space, so such a text goes word by word.
        """
        if tokens.NOT_LATIN.search(text):
            return map(self.pieces.__getitem__, [text[a:b] for _, (a, b) in self.split(text)])
        if tokens.LOOSE_SPACE.search(text):
            return map(self.pieces.__getitem__, tokens.PIECES.findall(text))
        first, *words = text.split(" ")
        return chain(map(self.pieces.__getitem__, tokens.PIECES.findall(first)), map(self.words.__getitem__, words))

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian 32-bit integers; special strings are their own ids."""
        if not self.special_strings or not self.special_strings.search(text):
            return b"".join(self.plain(text))
        out: list[bytes] = []
        for part in self.special_strings.split(text):
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
            else:
                out += self.plain(part)
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids; ids that aren't in the vocabulary are skipped, bytes that aren't UTF-8 replaced."""
        strings = self.strings
        try:
            found = b"".join(map(strings.__getitem__, ids))
        except KeyError:
            found = b"".join([strings[i] for i in ids if i in strings])
        return found.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


class _Encoded:
    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary

    def parts(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i, j in chunks(batch, "__in"):
            yield batch.slice(i, j - i)

    def __call__(self, column: pa.Array) -> pa.Array:
        encode = bpe(self.vocabulary).encode
        found = [encode(text) for text in column.to_pylist()]
        ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), dtype="<i4")))


class _Decoded:
    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary

    def parts(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield from (batch.slice(i, 50) for i in range(0, batch.num_rows, 50))

    def __call__(self, column: pa.Array) -> pa.Array:
        decode = bpe(self.vocabulary).decode
        ends = np.cumsum([0, *pc.list_value_length(column).to_pylist()]).tolist()
        ids = column.flatten().fill_null(NO_ID).to_numpy().tolist()
        return pa.array([decode(ids[a:b]) for a, b in pairwise(ends)], pa.string())


def _with_column(docs: DataFrame, given: Column, name: str, kind: str, values: _Encoded | _Decoded) -> DataFrame:
    """``docs`` with the column ``name`` of type ``kind``, which ``values`` makes of ``given``."""
    own = [c for c in docs.columns if c.lower() != name.lower()]
    rows = docs.select(*[docs[c] for c in own], given.alias("__in"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in values.parts(batch):
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], values(part.column(len(own)))],
                                                 names=[*own, name])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return arrow_map(rows, run, f"{fields}`{name}` {kind}")


def encode_texts(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col``, the array of ids of ``text_col``, as the library makes them without special tokens
    around the text. ``vocabulary``: the path of a byte-level BPE ``.json`` file that every task can read.

    A null or empty text has no ids; special strings inside texts are their own ids. Each row is encoded alone, so
    repeated rows are alike; an empty table gives an empty result. A column named like the result is replaced, all
    others stay.
    """
    return _with_column(docs, text_or_empty(text_col), ids_col, "array<int>", _Encoded(vocabulary))


def decode_ids(docs: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with ``text_col``, the text of the ids, special tokens included.

    A null or empty array is an empty text; null ids and those that aren't in the vocabulary are skipped; bytes
    that aren't UTF-8 become U+FFFD. Other columns as for ``encode_texts``.
    """
    ids = F.coalesce(F.col(ids_col).cast("array<int>"), F.expr("cast(array() as array<int>)"))
    return _with_column(docs, ids, text_col, "string", _Decoded(vocabulary))
