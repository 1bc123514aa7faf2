"""The tokenizer inside Python workers, one per process and vocabulary."""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import tiktoken
from tokenizers import Tokenizer

#: Fixed value: the pre-tokenisation pattern of the vocabulary, one alternative per kind of piece.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = "<|endoftext|>"
END_ID = 50256

#: The same pattern for texts of the characters that LATIN allows, where ``re`` agrees with it.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: A character outside basic Latin, its white space and Latin letters, or superscript digits and fractions.
NOT_LATIN = re.compile("[^\t\n\r -~¡-±´-¸º»¿-ſ]")
#: A space that the next piece doesn't take.
LOOSE_SPACE = re.compile(r" (?=\s|$)")

#: Words and pre-tokens kept with their ids in a worker; beyond it the memory starts anew.
WORDS, KEPT_PIECES = 400_000, 800_000


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def library(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def ranks(path: str) -> tiktoken.Encoding:
    """The encoder of the rank file beside the ``.json`` vocabulary (the same merges)."""
    with open(path.replace(".json", ".tiktoken"), "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={END: END_ID})


def plain(text: str) -> bool:
    """Whether PIECES splits ``text`` just as the library does, without special tokens in it."""
    return END not in text and not NOT_LATIN.search(text)


def pieces(text: str, path: str) -> list[str]:
    """The pre-tokens of ``text``, special tokens included as their own pre-token."""
    if plain(text):
        return PIECES.findall(text)
    out, split = [], library(path).pre_tokenizer.pre_tokenize_str
    for i, part in enumerate(text.split(END)):
        if i:
            out.append(END)
        out += [part[a:b] for _, (a, b) in split(part)]
    return out


def count(piece: str, path: str) -> int:
    """Tokens of one pre-token."""
    if piece == END:
        return 1
    return len(library(path).encode(piece, add_special_tokens=False).ids)


class Pieces(dict):
    """Little-endian unsigned 32-bit ids by pre-token."""

    def __init__(self, path: str):
        super().__init__()
        self.encode = ranks(path).encode_to_numpy

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT_PIECES:
            self.clear()
        self[piece] = out = self.encode(piece, disallowed_special=()).tobytes()
        return out


class Ids(dict):
    """The same by word, each with the space before it."""

    def __init__(self, path: str):
        super().__init__()
        self.path, self.pieces = path, Pieces(path)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS:
            self.clear()
        self[word] = out = b"".join(map(self.pieces.__getitem__, PIECES.findall(" " + word)))
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a whole text.

        A piece starts wherever a space stands before a character that isn't
        white space, so such a text is cut there and the words' ids are joined.
        Other texts go to the library whole.
        """
        if LOOSE_SPACE.search(text) or not plain(text):
            import numpy as np

            return np.array(library(self.path).encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        first, *words = text.split(" ")
        head = map(self.pieces.__getitem__, PIECES.findall(first))
        return b"".join([*head, *map(self.__getitem__, words)])


@lru_cache(maxsize=2)
def ids(path: str) -> Ids:
    return Ids(path)
