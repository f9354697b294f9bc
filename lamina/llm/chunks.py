"""Splitting texts where no token can cross, so that each distinct chunk is encoded once."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np

CACHED_CHUNKS = 500_000

# A single space between two characters that are not white space.
_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
# White space that is neither a space nor a line feed.
_OTHER_SPACE = re.compile(r"[^\S \n]")
# A single space between two characters that are not spaces.
_BETWEEN_PIECES = re.compile(r"(?<=[^ ]) (?=[^ ])")


def word_chunks(text: str) -> list[str]:
    """The text cut at each lone space between characters that are not white space.

    A byte-level tokenizer that takes a space into the word after it never joins
    characters across such a cut. All chunks but the first had the space before them.
    """
    if (
        "  " in text
        or " \n" in text
        or "\n " in text
        or text[:1].isspace()
        or text[-1:].isspace()
        or _OTHER_SPACE.search(text)
    ):
        return _BETWEEN_WORDS.split(text)
    return text.split(" ")


def piece_chunks(text: str) -> list[str]:
    """The text cut at each lone space, which is left out.

    A tokenizer that puts its space marker before every text encodes a chunk as it
    encodes it after that space, if no piece has a marker behind another character.
    """
    chunks = text.split(" ")
    if "" in chunks:
        return _BETWEEN_PIECES.split(text) if text else []
    return chunks


class ChunkCache:
    """Encoded chunks, kept until `clear`, `size` of them at most.

    The size only bounds memory: a chunk that found no room is encoded again when it
    comes again. The frequent chunks come first and so stay.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable], size: int = CACHED_CHUNKS):
        self.encode, self.size, self.known = encode, size, {}

    def __call__(self, texts: list[list[str]]) -> list[list]:
        """The encodings of the chunks of each text."""
        known = self.known
        missing = list({c: None for chunks in texts for c in chunks if c not in known})
        new = dict(zip(missing, self.encode(missing), strict=True))
        if len(known) + len(new) <= self.size:
            known.update(new)
            return [[known[c] for c in chunks] for chunks in texts]
        return [[known[c] if c in known else new[c] for c in chunks] for chunks in texts]

    def clear(self) -> None:
        self.known = {}


def id_bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()
