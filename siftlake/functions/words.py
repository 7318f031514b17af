"""Words of a text and their stable codes.

A text's words are the runs of ``[a-z0-9]`` that remain after NFKD, removal of combining marks and
lower-casing.  A word's code is the 64-bit xxHash of its letters, read as a signed number.
"""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np
import xxhash

RUN = re.compile("[a-z0-9]+")
CACHE_LIMIT = 2_000_000


class Codes(dict):
    """Word -> signed 64-bit code; emptied when it holds ``CACHE_LIMIT`` words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_LIMIT:
            self.clear()
        code = xxhash.xxh64_intdigest(word)
        self[word] = code = code - (1 << 64) if code >> 63 else code
        return code


CODES = Codes()


def words(text: str | None, entities: bool = False) -> list[str]:
    """The words in their order; ``entities`` resolves HTML entities first.  None has no words."""
    if not text:
        return []
    if entities and "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return RUN.findall(text.lower())


def codes(text: str | None, entities: bool = False) -> np.ndarray:
    """The words' codes in their order."""
    found = words(text, entities)
    return np.fromiter(map(CODES.__getitem__, found), dtype=np.int64, count=len(found))


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64); another seed, another order."""
    with np.errstate(over="ignore"):
        v = values.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) % (1 << 64))
        v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return v ^ (v >> np.uint64(31))
