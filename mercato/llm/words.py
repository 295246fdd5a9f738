"""Words of many texts at once, as hashes with their places, in NumPy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

from mercato.llm.rolling import mix, prefix_sums, stretch_hashes

BLOCK = 1 << 20  # bytes of texts that are looked at together; a longer text makes a block of its own
BLOCK_TEXTS = 1000  # and so many texts at most


def _lowered() -> np.ndarray:
    """Byte -> itself if it is part of a word (letters, digits, all of a non-ASCII letter), A-Z lowered, else 0."""
    out = np.zeros(256, np.uint8)
    for byte in range(256):
        sign = bytes([byte])
        if byte >= 128 or sign.isalnum():
            out[byte] = sign.lower()[0]
    return out


_WORD_BYTES = _lowered()


@dataclass
class Words:
    """Words of a block: hash, number of the text, and start and end of each in the bytes of ``block``."""

    block: bytes
    hashes: np.ndarray
    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    texts: int
    sums: np.ndarray

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, index of the first word) of all runs of ``size`` words within a text."""
        count = len(self.hashes) - size + 1
        if count <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out = self.hashes[:count].copy()
        for i in range(1, size):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += self.hashes[i:i + count]
        whole = np.flatnonzero(self.text[:count] == self.text[size - 1:])
        return mix(out[whole]), whole


    def openings(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, index of the word) of the first ``size`` bytes of all longer words; no word has the same hash."""
        longer = np.flatnonzero(self.ends - self.starts > size)
        starts = self.starts[longer]
        return ~stretch_hashes(self.sums, starts, starts + size), longer


def _unspaced(signs: np.ndarray) -> np.ndarray:
    """Whether a character of a script without spaces (Thai, Lao, Burmese, Khmer, Chinese, Japanese) starts or ends at
    each byte of UTF-8 and at the end."""
    cut = np.zeros(len(signs) + 1, bool)
    lead = np.flatnonzero(signs[:-1] >= 0xE0)
    first, second = signs[lead], signs[lead + 1]
    three = (first >= 0xE3) & (first <= 0xE9) | (first == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    three |= (first == 0xE1) & ((second >= 0x80) & (second <= 0x82) | (second >= 0x9E) & (second <= 0x9F))
    four = (first == 0xF0) & (second >= 0xA0) & (second <= 0xB3)
    for found, size in ((lead[three], 3), (lead[four], 4)):
        cut[found] = cut[found + size] = True
    return cut


def split_words(texts: list[bytes], unspaced: bool = False) -> Words:
    """Words of the texts; with ``unspaced``, each character of a script without spaces is a word."""
    block = b"\n".join(texts)
    signs = np.frombuffer(block, np.uint8)
    codes = _WORD_BYTES[signs]
    inside = np.zeros(len(codes) + 2, bool)
    inside[1:-1] = codes > 0
    edges = inside[1:] != inside[:-1]
    if unspaced:
        edges |= _unspaced(signs)
    starts, ends = np.flatnonzero(edges & inside[1:]), np.flatnonzero(edges & inside[:-1])
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    text = np.searchsorted(np.cumsum(sizes), starts, side="right")
    sums = prefix_sums(codes)
    return Words(block, stretch_hashes(sums, starts, ends), text, starts, ends, len(texts), sums)


def blocks(texts: Iterable[str | None], unspaced: bool = False) -> Iterator[Words]:
    """Words of the texts in turn, some at a time; null texts have none."""
    waiting, size = [], 0
    for text in texts:
        waiting.append((text or "").encode())
        size += len(waiting[-1])
        if size >= BLOCK or len(waiting) >= BLOCK_TEXTS:
            yield split_words(waiting, unspaced)
            waiting, size = [], 0
    if waiting:
        yield split_words(waiting, unspaced)
