"""Words and word shingles of many texts at once, on the bytes Arrow holds.

Texts are looked at as UTF-8 bytes. Both kinds of word used here are runs of
certain bytes: every byte of a character beyond ASCII is 128 or more, and all
of these belong to words. Hashes are sums of mixed 8-byte parts, so the work per
byte is a few vector operations and no two words meet by the pattern of their letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are held as arrays at a time; a longer text stands alone.
SLICE_BYTES = 1 << 19

_STEP = np.uint64(0xD6E8FEB86659FD93 | 1)
_U64 = np.uint64

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bytes(separators: bytes) -> np.ndarray:
    """Which bytes belong to words, if ``separators`` do not."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: Words of letters and digits: everything but 0-2F, 3A-60 and 7B-7F, after lower-casing.
ALPHANUMERIC = word_bytes(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: Words between white space.
BLANK_SEPARATED = word_bytes(b" \t\n\x0b\x0c\r")


@dataclass
class Words:
    """The words of some texts: lower-cased bytes, first and last places, and text of each word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    texts: int

    def per_text(self) -> np.ndarray:
        """Where each text's words begin, with the end as last entry."""
        return np.searchsorted(self.text, np.arange(self.texts + 1))

    def joined(self, first: int, count: int) -> bytes:
        """Some consecutive words with a blank between them."""
        return b" ".join(
            self.data[s:e].tobytes()
            for s, e in zip(self.starts[first : first + count], self.ends[first : first + count])
        )


def text_slices(texts: pa.StringArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Parts of an array of texts: first and last row, their bytes, and where each text begins."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    wide = pa.types.is_large_string(texts.type)
    buffers = texts.buffers()
    ends = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)
    ends = ends[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        last = int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1
        last = min(max(last, row + 1), len(texts))
        yield row, last, data[ends[row] : ends[last]], ends[row : last + 1] - ends[row]
        row = last


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """The words of texts that lie one after the other in ``data``."""
    data = LOWER[data]
    inside = table[data]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[begins] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[-1:] = False
    after[begins[begins > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    return Words(data, starts, ends, text, len(offsets) - 1)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all (splitmix64)."""
    x = values + _U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of every word: its 8-byte parts, each mixed with its place, and its length."""
    sizes = words.ends - words.starts
    parts = (sizes + 7) // 8
    last = np.cumsum(parts)
    place = np.arange(int(last[-1]) if len(last) else 0) - np.repeat(last - parts, parts)
    begin = np.repeat(words.starts, parts) + 8 * place
    left = np.repeat(words.ends, parts) - begin
    data = np.concatenate([words.data, np.zeros(8, dtype=np.uint8)])
    values = np.zeros(len(begin), dtype=_U64)
    for i in range(8):
        values |= np.where(left > i, data[begin + i], 0).astype(_U64) << _U64(8 * i)
    mixed = mix(mix(values) ^ mix(place.astype(_U64) * _STEP))
    sums = np.concatenate([np.zeros(1, dtype=_U64), np.cumsum(mixed, dtype=_U64)])
    return mix((sums[last] - sums[last - parts]) ^ mix(sizes.astype(_U64)))


def windows(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size`` consecutive words of one text, and the first word of each."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=_U64), np.empty(0, dtype=np.int64)
    total = np.full(n, _U64(size), dtype=_U64)
    for i in range(size):
        total = total * _STEP + hashes[i : i + n]
    first = np.flatnonzero(text[:n] == text[size - 1 :])
    return mix(total[first]), first
