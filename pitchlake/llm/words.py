"""Words of whole columns of texts as numpy arrays: places and 64-bit hashes.

A word is a longest run of bytes that a table of 256 flags marks. The default
marks all but space and the control characters 0x09 to 0x0D; none of those
bytes occurs inside a longer UTF-8 character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: ASCII letters and digits, and every byte of longer characters.
ALPHANUMERIC = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
#: First two bytes of the characters of scripts without spaces between words:
#: Thai, Lao, Burmese, Khmer, Chinese and Japanese.
_ALONE = np.zeros(1 << 16, bool)
for _low, _high in ((0xE0B8, 0xE0BB), (0xE180, 0xE182), (0xE19E, 0xE19F), (0xE380, 0xE383), (0xE390, 0xE9BF), (0xEFA4, 0xEFAB), (0xF0A0, 0xF0B3)):
    _ALONE[_low : _high + 1] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[ord("A") : ord("Z") + 1] += 32

def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value over all bits."""
    x = x ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(left: np.ndarray, right: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of ordered pairs of hashes."""
    return mix(left * np.uint64(0xD6E8FEB86659FD93) + right, seed)


#: Numbers of a byte at one of the first places of its word; further places go
#: through mix().
_PLACES, _SEED = 64, 0x9E3779B97F4A7C15
_AT_PLACE = mix(np.arange(_PLACES << 8, dtype=np.uint64), _SEED)
#: Bytes that are hashed at once; bounds what stands beside the text itself.
_HASHED_BYTES = 1 << 18


@dataclass
class Words:
    """Words of some documents: data is all text, word i is data[start[i]:end[i]],
    document d has the words first[d] to first[d + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    offsets: np.ndarray

    def hashes(self, fold: np.ndarray = SAME) -> np.ndarray:
        """Hash of each word, of its bytes after folding: the sum of a random
        number for each byte and its place in the word, and of the length."""
        out = (self.end - self.start).astype(np.uint64)
        for low in range(0, len(self.data), _HASHED_BYTES):
            high = min(low + _HASHED_BYTES, len(self.data))
            i, j = np.searchsorted(self.end, low, "right"), np.searchsorted(self.start, high)
            if i == j:
                continue
            begins, ends = np.maximum(self.start[i:j], low), np.minimum(self.end[i:j], high)
            first = begins[0]
            # Bytes between words go on counting and belong to no sum.
            place = np.arange(first, high) - np.repeat(self.start[i:j], np.diff(begins, append=high))
            byte = fold[self.data[first:high]]
            value = _AT_PLACE[np.minimum(place, _PLACES - 1) << 8 | byte]
            far = np.flatnonzero(place >= _PLACES)
            value[far] = mix(place[far].astype(np.uint64) << np.uint64(8) | byte[far], _SEED)
            sums = np.zeros(high - first + 1, np.uint64)
            np.cumsum(value, out=sums[1:])
            out[i:j] += sums[ends - first] - sums[begins - first]
        return mix(out)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, nulls as empty, and the offsets of its rows."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if buffers[2] is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def find_words(data: np.ndarray, offsets: np.ndarray, marks: np.ndarray = NOT_SPACE, alone: bool = False) -> Words:
    """alone: characters of scripts without spaces are words of their own."""
    n = len(data)
    inside = marks[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    if alone:
        at = np.flatnonzero(data[:-2] >= 0xE0)
        at = at[_ALONE[data[at].astype(np.int64) << 8 | data[at + 1]]]
        after = at + np.where(data[at] >= 0xF0, 4, 3)
        begins[at] = True
        ends[at[at > 0] - 1] = inside[at[at > 0] - 1]
        ends[np.minimum(after, n) - 1] = True
        begins[after[after < n]] = inside[after[after < n]]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets), offsets)


def slices(texts: pa.Array, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about most_bytes of text; one longer row is a range of its own."""
    _, offsets = text_bytes(texts)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1
        to = min(len(texts), max(at + 1, to))
        yield at, to
        at = to


def words_of(texts: pa.Array, marks: np.ndarray = NOT_SPACE, alone: bool = False) -> Words:
    return find_words(*text_bytes(texts), marks, alone)
