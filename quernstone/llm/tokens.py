"""Words of whole batches of texts as 64-bit hashes, in numpy.

Words are runs of ASCII letters and digits and of bytes from 0x80 on; A-Z are
lower-cased. A word's hash is the value of a polynomial in its bytes modulo
2**64, mixed; it comes from prefix sums, so no text is looped over in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bytes taken at once; one text may be longer.
BLOCK = 1 << 20

_CLASS = np.zeros(256, dtype=np.uint8)
for _b in range(256):
    if chr(_b).isascii() and chr(_b).isalnum():
        _CLASS[_b] = ord(chr(_b).lower())
    elif _b >= 0x80:
        _CLASS[_b] = _b


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def power(way: str, n: int) -> np.ndarray:
    """The first ``n`` powers of a fixed odd base modulo 2**64 ("up"), or of its inverse ("down")."""
    if len(_powers[way]) < n:
        size = 1 << (n - 1).bit_length()
        base = np.full(size, _BASE if way == "up" else _UNBASE, dtype=np.uint64)
        base[0] = 1
        _powers[way] = np.multiply.accumulate(base)
    return _powers[way][:n]


class Words(NamedTuple):
    """Words of some texts: hash, number of the text, first byte and end in ``data``."""

    hashes: np.ndarray
    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    sums: np.ndarray
    n_texts: int

    def prefixes(self, length: int) -> np.ndarray:
        """Hash of each word's first ``length`` bytes (of the word, where shorter)."""
        return self._hash(np.minimum(self.ends, self.starts + length))

    def _hash(self, ends: np.ndarray) -> np.ndarray:
        down = power("down", len(self.sums))
        return mix((self.sums[ends] - self.sums[self.starts]) * down[self.starts])


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts whose UTF-8 bytes stand in ``data`` between ``offsets``."""
    n = len(data)
    letters = _CLASS[data]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(letters.astype(np.uint64) * power("up", n) if n else letters, out=sums[1:], dtype=np.uint64)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = letters > 0
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    both = cuts[inside[cuts] & inside[cuts + 1]]  # two texts that meet inside a word
    first[both], last[both - 1] = True, True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    words = Words(np.empty(0, np.uint64), text, starts, ends, sums, len(offsets) - 1)
    return words._replace(hashes=words._hash(ends))


def byte_blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of a string or binary column in runs of about ``limit`` bytes at most.

    Gives the first row's number, the bytes, and offsets into them; a null is
    an empty text. A text over the limit makes a run of its own, whole.
    """
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    _, offset_buffer, value_buffer = column.buffers()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(offset_buffer, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    values = np.frombuffer(value_buffer, dtype=np.uint8) if value_buffer is not None and value_buffer.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, values[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, Words]]:
    """``words_of`` the runs of :func:`byte_blocks`, each with its first row's number."""
    for row, data, offsets in byte_blocks(column, limit):
        yield row, words_of(data, offsets)
