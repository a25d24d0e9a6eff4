"""Words of Arrow text arrays, found and hashed by whole-array operations on their bytes.

A batch is worked through in pieces of a few megabytes, so memory follows the piece and not the batch. Null texts
have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2 << 20

_BYTES = np.arange(256)
#: Words ``[^\x20\x09-\x0D]+``.
NOT_BLANK = (_BYTES != 0x20) & ((_BYTES < 0x09) | (_BYTES > 0x0D))
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, small letters and all that is not ASCII.
LETTERS = (_BYTES >= 0x80) | ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
#: A-Z to a-z.
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 0x20, _BYTES).astype(np.uint8)

_ODD_1 = np.uint64(0x9E3779B97F4A7C15)
_ODD_2 = np.uint64(0xC2B2AE3D27D4EB4F)
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


class Texts(NamedTuple):
    """Bytes of texts that follow each other; text i is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Word i is ``data[start[i]:end[i]]``; those of text t are ``first[t]`` to ``first[t + 1]``."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def last(self) -> np.ndarray:
        """For each word, where the words of its text end."""
        return np.repeat(self.first[1:], np.diff(self.first))


def texts(column: pa.Array) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def pieces(whole: Texts, limit: int = PIECE_BYTES) -> Iterator[tuple[int, Texts]]:
    """(index of the first text, texts) of at most ``limit`` bytes, or of one text."""
    data, offsets = whole
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1, row + 1)
        yield row, Texts(data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row])
        row = stop


def words(source: Texts, members: np.ndarray) -> Words:
    """The longest runs of member bytes; a run ends with its text."""
    data, offsets = source
    inside = members[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    filled = offsets[:-1] < offsets[1:]
    before[offsets[:-1][filled]] = False
    after[offsets[1:][filled] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(start, end, np.searchsorted(start, offsets))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD_1
    return h ^ (h >> np.uint64(29))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of each word, eight bytes a step."""
    if not len(start):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    load = np.ndarray((len(data),), "<u8", padded, strides=(1,))
    length = end - start
    h = mix((load[start] & _KEEP[np.minimum(length, 8)]) ^ (length.astype(np.uint64) * _ODD_2))
    live, step = np.flatnonzero(length > 8), 8
    while len(live):
        left = length[live] - step
        h[live] = mix(h[live] * _ODD_2 ^ (load[start[live] + step] & _KEEP[np.minimum(left, 8)]))
        live, step = live[left > 8], step + 8
    return h


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words, from each word on that has so many after it in the piece."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = h[: len(h) - n + 1]
    for k in range(1, n):
        out = mix(out * _ODD_2 + h[k : len(h) - n + 1 + k])
    return mix(out ^ np.uint64(n)) if n > 1 else out


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))] if len(values) else values


def lists(rows: np.ndarray, values: pa.Array, n_rows: int) -> pa.ListArray:
    """A list for each of ``n_rows`` rows, from values that stand in the order of their rows."""
    ends = np.searchsorted(rows, np.arange(n_rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
