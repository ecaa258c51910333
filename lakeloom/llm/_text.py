"""Vectorised tokenising of Arrow string columns.

Works on the UTF-8 bytes of a slice of rows at a time: word borders come from
a byte class table, word hashes from one multiply-add pass. No Python object
is made per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: words of everything but ASCII white space
NON_SPACE = ~SPACE
#: words of ASCII letters and digits and all code points from U+0080
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20

#: small enough for the work arrays of a slice to stay in a core's cache
SLICE_BYTES = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place on a fresh array)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE_FOLDED = _BYTE[FOLD]
_STEP = np.uint64(0xA24BAED4963EE407)
_WINDOW = mix(np.arange(301, 333, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)


def slices(column: pa.Array, most: int = SLICE_BYTES):
    """Yield (first row, bytes, offsets) of runs of rows with at most ``most``
    bytes (or one row). A null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        at = offsets[first:last + 1].astype(np.int64)
        yield first, data[at[0]:at[-1]], at - at[0]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Starts and ends of the words of a slice, and the index of each row's
    first word (one more entry than rows)."""
    is_word = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(is_word)
    before[:1] = False
    before[1:] = is_word[:-1]
    starts = np.flatnonzero(is_word & (~before | edge[:-1]))
    after = np.empty_like(is_word)
    after[-1:] = False
    after[:-1] = is_word[1:]
    ends = np.flatnonzero(is_word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, folded: bool) -> np.ndarray:
    """64-bit hash of each word; ``folded`` maps A-Z to a-z first."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    total = np.cumsum(length)
    place = np.arange(total[-1]) - np.repeat(total - length, length)
    power = np.cumprod(np.full(int(length.max()), _STEP))
    value = (_BYTE_FOLDED if folded else _BYTE)[data[np.repeat(starts, length) + place]]
    return mix(np.add.reduceat(value * power[place], total - length) + length.astype(np.uint64))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive hashes (rows are not respected)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += hashes[k:k + n] * _WINDOW[k % 32]
        out = (out << np.uint64(7)) | (out >> np.uint64(57))
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """An Arrow list column from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
