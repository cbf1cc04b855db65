"""Vectorised word work on Arrow text batches, shared by the operators of this subpackage.

All functions work on the UTF-8 bytes of a whole Arrow batch at once (numpy, no
per-word Python): word boundaries come from a 256-entry byte class table, word
hashes from one running polynomial sum over the bytes.  Byte classes are safe on
UTF-8 because every class used here treats all bytes >= 0x80 alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# bytes of text worked on at once: bounds a task's memory, texts are never cut by it
SLICE_BYTES = 1 << 21

SPACE_BYTES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_MULT = 0x9E3779B97F4A7C15 | 1
_U = np.uint64
_POW = np.ones(1, dtype=_U)
_INV = np.ones(1, dtype=_U)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: words [^\x20\x09-\x0D]+ : everything but white space
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SPACE_BYTES)] = False

#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z: digits, letters, bytes >= 0x80
IS_ALNUM = np.zeros(256, dtype=bool)
IS_ALNUM[48:58] = True
IS_ALNUM[65:91] = True
IS_ALNUM[97:123] = True
IS_ALNUM[128:] = True

#: letters for language work: ASCII letters and all bytes >= 0x80
IS_LETTER = IS_ALNUM.copy()
IS_LETTER[48:58] = False


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), elementwise on uint64."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd multiplier and of its inverse modulo 2**64, at least n of each."""
    global _POW, _INV
    if len(_POW) < n:
        n = max(n, SLICE_BYTES + 1)
        inv = pow(_MULT, -1, 1 << 64)
        out = []
        for m in (_MULT, inv):
            a = np.full(n, m, dtype=_U)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        _POW, _INV = out
    return _POW, _INV


def slices(batch: pa.RecordBatch, col: str, limit: int = SLICE_BYTES):
    """Row slices of a batch with about ``limit`` bytes of text each (one row at least)."""
    arr = batch.column(batch.schema.get_field_index(col))
    if batch.num_rows == 0:
        return
    off = offsets_of(arr)
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def offsets_of(arr: pa.Array) -> np.ndarray:
    """Byte offsets of the rows (n + 1 of them) in the array's own data buffer."""
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    dt = np.int64 if wide else np.int32
    buf = arr.buffers()[1]
    if buf is None:
        return np.zeros(len(arr) + 1, dtype=np.int64)
    return np.frombuffer(buf, dtype=dt, count=len(arr) + 1,
                         offset=arr.offset * dt().itemsize).astype(np.int64)


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, n + 1 offsets from 0); a null row has no bytes."""
    if arr.null_count:
        arr = arr.fill_null("")
    off = offsets_of(arr)
    data = arr.buffers()[2]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, dtype=np.uint8), off - off[0]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]]
    return raw, off - off[0]


class Words:
    """Words of all rows of a text array.

    start, end : byte ranges in ``data`` (A-Z lower-cased)
    row        : row of each word;  first : n + 1 offsets of the rows' words
    """

    __slots__ = ("data", "start", "end", "row", "first", "offsets", "_sum")

    def __init__(self, arr: pa.Array, is_word: np.ndarray = IS_WORD):
        raw, off = text_bytes(arr)
        n = len(raw)
        inside = is_word[raw]
        edge = np.zeros(n, dtype=bool)
        begins = off[:-1][off[:-1] < off[1:]]
        if n:
            prev = np.empty(n, dtype=bool)
            prev[0] = False
            prev[1:] = inside[:-1]
            edge[begins] = True
            start = np.flatnonzero(inside & (~prev | edge))
            last = np.empty(n, dtype=bool)  # the next byte belongs to another word or to none
            last[:-1] = ~inside[1:] | edge[1:]
            last[-1] = True
            end = np.flatnonzero(inside & last) + 1
        else:
            start = end = np.zeros(0, dtype=np.int64)
        self.data = LOWER[raw]
        self.start, self.end, self.offsets = start, end, off
        self.first = np.searchsorted(start, off).astype(np.int64)
        self.row = np.repeat(np.arange(len(off) - 1), np.diff(self.first))
        self._sum = None

    def __len__(self) -> int:
        return len(self.start)

    def hash_ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges of ``data``: equal bytes, equal hash."""
        n = len(self.data)
        power, inverse = _powers(n + 1)
        if self._sum is None:
            self._sum = np.zeros(n + 1, dtype=_U)
            np.cumsum((self.data.astype(_U) + _U(1)) * power[:n], out=self._sum[1:])
        h = (self._sum[end] - self._sum[start]) * inverse[start]
        return mix64(h + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))

    def hashes(self) -> np.ndarray:
        return self.hash_ranges(self.start, self.end)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


_COMBINE = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
            0x85EBCA77C2B2AE63]


def _coef(i: int) -> np.uint64:
    return _U(pow(_COMBINE[i % 5], 2 * (i // 5) + 1, 1 << 64))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, from the word hashes; shorter input gives none."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=_U)
    out = np.full(m, k * 0xA0761D6478BD642F % (1 << 64), dtype=_U)
    for i in range(k):
        out += h[i:i + m] * _coef(i)
    return mix64(out)


def list_array(values: np.ndarray, counts: np.ndarray, type_: pa.DataType) -> pa.ListArray:
    off = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, type_))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


class Lines(Words):
    """Lines of all rows (split at \\n), stripped of white space at both ends.

    ``start, end`` are the stripped byte ranges (an all-blank line has start == end),
    ``whole_start, whole_end`` the lines as they stand in ``raw``; ``chars`` counts code
    points of the stripped line.
    """

    __slots__ = ("raw", "whole_start", "whole_end", "chars")

    def __init__(self, arr: pa.Array):
        raw, off = text_bytes(arr)
        n, rows = len(raw), len(off) - 1
        breaks = np.flatnonzero(raw == 10)
        # a row's lines start at its own start and after each of its breaks
        row_of_break = np.searchsorted(off, breaks, side="right") - 1
        per_row = np.bincount(row_of_break, minlength=rows)[:rows] + 1
        self.first = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int64)
        self.row = np.repeat(np.arange(rows), per_row)
        order = np.lexsort((np.concatenate([off[:-1], breaks + 1]),
                            np.concatenate([np.arange(rows), row_of_break])))
        self.whole_start = np.concatenate([off[:-1], breaks + 1])[order].astype(np.int64)
        end = np.empty(len(self.whole_start), dtype=np.int64)
        end[:-1] = self.whole_start[1:] - 1
        last = self.first[1:] - 1
        end[last] = off[1:]
        self.whole_end = end
        solid = np.flatnonzero(IS_WORD[raw])
        a, b = np.searchsorted(solid, self.whole_start), np.searchsorted(solid, end)
        has = b > a
        self.start = self.whole_start.copy()
        self.end = self.whole_start.copy()
        self.start[has] = solid[a[has]]
        self.end[has] = solid[b[has] - 1] + 1
        points = np.zeros(n + 1, dtype=np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
        self.chars = points[self.end] - points[self.start]
        self.raw, self.data, self.offsets = raw, LOWER[raw], off
        self._sum = None
