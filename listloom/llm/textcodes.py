"""Words of whole texts as 64-bit codes, computed on Arrow buffers inside a task.

A word is a run of bytes outside a separator set; A-Z count as a-z. Its code is a
polynomial over random byte values modulo 2**64, mixed at the end, so equal words
have equal codes in every task and different words differ but for hash collisions.
Work goes through slices of a bounded number of bytes, whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"

_MULT = np.uint64(0x9E6C63D0876A9A47)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def combine(codes: list[np.ndarray]) -> np.ndarray:
    """One code for each row of several columns of codes, order included."""
    out = mix(codes[0])
    for column in codes[1:]:
        out = mix(out * _MULT + column)
    return out


@cache
def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
    for c in range(ord("A"), ord("Z") + 1):
        values[c] = values[c + 32]
    return values


@cache
def _separators(blanks: bytes) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(blanks)] = True
    return flags


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = pow(int(_MULT), -1, 1 << 64)
        tables = []
        for base in (_MULT, np.uint64(inverse)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0], _powers[1]


class Words:
    """Codes of the words of some texts; ``bounds[i]:bounds[i + 1]`` are those of text ``i``."""

    def __init__(self, codes: np.ndarray, bounds: np.ndarray, prefixes: dict[int, np.ndarray]) -> None:
        self.codes, self.bounds, self.prefixes = codes, bounds, prefixes

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def _cut(data: np.ndarray, offsets: np.ndarray, a: int, sep: np.ndarray) -> int:
    """The end of a slice from ``a`` that splits no word."""
    end, size = int(offsets[-1]), SLICE_BYTES
    while a + size < end:
        b = a + size
        seps = np.flatnonzero(sep[data[a:b]])
        k = int(np.searchsorted(offsets, b, side="right")) - 1
        best = max(int(offsets[k]), a + int(seps[-1]) + 1 if len(seps) else a)
        if best > a:
            return best
        size *= 2
    return end


def words(data: np.ndarray, offsets: np.ndarray, blanks: bytes = BLANKS, prefixes: tuple[int, ...] = ()) -> Words:
    """Codes of all words; ``prefixes`` adds codes of the first so many bytes (0: shorter word)."""
    sep, values = _separators(blanks), _byte_values()
    codes, begins = [], []
    heads: dict[int, list[np.ndarray]] = {k: [] for k in prefixes}
    a, end = int(offsets[0]), int(offsets[-1])
    while a < end:
        b = _cut(data, offsets, a, sep)
        part = data[a:b]
        inside = ~sep[part]
        edge = offsets[np.searchsorted(offsets, a, side="right") : np.searchsorted(offsets, b, side="left")] - a
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[edge] = inside[edge]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[edge - 1] = inside[edge - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        power, inverse = _power_tables(len(part) + 1)
        sums = np.empty(len(part) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(values[part] * power[: len(part)], out=sums[1:])
        codes.append(mix((sums[e] - sums[s]) * inverse[s]))
        begins.append(s + a)
        for k, out in heads.items():
            cut = np.minimum(s + k, e)
            code = mix((sums[cut] - sums[s]) * inverse[s] + np.uint64(k))
            out.append(np.where(e - s >= k, code | np.uint64(1), np.uint64(0)))
        a = b
    if not codes:
        none = np.empty(0, dtype=np.uint64)
        return Words(none, np.zeros(len(offsets), dtype=np.int64), dict.fromkeys(prefixes, none))
    bounds = np.searchsorted(np.concatenate(begins), offsets)
    return Words(np.concatenate(codes), bounds, {k: np.concatenate(v) for k, v in heads.items()})


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; a null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, ends, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0 or ends is None:
        return np.empty(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    offsets = np.frombuffer(ends, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def each_slice(
    column: pa.Array, blanks: bytes = BLANKS, prefixes: tuple[int, ...] = ()
) -> Iterator[tuple[int, int, Words]]:
    """Row range and words, slice by slice."""
    data, offsets = text_buffers(column)
    for i, j in slices(offsets):
        yield i, j, words(data, offsets[i : j + 1], blanks, prefixes)
