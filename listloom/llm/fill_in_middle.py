"""Operator 12: fill-in-the-middle transformation with cuts found in an indexable skip list."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textcodes import BLANKS, text_buffers

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
# A node of a lane also stands in the lane above once in so many.
FAN = 4


@dataclass(frozen=True)
class Rates:
    """Percent of texts that are cut, and of those that put the suffix first."""

    cut: int = 50
    spm: int = 80


class SkipList:
    """Units of a text under express lanes; each link carries its width in units, code points and bytes.

    Lane 0 links every unit to the next. A node rises by a hash of its rank, so equal texts have equal
    lists. ``at(rank)`` descends from the top lane and adds up the widths of the links it takes.
    """

    def __init__(self, chars: np.ndarray, size: np.ndarray) -> None:
        """``chars`` and ``size``: code points and bytes of each unit."""
        self.total = len(chars)
        widths = np.stack([np.ones(len(chars), dtype=np.int64), chars.astype(np.int64), size.astype(np.int64)], axis=1)
        height = self._heights(len(chars))
        # Of each lane: the links' widths and, for the node a link leads to, its place in the lane below.
        self.lanes: list[tuple[np.ndarray, np.ndarray]] = []
        below = np.arange(len(chars))
        while len(widths):
            self.lanes.append((widths, below))
            up = np.flatnonzero(height >= len(self.lanes))
            height = height[up]
            if len(up):
                sums = np.cumsum(widths, axis=0)[up]
                widths = np.diff(sums, axis=0, prepend=np.zeros((1, 3), dtype=np.int64))
            else:
                widths = widths[:0]
            below = up

    @staticmethod
    def _heights(n: int) -> np.ndarray:
        """Geometric heights: a node is in lane k with a chance of ``FAN ** -k``."""
        x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        unit = ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
        return np.floor(-np.log(unit) / np.log(FAN)).astype(np.int64)

    def at(self, rank: int) -> tuple[int, int]:
        """Code points and bytes in front of the end of unit ``rank`` (0: the start)."""
        if not 0 <= rank <= self.total:
            raise IndexError(f"{rank} of {self.total} units")
        left, chars, size, node = rank, 0, 0, -1
        for widths, below in reversed(self.lanes):
            # ``node``: the link taken last in this lane; -1 stands for the head.
            while left and node + 1 < len(widths) and widths[node + 1, 0] <= left:
                node += 1
                units, c, b = widths[node].tolist()
                left, chars, size = left - units, chars + c, size + b
            node = int(below[node]) if node >= 0 else -1
        return chars, size


_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(BLANKS)] = True


def units(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points and bytes of each unit of a UTF-8 text: blanks with the word behind them, or the last blanks."""
    inside = ~_BLANK[text]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = np.flatnonzero(last) + 1
    if len(text) and not inside[-1]:
        ends = np.append(ends, len(text))
    points = np.cumsum((text & 0xC0) != 0x80)
    return np.diff(points[ends - 1], prepend=0), np.diff(ends, prepend=0)


def draws(key: object, seed: int = 42) -> tuple[int, int, int, int]:
    """The first four 8-digit groups of the key's SHA-256; a null key is the empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def transform(text: bytes, key: object, rates: Rates = Rates(), seed: int = 42) -> tuple[int, str, int | None, int | None, bytes]:
    """Number of units, form, code points of prefix and middle (null when plain), and the output."""
    chars, size = units(np.frombuffer(text, dtype=np.uint8))
    n = len(chars)
    h1, h2, h3, h4 = draws(key, seed)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rates.cut:
        return n, PLAIN, None, None, text
    lanes = SkipList(chars, size)
    (c1, b1), (c2, b2) = (lanes.at(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:b1], text[b1:b2], text[b2:]
    if h4 % 100 < rates.spm:
        return n, SPM, c1, c2 - c1, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, PSM, c1, c2 - c1, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def restore(output: bytes, form: str) -> bytes:
    """The text that ``transform`` was given. No marker occurs in a cut text, so the first ones are the cuts."""
    if form == PLAIN:
        return output
    head, second = (SUFFIX, PREFIX) if form == SPM else (PREFIX, SUFFIX)
    rest, middle = output[len(head) :].split(MIDDLE, 1)
    a, b = rest.split(second, 1)
    return b + middle + a if form == SPM else a + middle + b


def transform_documents(
    df: DataFrame, key: str = "doc_id", text: str = "text", rates: Rates = Rates(), seed: int = 42, outputs: bool = False
) -> DataFrame:
    """``key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of each row, with ``outputs`` also ``output``.

    One narrow pass: a text is cut, put together, rebuilt from the output and its form, and hashed inside its
    task. A null text counts as empty and is plain with 0 units; a null key draws as the empty text, and so do
    all null keys alike. Repeated rows give repeated results. A text is taken whole, whatever its length: the
    list above it has some 4/3 links a unit. An empty table gives no rows; only the two named columns are
    read, so others may have any name.
    """
    kind = df.schema[key].dataType.simpleString()
    fields = [f"`{key}` {kind}", "n bigint", "form string", "prefix_chars bigint", "middle_chars bigint", "output_sha256 string", "restored_sha256 string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", *["output"] * outputs]
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            made = []
            for i, k in enumerate(batch.column(0).to_pylist()):
                n, form, before, between, out = transform(data[offsets[i] : offsets[i + 1]].tobytes(), k, rates, seed)
                again = restore(out, form)
                row = (n, form, before, between, hashlib.sha256(out).hexdigest(), hashlib.sha256(again).hexdigest())
                made.append((*row, out.decode()) if outputs else row)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.large_string()]
            columns = [pa.array([r[j] for r in made], type=kinds[j]) for j in range(6 + outputs)]
            if outputs:
                columns[-1] = columns[-1].cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    narrow = df.select(df[key].alias("_key"), df[text].alias("_text"))
    return narrow.mapInArrow(run, ", ".join([*fields, "output string"] if outputs else fields))
