"""Operator 1: documents into token sequences by first-fit decreasing."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bpe
from .textcodes import mix

# Documents in a group on average; a group is packed by one task.
GROUP_DOCS = 4096
# Bits of a sequence id that number the sequences of a group; a group holds far fewer pieces.
LOCAL_BITS = 32


class FirstFit:
    """A tournament tree: each inner node holds the larger remaining capacity below it."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.tree = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """The first bin with room: its number, and the room it had."""
        tree, node = self.tree, 1
        if tree[1] < length:
            raise ValueError("no bin has room")
        while node < self.leaves:
            node *= 2
            if tree[node] < length:
                node += 1
        room, bin_no = tree[node], node - self.leaves
        tree[node] = room - length
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
        return bin_no, room


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; the longest first, equal ones in their order."""
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    if len(lengths) == 0:
        return bins, offsets
    tree = FirstFit(len(lengths), capacity)
    for i in np.argsort(-lengths, kind="stable"):
        number, room = tree.place(int(lengths[i]))
        bins[i], offsets[i] = number, capacity - room
    return bins, offsets


def cut_documents(df: DataFrame, path: str, capacity: int, end_id: int, groups: int, text: str, keep: tuple[str, ...]) -> DataFrame:
    """One row per piece: ``keep``, ``start, length, ids_crc32, doc_tokens`` and the ``group`` it is packed in.

    The group is a hash of the row and of how many equal rows the task saw before, so copies spread over
    the groups and a repeated task gives the same groups.
    """
    schema = df.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    names = [*keep, "start", "length", "ids_crc32", "doc_tokens", "group"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = bpe.encoder(path).ids, Counter()
        for batch in batches:
            row, start, length, crc, total, key = [], [], [], [], [], []
            for i, value in enumerate(bpe.texts(batch.column(batch.num_columns - 1))):
                ids = np.append(encode(value), np.uint32(end_id)).astype("<u4")
                whole = zlib.crc32(ids)
                nth = seen[whole]
                seen[whole] += 1
                for a in range(0, len(ids), capacity):
                    part = ids[a : a + capacity]
                    row.append(i)
                    start.append(a)
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
                    total.append(len(ids))
                    key.append((whole << 32) ^ (nth << 12) ^ a)
            group = (mix(np.array(key, dtype=np.uint64)) % np.uint64(groups)).astype(np.int64)
            at = pa.array(row, type=pa.int64())
            kept = [batch.column(i).take(at) for i in range(len(keep))]
            made = [pa.array(x, type=pa.int64()) for x in (start, length, crc, total, group)]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    narrow = df.select(*keep, F.col(f"`{text}`").alias("_text"))
    made = ", ".join(f"`{n}` bigint" for n in names[len(keep) :])
    return narrow.mapInArrow(run, f"{fields}, {made}")


def pack_documents(
    df: DataFrame,
    path: str,
    capacity: int = 2048,
    end_id: int = 1,
    group_docs: int = GROUP_DOCS,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Pieces of all documents with their place: ``sequence_id`` and ``offset``.

    Each document is encoded, ended by ``end_id`` and cut after every ``capacity`` ids; each id lies in
    exactly one piece. Randomised groups of documents, about ``group_docs`` each, are packed apart from each other
    by first-fit decreasing over a tournament tree. Sequences are padded to ``capacity`` by the
    reader. One encoding pass and one shuffle of short rows; texts and ids don't reach it.

    Null and empty texts are one id long (``end_id``). Repeated rows are packed as often as they come;
    null ids stay null. Ties in length keep the order of their rows. An empty table gives no rows.
    """
    groups = max(1, -(-df.count() // group_docs))
    cut = cut_documents(df, path, capacity, end_id, groups, text, keep)
    out = [f for f in cut.schema.fields if f.name != "group"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out) + ", sequence_id bigint, offset bigint"
    columns = [f.name for f in out]

    def pack(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "ids_crc32", *keep, "start"], ascending=False, kind="stable")
        bins, offsets = first_fit_decreasing(pieces["length"].to_numpy(), capacity)
        placed = pieces[columns].copy()
        placed["sequence_id"] = (int(key[0]) << LOCAL_BITS) + bins
        placed["offset"] = offsets
        return placed

    return cut.groupBy("group").applyInPandas(pack, schema)


def padding_share(pieces: DataFrame, capacity: int = 2048) -> Column:
    """An aggregate over packed pieces: the share of padding in all sequences."""
    slots = F.count_distinct("sequence_id") * F.lit(capacity)
    return (1 - F.sum("length") / slots).alias("padding_share")
