"""Operator 8: token counts of whole texts by a public tokenizer file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import bpe
from .textcodes import slices, text_buffers

BATCH_BYTES = 1 << 20


def count_tokens(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), limit: int = 512) -> DataFrame:
    """``keep`` columns, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of each row.

    Only lengths leave the Arrow function. Rows are put together to batches of about the same bytes, and each batch
    is one call of the tokenizer; texts over ``bpe.PIECE_CHARS`` are encoded in pieces cut in front of white space, where the
    vocabulary's split pattern always ends a piece. Rows, repeated ones too, map one to one; a null or
    empty text has 0 bytes and 0 tokens; nulls in ``keep`` stay; an empty table gives no rows. A text
    column may be among ``keep``; other columns are not read.
    """
    schema = df.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(path)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            _, offsets = text_buffers(column)
            counts = [encoder.counts(list(bpe.texts(column.slice(i, j - i)))) for i, j in slices(offsets, BATCH_BYTES)]
            n = np.concatenate(counts) if counts else np.empty(0, dtype=np.int64)
            kept = [batch.column(i) for i in range(len(keep))]
            made = [pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=[*keep, "n_bytes", "n_tokens", "over_limit"])

    narrow = df.select(*keep, df[text].alias("_text"))
    return narrow.mapInArrow(run, f"{fields}, n_bytes bigint, n_tokens bigint, over_limit boolean")
