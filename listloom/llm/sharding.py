"""Operator 10: shards by weighted rendezvous hashing of a stable key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# Places inside a shard are numbered bucket by bucket, so no task sorts a whole shard.
BUCKET_ROWS = 50_000


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard with the highest score for ``key``; a shard's share follows its weight.

    A score depends on the key, the shard and its weight only. A further shard therefore takes
    rows from all others and moves none between them; a shard left out gives its rows away
    and moves no others. Ties go to the larger shard number.
    """
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("rendezvous hashing needs shards of positive weight")

    def score(shard: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(f"shard-{shard}"), key), 11)
        unit = (bits.cast("double") + 0.5) / float(1 << 53)
        return F.struct((F.lit(-float(weight)) / F.ln(unit)).alias("score"), F.lit(shard).alias("shard"))

    scores = [score(s, w) for s, w in weights.items()]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return best["shard"]


def assign_shards(df: DataFrame, key: str, weights: Mapping[int, float], grown: Mapping[int, float] | None = None) -> DataFrame:
    """Adds ``shard`` and, for another set of shards, ``grown_shard``; narrow, no shuffle.

    A null key is a key of its own. Repeated keys share a shard. Existing columns of these names are replaced.
    """
    text = F.coalesce(F.concat(F.lit("k"), F.col(f"`{key}`").cast("string")), F.lit("null"))
    cols = {"shard": rendezvous(text, weights)}
    if grown is not None:
        cols["grown_shard"] = rendezvous(text, grown)
    return df.withColumns(cols)


def number_slots(df: DataFrame, key: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds ``slot``: 0, 1, 2 ... without a gap in each shard.

    Rows are numbered inside hash buckets of about ``bucket_rows`` rows and shifted by the sizes of
    the buckets before; the number of buckets follows the number of rows. The rows are stored
    first because numbers and sizes must see the same rows. Ties (rows equal in all columns) take
    any order among themselves.
    """
    rows = stored(df, "shard-rows")
    buckets = 1 + rows.count() // bucket_rows
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(buckets))
    placed = rows.withColumn("_bucket", spread)
    sizes = placed.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = Window.partitionBy("shard", "_bucket").orderBy(F.col(f"`{key}`"))
    numbered = placed.withColumn("_local", F.row_number().over(local) - 1).join(starts, ["shard", "_bucket"])
    return numbered.select(*df.columns, (F.col("_start") + F.col("_local")).cast("bigint").alias("slot"))


def shard_documents(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` of every row, shards of equal weight.

    Law ``key``: the key and the number of shards decide. ``size`` is the text's UTF-8 bytes plus 8, a null text
    has none and the crc32 of the empty text. Texts are read once, whole, and don't reach a shuffle. An empty table
    gives no rows; columns other than the two named ones are not read.
    """
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    narrow = df.select(
        F.col(f"`{key}`"),
        (F.octet_length(raw) + 8).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    equal = {s: 1.0 for s in range(shards)}
    placed = assign_shards(narrow, key, equal, equal | {shards: 1.0})
    return number_slots(placed, key).select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
