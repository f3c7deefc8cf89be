"""Building blocks that keep hot keys and small tables under control."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .session import materialise, store

# A key with more rows than this is ranked over many tasks instead of one.
HOT_ROWS = 1_000_000
# A table is only hinted for broadcast below both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Hint ``df`` for broadcast when its measured rows and bytes are within bounds.

    Beyond the bounds ``df`` comes back as it is and the join shuffles, with skewed
    partitions split at run time.
    """
    width = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    seen = df.select(width.alias("w")).limit(rows + 1).agg(F.count(F.lit(1)), F.sum("w")).first()
    return F.broadcast(df) if seen[0] <= rows and (seen[1] or 0) <= size else df


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


# A row's place is its partition in front of these bits, which hold its number in the partition.
_PLACE_BITS = 33


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows dealt by ranges of ``order``, with ``_place`` ascending inside a partition and ``_part``.

    Stored, because numbers and what is counted from them must see the same partition boundaries.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    return store(ranged, "ranked").withColumn("_part", F.shiftright("_place", _PLACE_BITS))


def _rank_by_range(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Rank by range partition plus offset, so no key has to fit one task.

    The rows are shuffled once and sorted where they land; their places already number them, so what is left is a join with
    one row for each partition and key, at most partitions + keys.
    """
    tagged = _placed(df, [*[F.col(k) for k in keys], *order])
    runs = tagged.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_size"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    own = [*keys, "_part"]
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(own)]
    starts = broadcast_if_small(materialise(runs.select(*named, (before - F.col("_first") + 1).alias("_shift"))))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(own)])
    return tagged.join(starts, same).select(*df.columns, (F.col("_place") + F.col("_shift")).cast("bigint").alias(name))


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "rank",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """1-based position of each row within its key.

    Keys are counted first (a map-side combined aggregate). Keys up to
    ``hot_rows`` use a window; larger ones are range partitioned on key and order.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    plain = df.withColumn(name, F.row_number().over(window).cast("bigint"))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    hot = materialise(sizes.drop("_n"))
    if hot.isEmpty():
        return plain
    hot = broadcast_if_small(hot)
    cold_rows = df.join(hot, same_keys(df, hot, keys), "left_anti")
    hot_part = df.join(hot, same_keys(df, hot, keys), "left_semi")
    cold = cold_rows.withColumn(name, F.row_number().over(window).cast("bigint"))
    return cold.unionByName(_rank_by_range(hot_part, keys, order, name))


def global_index(df: DataFrame, order: Sequence[Column], name: str = "idx") -> DataFrame:
    """0-based position in a total order, without sorting in one task."""
    tagged = _placed(df, order)
    sizes = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"), F.min("_place").alias("_first"))
    # One row per partition: this window sees the partition count, never the data.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    starts = broadcast_if_small(materialise(sizes.select("_part", (before - F.col("_first")).alias("_shift"))))
    joined = tagged.join(starts, "_part")
    return joined.select(*df.columns, (F.col("_place") + F.col("_shift")).cast("bigint").alias(name))


def collect_in_parts(
    df: DataFrame, keys: Sequence[str], rank: str, value: Column, name: str, part_rows: int
) -> DataFrame:
    """Ordered arrays per key in parts of at most ``part_rows`` elements.

    ``part`` is 0 for a key that fits one array; nothing is cut off.
    """
    part = F.floor((F.col(rank) - 1) / part_rows).cast("bigint")
    entry = F.struct(F.col(rank).alias("_r"), value.alias("_v"))
    grouped = df.withColumn("part", part).groupBy(*keys, "part")
    return grouped.agg(F.array_sort(F.collect_list(entry)).alias("_e")).select(
        *keys, "part", F.col("_e._v").alias(name)
    )
