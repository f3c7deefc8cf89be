"""Paging, samples, picks and unique names: the window-shaped work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scale import HOT_ROWS, broadcast_if_small, global_index, rank_within
from ..session import materialise


def assign_pages(
    items: DataFrame, keys: Sequence[str], order: Sequence[Column], page_size: int, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Number the key-ordered rows of each list and cut them into pages of ``page_size``."""
    ranked = rank_within(items, keys, order, "row_no", hot_rows)
    return ranked.withColumn("page_no", F.ceil(F.col("row_no") / page_size).cast("bigint"))


def page_progress(
    paged: DataFrame, keys: Sequence[str], id_column: str, totals: DataFrame | None = None
) -> DataFrame:
    """One row per page: rows, checkpoint id, rows written so far and, with totals, percent."""
    pages = paged.groupBy(*keys, "page_no").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(id_column).alias("checkpoint_id"),
        F.max("row_no").alias("written"),
    )
    if totals is None:
        return pages
    share = F.when(F.col("item_count") > 0, F.bround(F.col("written") * 100 / F.col("item_count")).cast("int"))
    return pages.join(totals.select(*keys, "item_count"), list(keys), "left").withColumn("percent", share)


def find_stalled_pages(pages: DataFrame, keys: Sequence[str], start: int = 0) -> DataFrame:
    """First page of each list that does not advance past the page before it.

    Reads ``page_no`` and ``max_id``. The previous page comes from an equi-join on
    the page number, so one very long list spreads over all tasks.
    """
    before = pages.select(*keys, (F.col("page_no") + 1).alias("page_no"), F.col("max_id").alias("previous_id"))
    joined = pages.join(before, [*keys, "page_no"], "left")
    previous = F.coalesce("previous_id", F.lit(start))
    stalled = joined.filter(F.col("max_id").isNull() | (F.col("max_id") <= previous))
    return stalled.groupBy(*keys).agg(F.min("page_no").alias("stalled_page"))


def accepted_pages(pages: DataFrame, keys: Sequence[str], start: int = 0, keep_stalled: bool = False) -> DataFrame:
    """Pages before the stall; ``keep_stalled`` accepts the stalled page itself too."""
    stalls = broadcast_if_small(find_stalled_pages(pages, keys, start))
    limit = F.col("stalled_page") + (1 if keep_stalled else 0)
    joined = pages.join(stalls, list(keys), "left")
    return joined.filter(F.col("stalled_page").isNull() | (F.col("page_no") < limit)).drop("stalled_page")


# Spark keeps the first rows of each group before the shuffle up to this rank by default.
MAP_SIDE_RANKS = 1000


def stratified_pick(files: DataFrame, kind: str, order: str, n: int) -> DataFrame:
    """Round robin over the kinds in first-seen order, ``n`` rows in all.

    A task passes on the first ``n`` rows of each kind it has, so what is shuffled follows ``n``, not the table. For more than
    ``MAP_SIDE_RANKS`` rows a large kind is ranked over many tasks.
    """
    first = files.groupBy(kind).agg(F.min(order).alias("first_seen"))
    if n <= MAP_SIDE_RANKS:
        turns = files.withColumn("turn", F.row_number().over(Window.partitionBy(kind).orderBy(order)))
    else:
        turns = rank_within(files, [kind], [F.col(order)], "turn")
    return turns.filter(F.col("turn") <= n).join(first, kind).orderBy("turn", "first_seen").limit(n)


def spread_sample(rows: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """At most ``n`` rows, every step-th one along the order."""
    total = rows.count()
    step = max(1, total // max(1, n))
    indexed = global_index(rows, order, "_idx")
    return indexed.filter((F.col("_idx") % step == 0) & (F.col("_idx") < step * n)).drop("_idx")


def unique_file_names(
    files: DataFrame, item: str, name: str, order: str, output: str = "unique_name", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Further equal names on an item become ``base(1).ext``, ``base(2).ext`` and so on.

    Numbers already used by original names are skipped: the d-th copy takes the
    d-th free number, which is its rank among copies and used numbers together.
    """
    # Three rankings and the result read it.
    ranked = materialise(rank_within(files, [item, name], [F.col(order)], "_copy", hot_rows))
    firsts = ranked.filter(F.col("_copy") == 1)
    pattern = r"(?s)^(.*)\((\d{1,9})\)(\.[^.]*)?$"
    used = firsts.select(
        item,
        F.concat(F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 3)).alias(name),
        F.regexp_extract(name, pattern, 2).try_cast("bigint").alias("number"),
    ).filter(F.col("number") > 0)
    copies = ranked.filter(F.col("_copy") > 1)
    used = used.join(copies.select(item, name).distinct(), [item, name], "left_semi").distinct()
    used = rank_within(used, [item, name], [F.col("number")], "_j", hot_rows)
    events = used.select(
        item, name, (F.col("number") - F.col("_j") + 1).alias("value"), F.lit(0).alias("side"), F.lit(None).cast("bigint").alias("_copy")
    ).unionByName(
        copies.select(item, name, (F.col("_copy") - 1).alias("value"), F.lit(1).alias("side"), "_copy")
    )
    numbered = rank_within(events, [item, name], [F.col("value"), F.col("side")], "_number", hot_rows)
    numbered = numbered.filter(F.col("side") == 1).select(item, name, "_copy", "_number")
    dotted = F.col(name).contains(".")
    ext = F.when(dotted, F.concat(F.lit("."), F.substring_index(name, ".", -1))).otherwise("")
    base = F.substr(F.col(name), F.lit(1), F.length(name) - F.length(ext))
    numbered_name = F.concat(base, F.lit("("), F.col("_number").cast("string"), F.lit(")"), ext)
    joined = ranked.join(numbered, [item, name, "_copy"], "left")
    return joined.select(
        *files.columns, F.when(F.col("_number").isNull(), F.col(name)).otherwise(numbered_name).alias(output)
    )


def top_lists(stats: DataFrame, k: int = 40, column: str = "items") -> DataFrame:
    return stats.orderBy(F.desc(column), "list_guid").limit(k)


def limit_new_rows(paged: DataFrame, n: int, page_size: int) -> DataFrame:
    """Whole pages until at least ``n`` rows are in; the last page may exceed ``n``."""
    last = max(1, -(-n // page_size))
    return paged.filter(F.col("page_no") <= last)
