"""Operator 4: benchmark passages in documents by winnowing, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scale import broadcast_if_small
from .common import lower_ascii, stored

# Fixed value of the contract: what ends a word, after A-Z became a-z.
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# Words of a window, and of the k-grams the smallest hash of which stands for the window.
WINDOW = 10
GRAM = 5


def word_hashes(text: Column) -> Column:
    """64-bit hashes of a text's words in order; none for a null."""
    found = F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAKS), "")
    return F.transform(found, lambda w: F.xxhash64(w))


def _starts(words: str, length: int) -> Column:
    return F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length)).otherwise(F.array().cast("array<int>"))


def _gram(words: str, i: Column, length: int, seed: int = 0) -> Column:
    return F.xxhash64(F.lit(seed), *[F.get(words, i + k) for k in range(length)])


def _grams(words: str, length: int, seed: int = 0) -> Column:
    return F.transform(_starts(words, length), lambda i: _gram(words, i, length, seed))


def _with_marks(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """Adds ``_m``: for each window of ``window`` words the smallest hash among its ``gram``-word grams.

    Equal windows have equal marks, and neighbouring windows mostly share theirs. A shared span
    of ``window`` words or more therefore always shares a mark.
    """
    grams = rows.withColumn("_g", _grams("_w", gram))
    width = window - gram + 1
    least = F.transform(_starts("_w", window), lambda i: F.least(*[F.get("_g", i + k) for k in range(width)]))
    return grams.withColumn("_m", least).drop("_g")


def _marks(lengths: Sequence[int]) -> Column:
    """Distinct marks of a text: the winnowed ones, and whole grams of the lengths of short items."""
    short = [_grams("_w", n) for n in lengths]
    return F.array_distinct(F.concat("_m", *short)) if short else F.array_distinct("_m")


def _windows(lengths: Sequence[int], window: int) -> Column:
    """All windows as ``(start, length, mark, a, b)``; ``a`` and ``b`` are hashes with different seeds."""

    def entry(i: Column, n: int, mark: Column) -> Column:
        return F.struct(
            i.alias("start"), F.lit(n).alias("length"), mark.alias("mark"),
            _gram("_w", i, n, 1).alias("a"), _gram("_w", i, n, 2).alias("b"),
        )

    def whole(n: int) -> Column:
        return F.transform(_starts("_w", n), lambda i: entry(i, n, _gram("_w", i, n)))

    full = F.transform(_starts("_w", window), lambda i: entry(i, window, F.get("_m", i)))
    return F.concat(full, *[whole(n) for n in lengths]) if lengths else full


def benchmark_windows(benchmark: DataFrame, key: str, text: str, window: int, gram: int) -> tuple[DataFrame, list[int]]:
    """One row per distinct window with the ids of its items, and the lengths of items shorter than a window.

    An item of fewer words than a window is one window of its own length; an item without words has none.
    """
    words = benchmark.select(F.col(f"`{key}`").alias("item"), word_hashes(F.col(f"`{text}`")).alias("_w")).where(F.size("_w") > 0)
    lengths = sorted(r[0] for r in words.where(F.size("_w") < window).select(F.size("_w")).distinct().collect())
    marked = _with_marks(words, window, gram).withColumn("n", F.size("_w"))
    every = marked.select("item", "n", F.explode(_windows(lengths, window)).alias("x"))
    own = every.where((F.col("x.length") == window) | (F.col("x.length") == F.col("n")))
    grouped = own.groupBy("x.length", "x.mark", "x.a", "x.b").agg(F.collect_set("item").alias("items"))
    return stored(grouped, "benchmark-windows"), lengths


def _covered(spans: Column) -> Column:
    """Words inside the union of ``(start, length)`` spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))

    def add(state: Column, span: Column) -> Column:
        stop = F.greatest(span["start"] + span["length"], state["end"])
        fresh = stop - F.greatest(span["start"], state["end"])
        return F.struct((state["n"] + F.greatest(F.lit(0), fresh)).cast("bigint").alias("n"), stop.alias("end"))

    return F.aggregate(F.array_sort(spans), start, add, lambda s: s["n"])


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, gram: int = GRAM,
) -> DataFrame:
    """``doc_id, _text_hash, n_words, n_hit, n_items, items_sha256, contaminated, spans`` of every document.

    Marks of all documents meet the benchmark's marks; the few documents that share one are read again and
    each of their windows around a shared mark is compared with the benchmark's by 128 bits of hashes. ``spans``
    are the occurring windows as ``(start, length)`` in words, null where there are none.

    Null and empty texts have no words; null item ids hit words but are not counted among the items; repeated rows
    get equal rows. The benchmark's side is broadcast below a checked size, else both sides are shuffled. An empty
    table of documents gives no rows, an empty benchmark hits nothing. A text is taken whole, as one array of word hashes,
    whatever its length; other columns are not read and may have any name.
    """
    windows, lengths = benchmark_windows(benchmark, item_key, item_text, window, gram)
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("_t"))
    rows = rows.withColumn("_text_hash", F.xxhash64("_t")).withColumn("_w", word_hashes(F.col("_t"))).drop("_t")
    ids = ["doc_id", "_text_hash"]

    marked = _with_marks(rows, window, gram)
    base = stored(marked.select(*ids, F.size("_w").cast("bigint").alias("n_words"), _marks(lengths).alias("marks")), "document-marks")
    wanted = broadcast_if_small(windows.select("mark").distinct())
    hits = base.select(*ids, F.explode("marks").alias("mark")).join(wanted, "mark", "left_semi").select(*ids)
    candidates = broadcast_if_small(stored(hits.distinct(), "document-hits"))

    def same(left: DataFrame, right: DataFrame) -> Column:
        return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["_text_hash"] == right["_text_hash"])

    chosen = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("_t")).withColumn("_text_hash", F.xxhash64("_t"))
    chosen = chosen.join(candidates, same(chosen, candidates), "left_semi").withColumn("_w", word_hashes(F.col("_t"))).drop("_t")
    every = _with_marks(chosen, window, gram).select(*ids, F.explode(_windows(lengths, window)).alias("x")).select(*ids, "x.*")
    found = every.join(broadcast_if_small(windows), ["length", "mark", "a", "b"])
    spans = F.collect_set(F.struct("start", "length")).alias("spans")
    summed = found.groupBy(*ids).agg(spans, F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    hit = stored(summed.select(*ids, "spans", _covered(F.col("spans")).alias("n_hit"), "items"), "document-spans")

    names = F.array_sort(F.transform(F.coalesce("items", F.array().cast(hit.schema["items"].dataType)), lambda i: i.cast("string")))
    out = base.drop("marks").join(hit, same(base, hit), "left").select(base["doc_id"], base["_text_hash"], "n_words", "n_hit", "spans", names.alias("_names"))
    return out.select(
        *ids, "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.size("_names").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_names", ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        "spans",
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The counts of every document without spans."""
    return find_overlaps(docs, benchmark).drop("spans", "_text_hash")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of the documents that share no window with the benchmark."""
    bad = find_overlaps(docs, benchmark, key, text).where("contaminated").select(F.col("doc_id").alias("_id"), "_text_hash").distinct()
    bad = broadcast_if_small(stored(bad, "contaminated"))
    same = docs[key].eqNullSafe(bad["_id"]) & (F.xxhash64(docs[text]) == bad["_text_hash"])
    return docs.join(bad, same, "left_anti")
