"""Operator 2: documents whose word n-gram sets have a high Jaccard similarity, by prefix filtering.

Rows are reduced to classes of equal n-gram sets. Each class gives its rarest n-grams, by a count sketch over
all documents, as its prefix; two sets that are similar enough share one. Pairs from rare n-grams pass the
length, positional and suffix filters and are verified with whole sets. N-grams of many classes are
worked off in blocks that hold the sets themselves. Links are joined to components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scale import broadcast_if_small
from .common import stored
from .components import connected_components
from .textcodes import Words, combine, each_slice

# Counters of the sketch that orders n-grams by rarity: 2**21 of 4 bytes, whatever the corpus.
SKETCH_BITS = 21
CHUNK_BITS = 15
# Partial sketches summed in one go.
FAN_IN = 256
# Classes that may share an n-gram before its pairs are worked off in blocks.
PAIR_CLASSES = 32
# Classes on either side of a block.
BLOCK_CLASSES = 256
# Class numbers are broadcast up to this many rows (within the usual bytes).
BROADCAST_CLASSES = 1_000_000


@dataclass(frozen=True)
class Similarity:
    """``percent`` of 100: the least share of common n-grams in the union; ``words`` in an n-gram."""

    words: int = 5
    percent: int = 80

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """How many n-grams of a set must be looked at so that no similar set is missed."""
        return n - (self.percent * n + 99) // 100 + 1

    def sizes_fit(self, a: Column, b: Column) -> Column:
        return 100 * F.least(a, b) >= self.percent * F.greatest(a, b)

    def enough(self, common: Column, a: Column, b: Column) -> Column:
        """Whether ``common`` n-grams of sets of sizes ``a`` and ``b`` make them similar."""
        return (100 + self.percent) * common >= self.percent * (a + b)


def ngram_sets(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner and code of the distinct n-grams of each text, by owner and code; a shorter text is one n-gram, an empty one none."""
    codes, owner, counts = found.codes, found.owner, found.counts
    owners, grams = [], []
    if len(codes) >= k:
        whole = owner[: len(codes) - k + 1] == owner[k - 1 :]
        grams.append(combine([codes[i : len(codes) - k + 1 + i] for i in range(k)])[whole])
        owners.append(owner[: len(codes) - k + 1][whole])
    for size in range(1, k):
        texts = np.flatnonzero(counts == size)
        if len(texts):
            first = found.bounds[texts]
            grams.append(combine([np.full(len(texts), size, dtype=np.uint64), *(codes[first + i] for i in range(size))]))
            owners.append(texts)
    if not grams:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    o, g = np.concatenate(owners), np.concatenate(grams)
    order = np.lexsort((g, o))
    o, g = o[order], g[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (o[1:] != o[:-1]) | (g[1:] != g[:-1])
    return o[new], g[new]


def count_sketch(docs: DataFrame, words: int) -> np.ndarray:
    """How many n-grams of all documents fall on each counter; summed in a tree, so the driver gets one sketch."""
    chunks, width = 1 << (SKETCH_BITS - CHUNK_BITS), 1 << CHUNK_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(chunks * width, dtype=np.int64)
        for batch in batches:
            for _, _, found in each_slice(batch.column(0)):
                _, grams = ngram_sets(found, words)
                total += np.bincount((grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        part = TaskContext.get().partitionId() // FAN_IN
        rows = [total[c * width : (c + 1) * width] for c in range(chunks)]
        held = [c for c in range(chunks) if rows[c].any()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(held, type=pa.int32()), pa.array([part] * len(held), type=pa.int32()),
                pa.array([rows[c].astype("<u4").tobytes() for c in held], type=pa.binary()),
            ],
            names=["chunk", "part", "counts"],
        )

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, dtype=np.int64)
        for counts in rows["counts"]:
            total += np.frombuffer(counts, dtype="<u4")
        total = np.minimum(total, 0xFFFFFFFF).astype("<u4")
        return pd.DataFrame({"chunk": [key[0]], "part": [0], "counts": [total.tobytes()]})

    schema = "chunk int, part int, counts binary"
    partial = docs.mapInArrow(run, schema)
    sums = partial.groupBy("chunk", "part").applyInPandas(add, schema).groupBy("chunk").applyInPandas(add, schema)
    sketch = np.zeros((chunks, width), dtype=np.uint32)
    for row in sums.toLocalIterator():
        sketch[row["chunk"]] = np.frombuffer(row["counts"], dtype="<u4")
    return sketch.ravel()


def _rank_order(owner: np.ndarray, grams: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The order of each text's n-grams, the rarest first; ties by code. The same for all texts."""
    return np.lexsort((grams, sketch[grams >> np.uint64(64 - SKETCH_BITS)], owner))


def parity_bits(n: np.ndarray) -> np.ndarray:
    """Cells of a parity map: a power of two, at least twice the set and at least 64."""
    return 1 << np.maximum(6, np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64))


def parity_maps(owner: np.ndarray, grams: np.ndarray, n: np.ndarray) -> list[bytes]:
    """For each set, whether the number of its n-grams on each cell is odd."""
    cells = parity_bits(n)
    base = np.cumsum(cells) - cells
    at = base[owner] + (grams & (cells[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.packbits((np.bincount(at, minlength=int(cells.sum())) & 1).astype(np.uint8), bitorder="little")
    return [odd[b // 8 : (b + c) // 8].tobytes() for b, c in zip(base, cells, strict=True)]


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the n-grams in one of two sets only: the cells of differing parity, the larger map folded."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.md5(grams.tobytes(), usedforsecurity=False).digest()


def signatures(docs: DataFrame, similarity: Similarity, sketch: Broadcast) -> DataFrame:
    """``key, mark, digest, n, prefix, parity`` of every row; an empty text has a null digest and no prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            for i, j, found in each_slice(batch.column(2)):
                owner, grams = ngram_sets(found, similarity.words)
                n = np.bincount(owner, minlength=j - i)
                ends = np.concatenate([[0], np.cumsum(n)])
                digests = [_digest(grams[a:b]) if b > a else None for a, b in zip(ends, ends[1:], strict=False)]
                ranked = grams[_rank_order(owner, grams, counts)]
                take = np.where(n > 0, similarity.prefix(n), 0)
                inside = np.arange(len(grams)) - ends[owner]
                prefix = ranked[inside < take[owner]].view(np.int64)
                bounds = np.concatenate([[0], np.cumsum(take)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                        pa.array(digests, type=pa.binary()), pa.array(n.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(prefix)),
                        pa.array(parity_maps(owner, grams, n), type=pa.binary()),
                    ],
                    names=["key", "mark", "digest", "n", "prefix", "parity"],
                )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, mark bigint, digest binary, n int, prefix array<bigint>, parity binary")


def whole_sets(docs: DataFrame, similarity: Similarity, sketch: Broadcast) -> DataFrame:
    """``digest, grams`` of every row: all n-grams, the rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            for i, j, found in each_slice(batch.column(0)):
                owner, grams = ngram_sets(found, similarity.words)
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=j - i))])
                ranked = grams[_rank_order(owner, grams, counts)]
                spans = [(a, b) for a, b in zip(ends, ends[1:], strict=False) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_digest(grams[a:b]) for a, b in spans], type=pa.binary()),
                        pa.array([ranked[a:b].tobytes() for a, b in spans], type=pa.binary()),
                    ],
                    names=["digest", "grams"],
                )

    return docs.mapInArrow(run, "digest binary, grams binary")


def rare_pairs(entries: DataFrame, similarity: Similarity) -> DataFrame:
    """Distinct pairs of classes that share a rare prefix n-gram and pass the length and positional filters."""
    a = entries.select("token", *[F.col(c).alias(f"{c}_a") for c in ("cls", "n", "pos")])
    b = entries.select("token", *[F.col(c).alias(f"{c}_b") for c in ("cls", "n", "pos")])
    n_a, n_b, i, j = F.col("n_a"), F.col("n_b"), F.col("pos_a"), F.col("pos_b")
    most = F.least(i, j) + 1 + F.least(n_a - i - 1, n_b - j - 1)
    joined = a.join(b, "token").where((F.col("cls_a") < F.col("cls_b")) & similarity.sizes_fit(n_a, n_b) & similarity.enough(most, n_a, n_b))
    return joined.select("cls_a", "cls_b", "n_a", "n_b").distinct()


def _suffix_filter(pairs: DataFrame, parities: DataFrame, similarity: Similarity) -> DataFrame:
    """Pairs whose parity maps allow enough common n-grams: sets that differ in ``d`` have ``(a + b - d) / 2`` in common."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            apart = np.array([least_difference(x, y) for x, y in zip(rows["parity_a"], rows["parity_b"], strict=True)], dtype=np.int64)
            sizes = (rows["n_a"] + rows["n_b"]).to_numpy(np.int64)
            fit = (100 + similarity.percent) * (sizes - apart) >= 2 * similarity.percent * sizes
            yield rows.loc[fit, ["cls_a", "cls_b", "n_a", "n_b"]]

    for side in "ab":
        pairs = pairs.join(parities.select(F.col("cls").alias(f"cls_{side}"), F.col("parity").alias(f"parity_{side}")), f"cls_{side}")
    return pairs.select("cls_a", "cls_b", "n_a", "n_b", "parity_a", "parity_b").mapInPandas(run, "cls_a bigint, cls_b bigint, n_a int, n_b int")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def verified_pairs(pairs: DataFrame, sets: DataFrame, similarity: Similarity) -> DataFrame:
    """Links ``(a, b)``: each pair is compared once, by its whole sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            links = []
            for r in rows.itertuples(index=False):
                x, y = (np.sort(np.frombuffer(g, dtype=np.uint64)) for g in (r.grams_a, r.grams_b))
                if (100 + similarity.percent) * _common(x, y) >= similarity.percent * (len(x) + len(y)):
                    links.append((r.cls_a, r.cls_b))
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    for side in "ab":
        pairs = pairs.join(sets.select(F.col("cls").alias(f"cls_{side}"), F.col("grams").alias(f"grams_{side}")), f"cls_{side}")
    return pairs.select("cls_a", "cls_b", "grams_a", "grams_b").mapInPandas(run, "a bigint, b bigint")


class Forest:
    """Union-find over places."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def block_links(rows: pd.DataFrame, token: int, inner: bool, similarity: Similarity) -> pd.DataFrame:
    """A spanning forest of the links between two chunks (or inside one) of the classes that share ``token``.

    A pair belongs to the first prefix n-gram both have, so other blocks leave it alone. Pairs already
    connected in this block are not compared.
    """
    token = np.int64(token).view(np.uint64)
    ranked = [np.frombuffer(g, dtype=np.uint64) for g in rows["grams"]]
    sizes = np.array([len(g) for g in ranked], dtype=np.int64)
    heads = [g[:p] for g, p in zip(ranked, similarity.prefix(sizes), strict=True)]
    whole = [np.sort(g) for g in ranked]
    forest, links = Forest(len(rows)), []
    side, number = rows["chunk"].to_numpy(), rows["cls"].to_numpy()
    left = np.flatnonzero(side == side.min())
    right = left if inner else np.flatnonzero(side == side.max())
    pool = np.concatenate([heads[i] for i in right])
    owner = np.repeat(np.arange(len(right)), [len(heads[i]) for i in right])
    order = np.argsort(pool, kind="stable")
    pool, owner = pool[order], owner[order]
    for x in left:
        before = heads[x][: int(np.flatnonzero(heads[x] == token)[0])]
        lo, hi = np.searchsorted(pool, before, side="left"), np.searchsorted(pool, before, side="right")
        earlier = np.zeros(len(right), dtype=bool)
        for a, b in zip(lo, hi, strict=True):
            earlier[owner[a:b]] = True
        n = sizes[x]
        fit = ~earlier & (100 * np.minimum(n, sizes[right]) >= similarity.percent * np.maximum(n, sizes[right]))
        if inner:
            fit &= right > x
        for y in right[fit]:
            if number[x] == number[y] or forest.root(x) == forest.root(y):
                continue
            if (100 + similarity.percent) * _common(whole[x], whole[y]) >= similarity.percent * (n + sizes[y]):
                forest.up[forest.root(x)] = forest.root(y)
                links.append((number[x], number[y]))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def frequent_links(entries: DataFrame, sets: DataFrame, similarity: Similarity) -> DataFrame:
    """Links among classes that share a frequent prefix n-gram, in blocks of two chunks of at most about ``BLOCK_CLASSES``.

    Chunks go by a hash of the class; their number follows that of the classes, so no task sees a whole n-gram.
    """
    chunks = F.ceil(F.col("df") / BLOCK_CLASSES).cast("int")
    own = F.pmod(F.xxhash64("cls"), chunks).cast("int")
    cut = entries.select("token", "cls", own.alias("chunk"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
    placed = cut.select("token", "cls", "chunk", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if key[1] != key[2] and rows["chunk"].nunique() < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        return block_links(rows, key[0], key[1] == key[2], similarity)

    held = placed.join(sets.select("cls", "grams"), "cls")
    return held.groupBy("token", "lo", "hi").applyInPandas(run, "a bigint, b bigint")


def near_duplicate_groups(docs: DataFrame, similarity: Similarity, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, mark, n_shingles, component_id, group`` of every row; ``mark`` is a 64-bit hash of the text.

    ``group`` numbers the groups of several rows; it is null for a row that is alone. A component is what links reach; its id is the smallest key in it. Rows with equal sets are one class, so copies
    are never paired. A text of fewer words than an n-gram is one n-gram; a null text or one without words has
    none and stays alone. Null keys don't name a component unless it has no other. Repeated rows get equal results.
    An empty table gives no rows. Texts are taken whole, whatever their length, in slices of bounded size; only the two named columns are
    read, so others may have any name.
    """
    texts = docs.select(F.col(f"`{text}`").alias("text"))
    sketch = docs.sparkSession.sparkContext.broadcast(count_sketch(texts, similarity.words))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), F.col(f"`{text}`").alias("text"))
    signed = stored(signatures(rows, similarity, sketch).withColumn("row", F.monotonically_increasing_id()), "ngram-signatures")

    found = signed.where(F.col("digest").isNotNull())
    classes = found.groupBy("digest").agg(F.min("row").alias("cls"), F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes, "ngram-classes")
    first = broadcast_if_small(classes.select(F.col("cls").alias("row")), rows=BROADCAST_CLASSES)
    kept = found.join(first, "row", "left_semi")
    every = kept.select(F.col("row").alias("cls"), "n", F.posexplode("prefix").alias("pos", "token"))
    shared = every.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    entries = stored(every.join(shared, "token").select("token", "cls", "n", "pos", "df"), "ngram-entries")

    rare, frequent = entries.where(F.col("df") <= PAIR_CLASSES), entries.where(F.col("df") > PAIR_CLASSES)
    pairs = stored(rare_pairs(rare, similarity), "ngram-pairs")
    paired = pairs.select(F.col("cls_a").alias("row")).unionByName(pairs.select(F.col("cls_b").alias("row"))).distinct()
    parities = found.join(broadcast_if_small(paired, rows=BROADCAST_CLASSES), "row", "left_semi").select(F.col("row").alias("cls"), "parity")
    close = stored(_suffix_filter(pairs, parities, similarity), "ngram-close")

    asked = close.select(F.col("cls_a").alias("row")).unionByName(close.select(F.col("cls_b").alias("row")))
    asked = asked.unionByName(frequent.select(F.col("cls").alias("row"))).distinct()
    named = stored(found.select("row", "key", "mark", "digest").join(asked, "row", "left_semi"), "ngram-asked")
    origin = broadcast_if_small(named.select("key", "mark").distinct(), rows=BROADCAST_CLASSES)
    again = rows.join(origin, rows["key"].eqNullSafe(origin["key"]) & rows["mark"].eqNullSafe(origin["mark"]), "left_semi")
    sets = whole_sets(again.select("text"), similarity, sketch).join(named.select("digest", F.col("row").alias("cls")), "digest")
    sets = stored(sets.select("cls", "grams").dropDuplicates(["cls"]), "ngram-sets")
    links = verified_pairs(close, sets, similarity).unionByName(frequent_links(frequent, sets, similarity))

    roots = connected_components(links)
    grouped = classes.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
    reached = grouped.where("root is not null").groupBy("root").agg(F.min("least").alias("reached"))
    several = grouped.where("root is not null or copies > 1").join(reached, "root", "left")
    several = several.select("digest", F.coalesce("reached", "least").alias("component"), F.coalesce("root", "cls").alias("group"))
    names = stored(several, "ngram-components")
    named_rows = signed.select("key", "mark", "digest", "n").join(broadcast_if_small(names, rows=BROADCAST_CLASSES), "digest", "left")
    return named_rows.select(
        F.col("key").alias(key), "mark", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component", "key").alias("component_id"), "group"
    )


def link_documents(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    return near_duplicate_groups(docs, similarity).drop("mark", "group")


def keep_one_of_each(docs: DataFrame, similarity: Similarity, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of one document of each group: the one with the smallest key, and of equal rows one. Rows alone stay.

    Texts don't reach a shuffle unless rows are repeated or the rows to drop exceed the broadcast bound.
    """
    groups = stored(near_duplicate_groups(docs, similarity, key, text).select(F.col(key).alias("_key"), "mark", "group"), "near-duplicates")
    grouped = groups.where(F.col("group").isNotNull()).groupBy("_key", "mark", "group").agg(F.count(F.lit(1)).alias("rows"))
    order = F.struct(F.col("_key").isNull().alias("n"), F.col("_key").alias("k"), F.col("mark").alias("m"))
    best = grouped.groupBy("group").agg(F.min(order).alias("best"))
    judged = grouped.join(best, "group").select("_key", "mark", "rows", (order == F.col("best")).alias("kept"))
    judged = stored(judged.where(~F.col("kept") | (F.col("rows") > 1)), "near-duplicates-judged")

    def among(marked: DataFrame) -> tuple[DataFrame, Column]:
        side = broadcast_if_small(marked.select("_key", "mark"), rows=BROADCAST_CLASSES)
        return side, docs[key].eqNullSafe(side["_key"]) & (F.xxhash64(docs[text]) == side["mark"])

    dropped, is_dropped = among(judged)
    once = docs.join(dropped, is_dropped, "left_anti")
    repeated = judged.where("kept")
    if repeated.isEmpty():
        return once
    several, is_several = among(repeated)
    return once.unionByName(docs.join(several, is_several, "left_semi").dropDuplicates([key, text]))
