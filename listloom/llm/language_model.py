"""Operator 3: an interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by workers.

Words are 64-bit codes. The vocabulary is one sorted array of codes, cut into shards by range; a
word's number is its place in it. Bigrams are sorted by context and word: for each context the numbers
of the words that follow it, with their counts. All arrays are files in the shared folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import id_crc
from .textcodes import Words, each_slice

# Text bytes of a shard of the model; the number of shards follows the corpus.
SHARD_BYTES = 16 << 20
# Distinct keys a counting task holds before it hands them on.
HELD_KEYS = 4_000_000
# The code of the token that ends each text.
END = np.uint64(0x1D5C_0E2F_9A3B_7741)

STATS = -1


class Files:
    """Arrays by name below a folder that all executors reach; a repeated task replaces its files whole."""

    def __init__(self, folder: str) -> None:
        self.fs, self.base = pafs.FileSystem.from_uri(folder)

    def write(self, name: str, array: np.ndarray, task: str) -> None:
        self.fs.create_dir(self.base, recursive=True)
        part = f"{self.base}/.{name}-{task}"
        with self.fs.open_output_stream(part) as out:
            out.write(np.ascontiguousarray(array).tobytes())
        self.fs.move(part, f"{self.base}/{name}")

    def read(self, name: str, dtype: str) -> np.ndarray:
        path = f"{self.base}/{name}"
        if isinstance(self.fs, pafs.LocalFileSystem):
            return np.memmap(path, dtype=dtype, mode="r") if self.fs.get_file_info(path).size else np.empty(0, dtype=dtype)
        with self.fs.open_input_file(path) as source:
            return np.frombuffer(source.read(), dtype=dtype)


class Tally:
    """Sorted distinct keys with counts, handed on when there are many."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> bool:
        found = np.unique(keys, return_counts=True)
        self.parts.append(found)
        self.size += len(found[0])
        return self.size > HELD_KEYS

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = merged(self.parts)
        self.parts, self.size = [], 0
        return out


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several tallies with their summed counts."""
    if not parts:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts]).astype(np.int64)
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _pack(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys, upper halves first, which compress well."""
    return (keys >> np.uint64(32)).astype("<u4").tobytes() + keys.astype("<u4").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    halves = np.frombuffer(data, dtype="<u4")
    n = len(halves) // 2
    return (halves[:n].astype(np.uint64) << np.uint64(32)) | halves[n:]


BLOBS = "shard int, keys binary, counts binary"


def _blobs(keys: np.ndarray, counts: np.ndarray, lows: np.ndarray) -> pa.RecordBatch:
    """One row for each shard that has keys; ``lows`` are the smallest keys of the shards."""
    ends = np.append(np.searchsorted(keys, lows), len(keys))
    held = [s for s in range(len(lows)) if ends[s + 1] > ends[s]]
    spans = [slice(ends[s], ends[s + 1]) for s in held]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(held, type=pa.int32()),
            pa.array([_pack(keys[s]) for s in spans], type=pa.binary()),
            pa.array([counts[s].astype("<u4").tobytes() for s in spans], type=pa.binary()),
        ],
        names=["shard", "keys", "counts"],
    )


def _gather(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return merged([(_unpack(k), np.frombuffer(c, dtype="<u4")) for k, c in zip(rows["keys"], rows["counts"], strict=True)])


def _tallied(texts: DataFrame, keys_of: Callable[[Words], np.ndarray], lows_of: Callable[[], np.ndarray]) -> DataFrame:
    """Blobs of the keys of all texts, counted in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, lows = Tally(), lows_of()
        for batch in batches:
            for _, _, found in each_slice(batch.column(0)):
                if tally.add(keys_of(found)):
                    yield _blobs(*tally.take(), lows)
        yield _blobs(*tally.take(), lows)

    return texts.mapInArrow(run, BLOBS)


def code_lows(shards: int) -> np.ndarray:
    return np.array([s * (1 << 64) // shards for s in range(shards)], dtype=np.uint64)


@dataclass(frozen=True)
class Vocabulary:
    """Codes and counts in shards by code range; ``starts`` are the numbers of the shards' first words."""

    folder: str
    starts: tuple[int, ...]
    tokens: int

    @property
    def size(self) -> int:
        return self.starts[-1]

    @property
    def shards(self) -> int:
        return len(self.starts) - 1

    def number_lows(self) -> np.ndarray:
        """The first word number of each range that bigrams are cut by; the last range has the text start."""
        return np.array([s * (self.size + 1) // self.shards for s in range(self.shards)], dtype=np.int64)


@cache
def _files(folder: str) -> Files:
    return Files(folder)


@cache
def _array(folder: str, name: str, dtype: str) -> np.ndarray:
    return _files(folder).read(name, dtype)


def numbers(vocabulary: Vocabulary, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers (-1: unknown) and training counts of sorted codes, shard by shard."""
    out, counts = np.full(len(codes), -1, dtype=np.int64), np.zeros(len(codes), dtype=np.int64)
    ends = np.append(np.searchsorted(codes, code_lows(vocabulary.shards)), len(codes))
    for s in range(vocabulary.shards):
        a, b = ends[s], ends[s + 1]
        known = _array(vocabulary.folder, f"codes-{s}", "<u8") if a < b and vocabulary.starts[s + 1] > vocabulary.starts[s] else ()
        if not len(known):
            continue
        at = np.searchsorted(known, codes[a:b])
        at[at == len(known)] = 0
        there = known[at] == codes[a:b]
        out[a:b][there] = at[there] + vocabulary.starts[s]
        counts[a:b][there] = _array(vocabulary.folder, f"counts-{s}", "<i8")[at[there]]
    return out, counts


def _with_ends(found: Words, values: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of all tokens, each text's closed by ``end``, and the places where texts begin."""
    texts = len(found.bounds) - 1
    out = np.empty(len(values) + texts, dtype=values.dtype)
    out[np.arange(len(values)) + found.owner] = values
    stops = found.bounds[1:] + np.arange(texts)
    out[stops] = end
    return out, found.bounds[:-1] + np.arange(texts)


class Numbered:
    """Tokens of some texts as word numbers, with their training counts and contexts."""

    def __init__(self, vocabulary: Vocabulary, found: Words) -> None:
        codes, self.begins = _with_ends(found, found.codes, END)
        distinct, place = np.unique(codes, return_inverse=True)
        number, count = numbers(vocabulary, distinct)
        self.words, self.counts = number[place], count[place]
        self.contexts = np.empty_like(self.words)
        self.contexts[1:] = self.words[:-1]
        self.contexts[self.begins] = vocabulary.size

    def keys(self) -> np.ndarray:
        return (self.contexts.astype(np.uint64) << np.uint64(32)) | self.words.astype(np.uint64)


def count_words(texts: DataFrame, folder: str, shards: int) -> Vocabulary:
    """Count all words and text ends of one text column; one shuffle of counted blobs."""

    def keys_of(found: Words) -> np.ndarray:
        return _with_ends(found, found.codes, END)[0]

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        codes, counts = _gather(rows)
        files, s = Files(folder), int(key[0])
        files.write(f"codes-{s}", codes.astype("<u8"), _attempt())
        files.write(f"counts-{s}", counts.astype("<i8"), _attempt())
        return pd.DataFrame({"shard": [s], "words": [len(codes)], "tokens": [int(counts.sum())]})

    blobs = _tallied(texts, keys_of, lambda: code_lows(shards))
    sizes = blobs.groupBy("shard").applyInPandas(write, "shard int, words bigint, tokens bigint").collect()
    words = dict.fromkeys(range(shards), 0) | {r["shard"]: r["words"] for r in sizes}
    starts = np.concatenate([[0], np.cumsum([words[s] for s in range(shards)])])
    if starts[-1] + 1 >= 1 << 32:
        raise ValueError("word numbers have 32 bits")
    return Vocabulary(folder, tuple(int(x) for x in starts), sum(r["tokens"] for r in sizes))


def _attempt() -> str:
    from pyspark import TaskContext

    return str(TaskContext.get().taskAttemptId())


def _by_count(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def count_bigrams(texts: DataFrame, vocabulary: Vocabulary) -> tuple[list[int], list[int], int]:
    """Write bigram shards, follower statistics of contexts and predecessors of words.

    Gives the counts of counts of bigrams, those of the numbers of predecessors, and the number of distinct bigrams.
    Two shuffles: counted bigrams by context range, and distinct predecessors by word range. A context's
    distinct followers, at most the vocabulary, meet in one task.
    """
    folder, lows = vocabulary.folder, vocabulary.number_lows()
    highs = np.append(lows[1:], vocabulary.size + 1)

    def write_bigrams(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        s = int(key[0])
        keys, counts = _gather(rows)
        context = (keys >> np.uint64(32)).astype(np.int64) - lows[s]
        word = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
        span = int(highs[s] - lows[s])
        files, task = Files(folder), _attempt()
        files.write(f"rows-{s}", np.concatenate([[0], np.cumsum(np.bincount(context, minlength=span))]).astype("<i8"), task)
        files.write(f"words-{s}", word, task)
        files.write(f"seen-{s}", counts.astype("<u2" if counts.max(initial=0) < 1 << 16 else "<u4"), task)
        kinds = np.stack([np.bincount(context[m], minlength=span) for m in (counts == 1, counts == 2, counts >= 3)], axis=1)
        files.write(f"kinds-{s}", kinds.astype("<u4"), task)
        follower, before = np.unique(word, return_counts=True)
        ends = np.append(np.searchsorted(follower, lows), len(follower))
        held = [t for t in range(len(lows)) if ends[t + 1] > ends[t]]
        stats = json.dumps(_by_count(counts)).encode()
        return pd.DataFrame({
            "shard": [*held, STATS],
            "keys": [*(follower[ends[t] : ends[t + 1]].tobytes() for t in held), b""],
            "counts": [*(before[ends[t] : ends[t + 1]].astype("<u4").tobytes() for t in held), stats],
        })

    def write_words(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        t = int(key[0])
        if t == STATS:
            n = np.sum([json.loads(c) for c in rows["counts"]], axis=0).tolist()
            return pd.DataFrame({"shard": [t], "n": [n], "total": [0]})
        before = np.zeros(int(highs[t] - lows[t]), dtype=np.int64)
        for k, c in zip(rows["keys"], rows["counts"], strict=True):
            before[np.frombuffer(k, dtype="<u4").astype(np.int64) - lows[t]] += np.frombuffer(c, dtype="<u4")
        Files(folder).write(f"before-{t}", before.astype("<u4"), _attempt())
        return pd.DataFrame({"shard": [t], "n": [_by_count(before)], "total": [int(before.sum())]})

    starts = lows.astype(np.uint64) << np.uint64(32)
    blobs = _tallied(texts, lambda found: Numbered(vocabulary, found).keys(), lambda: starts)
    distinct = blobs.groupBy("shard").applyInPandas(write_bigrams, BLOBS)
    sums = distinct.groupBy("shard").applyInPandas(write_words, "shard int, n array<bigint>, total bigint").collect()
    high = next((list(r["n"]) for r in sums if r["shard"] == STATS), [0] * 4)
    low = np.sum([r["n"] for r in sums if r["shard"] != STATS] or [[0] * 4], axis=0).tolist()
    return high, low, sum(r["total"] for r in sums)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2, and 3 or more; halves of the counts where the corpus is too small."""
    if min(n) == 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
    return tuple(float(min(max(d, 0.0), k + 1)) for k, d in enumerate(raw))


@dataclass(frozen=True)
class LanguageModel:
    vocabulary: Vocabulary
    texts: int
    high: tuple[float, float, float]
    low: tuple[float, float, float]
    low_kinds: tuple[int, int, int]
    distinct: int
    _lows: np.ndarray = field(repr=False)

    def _take(self, name: str, dtype: str, at: np.ndarray, width: int = 1) -> np.ndarray:
        """Values at sorted word numbers of a dense array cut by the number ranges."""
        out = np.zeros((len(at), width) if width > 1 else len(at), dtype=np.int64)
        ends = np.append(np.searchsorted(at, self._lows), len(at))
        for s in range(len(self._lows)):
            a, b = ends[s], ends[s + 1]
            if a < b and self._there(s):
                values = _array(self.vocabulary.folder, f"{name}-{s}", dtype)
                out[a:b] = (values.reshape(-1, width) if width > 1 else values)[at[a:b] - self._lows[s]]
        return out

    def _there(self, s: int) -> bool:
        return _exists(self.vocabulary.folder, f"words-{s}") and _exists(self.vocabulary.folder, f"before-{s}")

    def bigram_counts(self, keys: np.ndarray) -> np.ndarray:
        """Training counts of sorted bigram keys; all searches of a shard go on side by side."""
        out = np.zeros(len(keys), dtype=np.int64)
        ends = np.append(np.searchsorted(keys, self._lows.astype(np.uint64) << np.uint64(32)), len(keys))
        for s in range(len(self._lows)):
            a, b = ends[s], ends[s + 1]
            if a == b or not _exists(self.vocabulary.folder, f"words-{s}"):
                continue
            rows = _array(self.vocabulary.folder, f"rows-{s}", "<i8")
            words = _array(self.vocabulary.folder, f"words-{s}", "<u4")
            size = _size(self.vocabulary.folder, f"seen-{s}") // max(1, len(words))
            seen = _array(self.vocabulary.folder, f"seen-{s}", "<u4" if size == 4 else "<u2")
            context = (keys[a:b] >> np.uint64(32)).astype(np.int64) - self._lows[s]
            word = (keys[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            low, high = rows[context], rows[context + 1]
            stop = high.copy()
            open_ = np.flatnonzero(low < high)
            while len(open_):
                middle = (low[open_] + high[open_]) // 2
                less = words[middle] < word[open_]
                low[open_[less]] = middle[less] + 1
                high[open_[~less]] = middle[~less]
                open_ = open_[low[open_] < high[open_]]
            inside = np.flatnonzero(low < stop)
            hit = inside[words[low[inside]] == word[inside]]
            out[a:b][hit] = seen[low[hit]]
        return out

    def unigram(self, words: np.ndarray) -> np.ndarray:
        """Continuation probabilities of sorted word numbers, interpolated with the uniform distribution over the words and an unknown one."""
        before = np.zeros(len(words), dtype=np.int64)
        known = words >= 0
        before[known] = self._take("before", "<u4", words[known])
        uniform = 1.0 / (self.vocabulary.size + 1)
        if not self.distinct:
            return np.full(len(words), uniform)
        rest = float(np.dot(self.low, self.low_kinds)) / self.distinct
        return np.maximum(before - _discount(before, self.low), 0) / self.distinct + rest * uniform

    def log10(self, found: Words) -> tuple[Numbered, np.ndarray]:
        """The tokens of some texts and the log10 probability of each."""
        tokens = Numbered(self.vocabulary, found)
        distinct, place = np.unique(tokens.words, return_inverse=True)
        lower = self.unigram(distinct)[place]
        p = lower.copy()
        v = self.vocabulary
        contexts, at = np.unique(tokens.contexts, return_inverse=True)
        real = contexts >= 0
        total = np.zeros(len(contexts), dtype=np.int64)
        kinds = np.zeros((len(contexts), 3), dtype=np.int64)
        kinds[real] = self._take("kinds", "<u4", contexts[real], 3)
        first = np.zeros(len(contexts), dtype=np.int64)
        first[at] = np.arange(len(at))
        # A word's count is its count as a context: each word has one token after it.
        before = np.where(first > 0, first - 1, 0)
        total = np.where(contexts == v.size, self.texts, tokens.counts[before])
        usable = (kinds.sum(axis=1) > 0)[at]
        if usable.any():
            keys = tokens.keys()
            pairs = usable & (tokens.words >= 0)
            wanted, back = np.unique(keys[pairs], return_inverse=True)
            seen = np.zeros(len(p), dtype=np.int64)
            seen[pairs] = self.bigram_counts(wanted)[back]
            n = total[at][usable]
            rest = (kinds[at][usable] @ np.array(self.high)) / n
            s = seen[usable]
            p[usable] = np.maximum(s - _discount(s, self.high), 0) / n + rest * lower[usable]
        return tokens, np.log10(p)


@cache
def _exists(folder: str, name: str) -> bool:
    files = _files(folder)
    return files.fs.get_file_info(f"{files.base}/{name}").type == pafs.FileType.File


@cache
def _size(folder: str, name: str) -> int:
    files = _files(folder)
    return files.fs.get_file_info(f"{files.base}/{name}").size


def _discount(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *by])[np.minimum(counts, 3)]


def fit(texts: DataFrame, shard_bytes: int = SHARD_BYTES) -> LanguageModel:
    """A model of one text column; null counts as empty, every text ends with one end token.

    All texts are counted. What the driver gathers is a few numbers for each shard.
    """
    column = texts.columns[0]
    size, rows = texts.agg(F.sum(F.octet_length(column)), F.count(F.lit(1))).first()
    vocabulary = count_words(texts, scratch_path(texts.sparkSession, "language-model"), 1 + int(size or 0) // shard_bytes)
    high, low, distinct = count_bigrams(texts, vocabulary) if vocabulary.size else ([0] * 4, [0] * 4, 0)
    known = (low[0], low[1], vocabulary.size - low[0] - low[1])
    return LanguageModel(vocabulary, int(rows), discounts(high), discounts(low), known, distinct, vocabulary.number_lows())


def score(docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``n_tokens, n_known, train_tokens, base_score, score`` and ``perplexity`` of every whole text; no shuffle."""
    schema = docs.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, total = model.vocabulary.size, model.vocabulary.tokens
        for batch in batches:
            for i, j, found in each_slice(batch.column(batch.num_columns - 1)):
                tokens, logs = model.log10(found)
                n = found.counts + 1
                base = np.log10((tokens.counts + 0.1) / (total + 0.1 * (size + 1)))
                known = np.add.reduceat((tokens.counts > 0).astype(np.int64), tokens.begins)
                sums = [np.add.reduceat(x, tokens.begins) for x in (base, logs)]
                kept = [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                made = [n.astype(np.int64), known, np.full(j - i, total, dtype=np.int64), *sums, 10 ** (-sums[1] / n)]
                yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, made)], names=[*keep, *names])

    kinds = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double"
    return docs.select(*keep, F.col(f"`{text}`").alias("_text")).mapInArrow(run, f"{fields}, {kinds}")


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from the documents that aren't held out (crc32 of the id modulo 10 not 0), then score all of them.

    A null id is held out if the crc32 of the empty text says so. Null and empty texts have one token, the end. Repeated rows
    are learnt and scored as often as they come; an empty table gives no rows.
    """
    held = (id_crc(F.col(f"`{key}`")) % 10) == 0
    rows = docs.select(F.col(f"`{key}`"), held.alias("held_out"), F.col(f"`{text}`").alias("text"))
    model = fit(rows.where(~F.col("held_out")).select("text"))
    return score(rows, model, "text", (key, "held_out"))
