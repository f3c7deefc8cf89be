"""Operator 5: URL verdicts by rules, else by the ratio of two character language models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored
from .textcodes import combine, mix, slices, text_buffers

# Bounds of the training sample: rows for each verdict, and bytes of a URL that is learnt from.
SAMPLE_ROWS = 20_000
SAMPLE_URL_BYTES = 2048
# The longest context in bytes.
ORDER = 5

PAD, STOP, SYMBOLS = 256, 257, 258


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """``rule("block", "example.org/es/")``: the host ends at the first slash."""
    host, slash, rest = text.partition("/")
    return Rule(verdict, host, slash + rest)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a URL without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return lower_ascii(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def apply_rules(urls: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """Adds ``host, path, rule, rule_verdict``; the longest fitting rule wins, null where none fits."""
    host, path = url_parts(F.col(f"`{url}`"))
    parsed = urls.withColumns({"host": host, "path": path})
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        at_host = (F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")
        fits = at_host & F.col("path").startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.text)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return parsed.withColumns({"rule": name, "rule_verdict": verdict})


def grams(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """For every symbol of every URL (bytes, then a stop): its row, and for contexts of 0 to ``order`` bytes
    the codes of the context and of the context with the symbol."""
    sizes = np.diff(offsets)
    rows = len(sizes)
    starts = np.concatenate([[0], np.cumsum(sizes + order + 1)])[:-1]
    symbols = np.full(int(sizes.sum()) + rows * (order + 1), PAD, dtype=np.uint64)
    owner = np.repeat(np.arange(rows), sizes)
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[starts[owner] + order + inside] = data[int(offsets[0]) : int(offsets[-1])]
    symbols[starts + order + sizes] = STOP
    real = np.ones(len(symbols), dtype=bool)
    real[(starts[:, None] + np.arange(order)).ravel()] = False
    at = np.flatnonzero(real)
    row = np.repeat(np.arange(rows), sizes + 1)
    with_symbol, contexts = [mix(symbols[at])], [np.zeros(len(at), dtype=np.uint64)]
    for k in range(1, order + 1):
        older = symbols[at - k]
        contexts.append(combine([contexts[-1], older + np.uint64(1)]))
        with_symbol.append(combine([contexts[-1], symbols[at]]))
    return row, contexts, with_symbol


@dataclass(frozen=True)
class Markov:
    """Counts of one class; for each context length sorted codes with counts, and contexts with distinct followers."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def log_probability(self, row: np.ndarray, contexts: list[np.ndarray], with_symbol: list[np.ndarray], rows: int) -> np.ndarray:
        """Witten-Bell smoothing from the uniform distribution up to the longest context that was seen."""
        p = np.full(len(row), 1.0 / SYMBOLS)
        for k, (gram, context) in enumerate(zip(self.grams, self.contexts, strict=True)):
            seen, total, kinds = _look_up(gram[0], with_symbol[k]), *(_look_up(context[0], contexts[k], v) for v in context[1:])
            n = np.where(seen >= 0, gram[1][seen] if len(gram[1]) else 0, 0)
            known = total > 0
            p[known] = (n[known] + kinds[known] * p[known]) / (total[known] + kinds[known])
        return np.bincount(row, np.log(p), rows)


def _look_up(codes: np.ndarray, wanted: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """Places of ``wanted`` in sorted ``codes`` (-1: not there), or the values there (0: not there)."""
    if not len(codes):
        return np.full(len(wanted), -1 if values is None else 0)
    at = np.searchsorted(codes, wanted)
    at[at == len(codes)] = 0
    there = codes[at] == wanted
    return np.where(there, at, -1) if values is None else np.where(there, values[at], 0)


@dataclass(frozen=True)
class UrlModel:
    accepted: Markov
    rejected: Markov
    slope: float
    shift: float

    def differences(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log-likelihood difference by symbol; positive: rather accepted."""
        row, contexts, with_symbol = grams(data, offsets)
        n = len(offsets) - 1
        gap = self.accepted.log_probability(row, contexts, with_symbol, n) - self.rejected.log_probability(row, contexts, with_symbol, n)
        return gap / (np.diff(offsets) + 1)

    def acceptance(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Calibrated probability of acceptance, both classes taken as equally common."""
        y = self.slope * self.differences(data, offsets) + self.shift
        return 1 / (1 + np.exp(-np.clip(y, -500, 500)))


def _count(sample: DataFrame) -> DataFrame:
    """``accept, level, kind, code, context, n`` over the training URLs, combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            accept = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = text_buffers(batch.column(1))
            for i, j in slices(offsets):
                row, contexts, with_symbol = grams(data, offsets[i : j + 1])
                side = accept[i:j][row]
                for level in range(ORDER + 1):
                    for y in (0, 1):
                        mine = side == y
                        code, first, n = np.unique(with_symbol[level][mine], return_index=True, return_counts=True)
                        context = contexts[level][mine][first]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(code), y, dtype=np.int32)), pa.array(np.full(len(code), level, dtype=np.int32)),
                                pa.array(code.view(np.int64)), pa.array(context.view(np.int64)), pa.array(n),
                            ],
                            names=["accept", "level", "code", "context", "n"],
                        )

    counted = sample.mapInArrow(run, "accept int, level int, code bigint, context bigint, n bigint")
    return counted.groupBy("accept", "level", "code", "context").agg(F.sum("n").alias("n"))


def _markov(counts) -> Markov:
    levels, contexts = [], []
    for level in range(ORDER + 1):
        mine = counts[counts["level"] == level]
        code, n = mine["code"].to_numpy(np.int64).view(np.uint64), mine["n"].to_numpy(np.float64)
        order = np.argsort(code)
        levels.append((code[order], n[order]))
        keys, place = np.unique(mine["context"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
        contexts.append((keys, np.bincount(place, n, len(keys)), np.bincount(place, minlength=len(keys)).astype(np.float64)))
    return Markov(levels, contexts)


def calibrate(difference: np.ndarray, accept: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and shift of a logistic curve over the differences, classes weighted alike; Newton steps with a small ridge."""
    if not len(accept) or accept.min() == accept.max():
        return 1.0, 0.0
    weight = np.where(accept == 1, 0.5 / accept.mean(), 0.5 / (1 - accept.mean())) / len(accept)
    x = np.stack([difference, np.ones(len(difference))], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weight * (p - accept)) + ridge * theta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step = np.linalg.solve(bend, slope)
        theta = theta - np.clip(step, -10, 10)
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def fit(judged: DataFrame, url: str = "url", sample_rows: int = SAMPLE_ROWS) -> UrlModel:
    """Two models from URLs a rule has judged (``rule_verdict``): at most ``sample_rows`` of either verdict.

    The sample goes by a hash of the URL; equal URLs count once, and URLs over ``SAMPLE_URL_BYTES`` bytes are judged but
    not learnt from. So the grams that reach the driver have a bound. A fifth of the sample, again
    by hash, calibrates. With one verdict only, that model faces an empty one; with none, all URLs are accepted.
    """
    known = judged.where(F.col("rule_verdict").isNotNull() & (F.octet_length(F.col(f"`{url}`")) <= SAMPLE_URL_BYTES))
    sides = known.select((F.col("rule_verdict") == "allow").cast("int").alias("accept"), F.col(f"`{url}`").alias("url")).distinct()
    order = [F.xxhash64(F.lit("url"), F.col("url")), F.col("url")]
    parts = [sides.where(F.col("accept") == y).orderBy(*order).limit(sample_rows) for y in (0, 1)]
    sample = stored(parts[0].unionByName(parts[1]), "url-sample").withColumn("_fold", F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(5)))
    counts = _count(sample.where("_fold != 0").select("accept", "url")).toPandas()
    accepted, rejected = (_markov(counts[counts["accept"] == y]) for y in (1, 0))
    model = UrlModel(accepted, rejected, 1.0, 0.0)
    held = sample.where("_fold = 0").select("accept", "url").toPandas().sort_values(["accept", "url"])
    if not len(held):
        return model
    data, offsets = text_buffers(pa.array(held["url"].tolist(), type=pa.string()))
    slope, shift = calibrate(model.differences(data, offsets), held["accept"].to_numpy(np.float64))
    return UrlModel(accepted, rejected, slope, shift)


def judge(judged: DataFrame, model: UrlModel, keep: tuple[str, ...], url: str = "url") -> DataFrame:
    """Adds ``acceptance`` and ``verdict`` to the ``keep`` columns: the rule's where there is one, else the model's."""
    shared = judged.sparkSession.sparkContext.broadcast(model)
    schema = judged.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(batch.num_columns - 1))
            parts = [shared.value.acceptance(data, offsets[i : j + 1]) for i, j in slices(offsets, 1 << 18)]
            p = np.concatenate(parts) if parts else np.empty(0)
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p)], names=[*keep, "acceptance"])

    scored = judged.select(*keep, F.col(f"`{url}`").alias("_url")).mapInArrow(run, f"{fields}, acceptance double")
    by_model = F.when(F.col("acceptance") >= 0.5, F.lit("allow")).otherwise(F.lit("block"))
    return scored.withColumn("verdict", F.coalesce(F.col("rule_verdict"), by_model))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, acceptance`` of every page.

    Rules go first. URLs that rules accept or reject teach two smoothed Markov models of up to ``ORDER`` bytes of
    context; a URL without a rule goes by the calibrated, length-normalised difference of their
    log-likelihoods. Null URLs have empty parts and are scored as the empty text. Rows map one to one.
    Repeated rows are judged alike, a URL is judged whole, whatever its length, an empty table gives no rows, and
    columns other than the two named ones are not read.
    """
    judged = apply_rules(pages.select(F.col(f"`{key}`"), F.col(f"`{url}`")), rules, url)
    verdicts = judge(judged, fit(judged, url), (key, "host", "path", "rule", "rule_verdict"), url)
    return verdicts.select(key, "host", "path", "rule", "verdict", "acceptance")
