"""Operator 9: toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_crc, stored
from .textcodes import Words, combine, each_slice, mix, slices

# Bounds of the training sample and of the model; documented parameters of ``fit``.
SAMPLE_ROWS = 8000
MODEL_TERMS = 20_000
# Terms of the sample that may enter the model, and those that are paired with one another.
SAMPLE_TERMS = 1 << 19
PAIR_TERMS = 4096
# The sample reaches the driver in so many slices.
SAMPLE_SLICES = 8

# Words end at ASCII characters other than letters and digits.
BREAKS = bytes(b for b in range(128) if not chr(b).isalnum())
# Inflected words share the codes of their first bytes.
PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class Model:
    """``terms`` are sorted codes with a value each; ``linear`` and ``factors`` have a row for each."""

    terms: np.ndarray
    values: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray


def term_codes(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Owner and code of every term of some texts: words and their beginnings."""
    owner = found.owner
    owners, codes = [owner], [found.codes]
    for codes_of in found.prefixes.values():
        there = codes_of != 0
        owners.append(owner[there])
        codes.append(codes_of[there])
    return np.concatenate(owners), np.concatenate(codes)


def _sorted_unique(owner: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((code, owner))
    owner, code = owner[order], code[order]
    new = np.ones(len(code), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])
    return owner[new], code[new]


def sample_labels(labels: DataFrame, key: str, label: str, rows: int) -> DataFrame:
    """At most ``rows`` ids of either label, by a hash of the id; an id labelled twice counts as its larger label."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    once = known.groupBy(key).agg(F.max(label).cast("int").alias("label")).where(id_crc(F.col(key)) % 5 != 0)
    order = [F.xxhash64(F.lit("toxicity"), F.col(key)), F.col(key)]
    parts = [once.where(F.col("label") == y).orderBy(*order).limit(rows) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def _sample_terms(docs: DataFrame, sample: DataFrame, key: str, text: str) -> DataFrame:
    """``label`` and the distinct term codes of each sampled text; equal texts count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, found in each_slice(batch.column(1), BREAKS, PREFIXES):
                owner, code = _sorted_unique(*term_codes(found))
                ends = np.searchsorted(owner, np.arange(j - i + 1)).astype(np.int32)
                terms = pa.ListArray.from_arrays(pa.array(ends), pa.array(code.view(np.int64)))
                # The text itself is told by its words in their order.
                marks = np.array([_digest(found, k) for k in range(j - i)], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(marks), terms], names=["label", "mark", "terms"]
                )

    chosen = docs.select(F.col(key), F.col(text)).join(F.broadcast(sample), key).select("label", text)
    terms = chosen.mapInArrow(run, "label int, mark bigint, terms array<bigint>")
    return terms.groupBy("mark", "label").agg(F.first("terms").alias("terms")).drop("mark")


def _digest(found: Words, k: int) -> int:
    part = found.codes[found.bounds[k] : found.bounds[k + 1]]
    place = np.arange(1, len(part) + 1, dtype=np.uint64)
    return int(np.bitwise_xor.reduce(combine([part, place])).view(np.int64)) if len(part) else 0


def count_terms(terms: DataFrame, limit: int) -> DataFrame:
    """Terms of at least 3 texts and how many have them, whatever their labels; at most ``limit``, the commonest first."""
    counts = terms.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).where("n >= 3")
    return counts.orderBy(F.desc("n"), "term").limit(limit)


@dataclass(frozen=True)
class Sample:
    """Places of terms, text after text; ``bounds[i]:bounds[i + 1]`` are those of text ``i``. ``counts`` are texts per term."""

    at: np.ndarray
    bounds: np.ndarray
    labels: np.ndarray
    counts: np.ndarray

    def parts(self, entries: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Text range, text within the range and place of every entry, so many entries at a time."""
        for i, j in slices(self.bounds, entries):
            at = self.at[self.bounds[i] : self.bounds[j]]
            yield i, j, np.repeat(np.arange(j - i), np.diff(self.bounds[i : j + 1])), at

    def pull(self, r: np.ndarray) -> np.ndarray:
        """Sum of ``r`` over the texts that have each term."""
        out = np.zeros(len(self.counts))
        for i, j, row, at in self.parts():
            out += np.bincount(at, r[i:j][row], len(out))
        return out

    def only(self, places: np.ndarray) -> Sample:
        """The same texts with the terms of sorted ``places`` alone, numbered from 0."""
        new = np.full(len(self.counts), -1, dtype=np.int32)
        new[places] = np.arange(len(places), dtype=np.int32)
        kept, sizes = [], []
        for i, j, row, at in self.parts():
            there = new[at] >= 0
            kept.append(new[at[there]])
            sizes.append(np.bincount(row[there], minlength=j - i))
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return Sample(np.concatenate(kept), bounds, self.labels, self.counts[places])


def _logistic(y: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(y, -30, 30)))


def _descend(part: Sample, bias: float, w: np.ndarray, penalty: np.ndarray, steps: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Accelerated proximal steps of the logistic loss with an L1 ``penalty`` per term; bias, weights and probabilities."""
    n = len(part.labels)
    row = np.repeat(np.arange(n), np.diff(part.bounds))
    widest = 1 + int(np.diff(part.bounds).max(initial=0))
    pace = 4 / (widest * np.maximum(part.counts, 1))

    def chance(b: float, v: np.ndarray) -> np.ndarray:
        return _logistic(b + np.bincount(row, v[part.at], n))

    b0, w0, b, v, t = bias, w, bias, w, 1.0
    for _ in range(steps):
        r = chance(b, v) - part.labels
        nb = b - 4 / (widest * n) * r.sum()
        moved = v - pace * np.bincount(part.at, r[row], len(w))
        nw = np.sign(moved) * np.maximum(0, np.abs(moved) - pace * penalty)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        b, v = nb + (t - 1) / nt * (nb - b0), nw + (t - 1) / nt * (nw - w0)
        b0, w0, t = nb, nw, nt
    return b0, w0, chance(b0, w0)


def linear_terms(sample: Sample, errors: float = 4.0, rounds: int = 12, added: int = 500) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of terms with a weight of their own, what a model of these alone says of each text, and terms they stand for.

    The last are those whose share differs between the labels by ``errors`` standard errors, the clearest first. A lasso over all terms: a term enters where its sum of residuals passes ``errors`` standard errors, the clearest first.
    """
    n, share = len(sample.labels), sample.labels.mean()
    spread = sample.counts / n
    error = np.sqrt(share * (1 - share) * n * spread * (1 - spread))
    penalty = errors * np.maximum(error, 1e-9)
    active, w, bias = np.empty(0, dtype=np.int64), np.empty(0), float(np.log(share / (1 - share)))
    p = np.full(n, share)
    over = np.abs(sample.pull(sample.labels - p)) / penalty
    alone = np.flatnonzero((over >= 1) & (spread < 1))
    alone = alone[np.argsort(-over[alone], kind="stable")]
    for k in range(rounds):
        over = np.abs(sample.pull(sample.labels - p)) / penalty if k else over
        over[active] = 0
        fresh = np.flatnonzero((over > 1.05) & (spread < 1))
        if not len(fresh):
            break
        fresh = fresh[np.argsort(-over[fresh], kind="stable")[:added]]
        grown = np.sort(np.concatenate([active, fresh]))
        start = np.zeros(len(grown))
        start[np.searchsorted(grown, active)] = w
        bias, w, p = _descend(sample.only(grown), bias, start, penalty[grown], 60)
        active, w = grown[w != 0], w[w != 0]
    if len(active):
        # Weights without most of the penalty, so that what the terms explain leaves no residuals.
        p = _descend(sample.only(active), bias, w, 0.02 * penalty[active], 300)[2]
    return active, p, alone


def residual_pairs(
    sample: Sample, active: np.ndarray, p: np.ndarray, common: int, errors: float = 6.0, limit: int = 20_000
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of places whose texts are more, or less, often label 1 than ``p`` says, with the distance in standard errors.

    Each of ``active`` is paired with every term; the ``common`` commonest terms are paired with one another. What
    either term says alone plays no part. The clearest ``limit`` pairs come back, the first place below the second.
    """
    r = sample.labels - p
    weight = np.maximum(p * (1 - p), 0.1)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def note(a: np.ndarray, b: np.ndarray, sums: np.ndarray, weights: np.ndarray) -> None:
        z = sums / np.sqrt(weights)
        clear = (np.abs(z) >= errors) & (a != b)
        found.append((np.minimum(a, b)[clear], np.maximum(a, b)[clear], z[clear]))

    own = sample.only(active)
    texts = np.repeat(np.arange(len(r), dtype=np.int32), np.diff(own.bounds))[np.argsort(own.at, kind="stable")]
    ends = np.concatenate([[0], np.cumsum(np.bincount(own.at, minlength=len(active)))])
    sizes = np.diff(sample.bounds)
    for k, place in enumerate(active):
        there = texts[ends[k] : ends[k + 1]]
        sums, weights = np.zeros(len(sample.counts)), np.zeros(len(sample.counts))
        for c in range(0, len(there), 1024):
            some = there[c : c + 1024]
            at = np.concatenate([sample.at[sample.bounds[i] : sample.bounds[i + 1]] for i in some])
            row = np.repeat(some, sizes[some])
            sums += np.bincount(at, r[row], len(sums))
            weights += np.bincount(at, weight[row], len(sums))
        others = np.flatnonzero(weights)
        note(np.full(len(others), place), others, sums[others], weights[others])
    # Terms of nearly all texts pair with nothing; a pair in fewer texts than ``errors`` is never clear.
    frequent = np.flatnonzero((sample.counts < 0.95 * len(r)) & (sample.counts >= errors))
    frequent = np.sort(frequent[np.argsort(-sample.counts[frequent], kind="stable")[:common]])
    column, step = np.full(len(sample.counts), -1, dtype=np.int32), 128
    column[frequent] = np.arange(len(frequent), dtype=np.int32)
    # One bit per text and frequent term; a block of terms is unpacked when its turn comes.
    has = np.zeros((len(r), -(-len(frequent) // 8)), dtype=np.uint8)
    for i, j, row, at in sample.parts(1 << 18):
        there = column[at] >= 0
        some = np.zeros((j - i, len(frequent)), dtype=bool)
        some[row[there], column[at[there]]] = True
        has[i:j] = np.packbits(some, axis=1)

    def block(a: int) -> np.ndarray:
        return np.unpackbits(has[:, a // 8 : -(-min(a + step, len(frequent)) // 8)], axis=1, count=min(step, len(frequent) - a)).astype(np.float32)

    for a in range(0, len(frequent), step):
        left = block(a)
        pulled, weighed = (left * r[:, None].astype(np.float32)).T, (left * weight[:, None].astype(np.float32)).T
        for b in range(a, len(frequent), step):
            right = left if a == b else block(b)
            sums, weights = pulled @ right, weighed @ right
            i, j = np.nonzero(np.abs(sums) >= errors * np.sqrt(np.maximum(weights, 0.01)))
            note(frequent[a + i], frequent[b + j], sums[i, j].astype(np.float64), weights[i, j].astype(np.float64))
    first, second, z = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, dtype=np.int64),) * 3
    best = np.lexsort((second, first, -np.abs(z)))
    first, second, z = first[best], second[best], z[best]
    _, once = np.unique(np.stack([first, second]), axis=1, return_index=True)
    once = np.sort(once)[:limit]
    return first[once], second[once], z[once]


def pair_factors(n: int, first: np.ndarray, second: np.ndarray, z: np.ndarray, factors: int = 8, dense: int = 1024) -> np.ndarray:
    """Latent rows whose products follow the signs of the clearest pairs, as far as so many factors can."""
    latent = np.zeros((n, factors))
    seen = np.unique(np.stack([first, second], axis=1).ravel(), return_index=True)
    used = np.sort(seen[0][np.argsort(seen[1], kind="stable")[:dense]])
    if not len(used):
        return latent
    inside = np.isin(first, used) & np.isin(second, used)
    i, j = np.searchsorted(used, first[inside]), np.searchsorted(used, second[inside])
    signs = np.zeros((len(used), len(used)))
    signs[i, j] = signs[j, i] = np.sign(z[inside])
    value, vector = np.linalg.eigh(signs)
    top = np.argsort(-value)[:factors]
    made = vector[:, top] * np.sqrt(np.maximum(value[top], 0))
    latent[used, : made.shape[1]] = made / max(1.0, float(np.abs(made).max()))
    return latent


def train(
    rows: list[np.ndarray], labels: np.ndarray, terms: np.ndarray, values: np.ndarray,
    factors: int = 8, steps: int = 500, batch: int = 512, rate: float = 0.1, decay: float = 1e-4, seed: int = 7,
    start: np.ndarray | None = None,
) -> Model:
    """Logistic loss, at least ``steps`` AdaGrad steps over mini-batches; rows hold places in ``terms``.

    Both labels must occur. The intercept starts at their log odds, so without terms it stays there. ``start`` is added
    to the small random factors that training begins with.
    """
    draw = np.random.default_rng(seed)
    n = len(terms)
    share = labels.mean()
    bias, linear, latent = float(np.log(share / (1 - share))), np.zeros(n), draw.normal(0, 0.01, (n, factors))
    latent = latent if start is None else latent + start
    seen_bias, seen_linear, seen_latent = 1e-6, np.full(n, 1e-6), np.full((n, factors), 1e-6)
    passes = -(-steps // -(-len(rows) // batch))
    for _ in range(passes if n else 0):
        order = draw.permutation(len(rows))
        for a in range(0, len(order), batch):
            chosen = order[a : a + batch]
            idx = np.concatenate([rows[i] for i in chosen])
            row = np.repeat(np.arange(len(chosen)), [len(rows[i]) for i in chosen])
            x = values[idx]
            y, sums = _raw_scores(len(chosen), row, idx, x, bias, linear, latent)
            slope = (1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[chosen]) / len(chosen)
            per = slope[row] * x
            step = slope.sum()
            seen_bias += step * step
            bias -= rate * step / np.sqrt(seen_bias)
            used = np.unique(idx)
            grad = np.bincount(idx, per, n)[used] + decay * linear[used]
            seen_linear[used] += grad * grad
            linear[used] -= rate * grad / np.sqrt(seen_linear[used])
            for f in range(factors):
                pull = per * sums[row, f] - per * x * latent[idx, f]
                grad = np.bincount(idx, pull, n)[used] + decay * latent[used, f]
                seen_latent[used, f] += grad * grad
                latent[used, f] -= 0.3 * rate * grad / np.sqrt(seen_latent[used, f])
    return Model(terms, values, bias, linear, latent)


def _raw_scores(
    n: int, row: np.ndarray, idx: np.ndarray, x: np.ndarray, bias: float, linear: np.ndarray, latent: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Bias, linear part and half of (squared sums less sums of squares) over the factors."""
    sums = np.stack([np.bincount(row, latent[idx, f] * x, n) for f in range(latent.shape[1])], axis=1)
    squares = np.bincount(row, (latent[idx] ** 2).sum(axis=1) * x * x, n)
    return bias + np.bincount(row, linear[idx] * x, n) + 0.5 * ((sums**2).sum(axis=1) - squares), sums


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS, model_terms: int = MODEL_TERMS, sample_terms: int = SAMPLE_TERMS,
    pair_terms: int = PAIR_TERMS,
) -> Model:
    """A model from at most ``sample_rows`` labelled rows of either label and at most ``model_terms`` terms.

    All terms of 3 sampled texts or more, up to the ``sample_terms`` commonest, may enter: for what they say alone, or for what
    they say beside another term, however neutral both are alone. Pairs are looked for between a term that
    says something alone and any term, and among the ``pair_terms`` commonest terms.

    Labels come from ids whose crc32 modulo 5 is not 0. The intercept is moved from the sample's share of
    label 1 to that of all labelled rows. Without rows of both labels, the model has no terms and
    says the smoothed share of label 1. Null ids and labels teach nothing, null texts have no terms, equal texts of a label count once.
    """
    sample = stored(sample_labels(labels, key, label, sample_rows), "toxicity-ids")
    known = labels.where(F.col(label).isin(0, 1) & (id_crc(F.col(key)) % 5 != 0)).agg(F.sum(label), F.count("*")).first()
    ones, total = int(known[0] or 0), int(known[1])
    prior = np.log((ones + 0.5) / (total - ones + 0.5))
    # Checked bound: two labels of sample_rows ids each.
    terms = stored(_sample_terms(docs, sample, key, text), "toxicity-terms")
    size = {r["label"]: r["count"] for r in terms.groupBy("label").count().collect()}
    p, n = size.get(1, 0), size.get(0, 0)
    none = np.empty(0)
    if not p or not n:
        return Model(none.astype(np.int64), none, float(prior), none, np.empty((0, 1)))
    vocabulary = count_terms(terms, sample_terms).toArrow().sort_by("term")
    codes, counts = (vocabulary.column(name).to_numpy() for name in ("term", "n"))
    shared = terms.sparkSession.sparkContext.broadcast(codes)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            lists = [np.sort(wanted_places(wanted, np.asarray(v.values))) for v in batch.column(1)]
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            at = pa.array(np.concatenate(lists) if lists else np.empty(0, dtype=np.int32), type=pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), at)], names=["label", "at"])

    # Checked bound: the texts of the sample, at most so many terms of each as the vocabulary has; in slices.
    placed = stored(terms.mapInArrow(places, "label int, at array<int>"), "toxicity-places")
    slot = F.pmod(F.xxhash64("at"), F.lit(SAMPLE_SLICES))
    sample = _in_order((placed.where(slot == i).toArrow() for i in range(SAMPLE_SLICES)), counts)
    active, said, alone = linear_terms(sample)
    first, second, z = residual_pairs(sample, active, said, pair_terms)
    # Terms with a weight of their own first, then those of the clearest pairs, then those that others stand for.
    named = np.concatenate([active, np.stack([first, second], axis=1).ravel(), alone]).astype(np.int64)
    at, place = np.unique(named, return_index=True)
    used = np.sort(at[np.argsort(place, kind="stable")[:model_terms]])
    inside = np.isin(first, used) & np.isin(second, used)
    start = pair_factors(len(used), np.searchsorted(used, first[inside]), np.searchsorted(used, second[inside]), z[inside])
    part, labels_of, sample = sample.only(used), sample.labels, None
    texts = [part.at[a:b] for a, b in zip(part.bounds[:-1], part.bounds[1:], strict=True)]
    model = train(texts, labels_of, codes[used], np.ones(len(used)), start=start)
    return Model(model.terms, model.values, model.bias + prior - float(np.log(p / n)), model.linear, model.factors)


def _in_order(slices_of_rows: Iterator[pa.Table], counts: np.ndarray) -> Sample:
    """The texts by label and a hash of their places, so that the order they arrive in changes nothing.

    Slices come one after another and are dropped before the next, so the driver holds the sample twice at most.
    """
    kept: list[np.ndarray] = []
    labels, sizes, marks = [], [], []
    for rows in slices_of_rows:
        for batch in rows.to_batches():
            lists = batch.column(batch.schema.get_field_index("at"))
            bounds = np.asarray(lists.offsets).astype(np.int64)
            at = np.array(lists.values, dtype=np.int32)
            ends = bounds - bounds[0]
            at = at[bounds[0] : bounds[-1]]
            kept.append(at)
            sizes.append(np.diff(ends))
            labels.append(batch.column(batch.schema.get_field_index("label")).to_numpy().astype(np.float64))
            marks.append(np.array([np.bitwise_xor.reduce(mix(at[a:b] + 1), initial=np.uint64(0)) for a, b in zip(ends[:-1], ends[1:], strict=True)], dtype=np.uint64))
        del rows
    label, size, mark = (np.concatenate(x) for x in (labels, sizes, marks))
    order = np.lexsort((mark, label))
    bounds = np.concatenate([[0], np.cumsum(size[order])])
    start = np.empty(len(order), dtype=np.int64)
    start[order] = bounds[:-1]
    moved, text = np.empty(int(bounds[-1]), dtype=np.int32), 0
    kept.reverse()
    for own in sizes:
        at, a = kept.pop(), 0
        for n in own:
            moved[start[text] : start[text] + n] = at[a : a + n]
            text, a = text + 1, a + int(n)
    return Sample(moved, bounds, label[order], counts)


def wanted_places(wanted: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Places in sorted ``wanted`` of those ``codes`` that are there."""
    if not len(wanted) or not len(codes):
        return np.empty(0, dtype=np.int32)
    at = np.searchsorted(wanted, codes)
    at[at == len(wanted)] = 0
    return at[wanted[at] == codes].astype(np.int32)


class Scorer:
    """Scores of texts under one model; most terms are told apart by a small bit table first."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[model.terms.view(np.uint64) >> np.uint64(44)] = True

    def __call__(self, found: Words) -> np.ndarray:
        owner, code = term_codes(found)
        hit = self.maybe[code >> np.uint64(44)]
        owner, code = _sorted_unique(owner[hit], code[hit].view(np.int64))
        m, n = self.model, len(found.bounds) - 1
        if not len(m.terms):
            return np.full(n, 1 / (1 + np.exp(-m.bias)))
        at = np.searchsorted(m.terms, code)
        at[at == len(m.terms)] = 0
        real = m.terms[at] == code
        row, at = owner[real], at[real]
        y, _ = _raw_scores(n, row, at, m.values[at], m.bias, m.linear, m.factors)
        return 1 / (1 + np.exp(-np.clip(y, -500, 500)))


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) of every row; whole texts, one pass, no shuffle.

    Only the text enters a score. Null and empty texts score what the intercept says. Rows map one to one,
    repeated rows score alike; columns of ``keep`` may hold nulls; an empty table gives no rows. A long text is
    worked off in slices; columns that are not named are not read and may have any name.
    """
    schema = docs.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            scores = [scorer(found) for _, _, found in each_slice(column, BREAKS, PREFIXES)]
            s = np.concatenate(scores) if scores else np.empty(0)
            kept = [batch.column(i) for i in range(len(keep))]
            made = [pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=[*keep, "score", "predicted"])

    narrow = docs.select(*keep, docs[text].alias("_text"))
    return narrow.mapInArrow(run, f"{fields}, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labels that may be learnt from, then score all documents."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", (id_crc(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", "predicted")
