"""Operator 11: main text of HTML pages by a graphical model over the DOM tree, solved by sum-product messages."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dom, html_layouts
from .common import stored

# Bounds of the training sample; documented parameters of ``fit`` and ``labelled_pages``.
SAMPLE_PAGES = 300
DRESSED = 5
ROUNDS = 50
TRAINING_TASKS = 8
# Rows of the hashed tables of node weights and of parent-child potentials.
NODE_ROWS = 1 << 13
EDGE_ROWS = 1 << 7
STEP = 0.25
DECAY = 2e-6

SEMANTIC = {"article": 1, "main": 1, "nav": 0, "aside": 0, "footer": 0, "form": 0, "dialog": 0, "menu": 0}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_END = re.compile(r"[.!?…。](?:\s|$)")


@dataclass(frozen=True)
class Model:
    """``node[f]``: log odds of content that a feature adds; ``edge[k, x, y]``: potential of a parent in state x and a child in y."""

    node: np.ndarray
    edge: np.ndarray


@dataclass
class Forest:
    """Trees of several pages. Nodes are in page order, parents before children; ``-1`` is no parent."""

    parent: np.ndarray
    kind: np.ndarray
    features: np.ndarray
    owner: np.ndarray  # the node of each feature

    def levels(self) -> list[np.ndarray]:
        """Nodes by depth."""
        # Each round doubles the way to the ancestor that a node looks at.
        depth, up = (self.parent >= 0).astype(np.int64), self.parent.copy()
        while (there := np.flatnonzero(up >= 0)).size:
            over = up[there]
            depth[there], up[there] = depth[there] + depth[over], up[over]
        order = np.argsort(depth, kind="stable")
        return np.split(order, np.cumsum(np.bincount(depth))[:-1]) if len(depth) else []


def _sum_exp(a: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials over the last axis, which has two entries."""
    return np.logaddexp(a[..., 0], a[..., 1])


def marginals(model: Model, forest: Forest) -> tuple[np.ndarray, np.ndarray, float]:
    """Content marginal of each node, joint marginals of each node with its parent, and the log partition sum.

    Messages go up the trees level by level, then down, so each is computed once and the marginals are exact.
    """
    n = len(forest.parent)
    own = np.zeros((n, 2))
    own[:, 1] = np.bincount(forest.owner, weights=model.node[forest.features], minlength=n)
    below, up = own.copy(), np.zeros((n, 2))
    levels = forest.levels()
    for nodes in reversed(levels[1:]):
        # What a child says about its parent's state: summed over its own.
        up[nodes] = _sum_exp(model.edge[forest.kind[nodes]] + below[nodes][:, None, :])
        for x in (0, 1):
            np.add.at(below[:, x], forest.parent[nodes], up[nodes, x])
    belief = below.copy()
    joint = np.zeros((n, 2, 2))
    for nodes in levels[1:]:
        parents = forest.parent[nodes]
        rest = belief[parents] - up[nodes]
        both = model.edge[forest.kind[nodes]] + rest[:, :, None] + below[nodes][:, None, :]
        joint[nodes] = np.exp(both - _sum_exp(_sum_exp(both))[:, None, None])
        belief[nodes] = np.logaddexp(both[:, 0, :], both[:, 1, :])
    total = float(_sum_exp(belief[levels[0]]).sum()) if levels else 0.0
    return np.exp(belief[:, 1] - _sum_exp(belief)), joint, total


def gradient(model: Model, forest: Forest, labels: np.ndarray) -> tuple[float, Model]:
    """Log-likelihood of the labels and its slope: what is seen less what the marginals expect."""
    p, joint, total = marginals(model, forest)
    node = np.bincount(forest.features, weights=(labels - p)[forest.owner], minlength=len(model.node))
    inner = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros_like(joint)
    seen[inner, labels[forest.parent[inner]], labels[inner]] = 1
    off = (seen - joint)[inner].reshape(-1, 4)
    kind = forest.kind[inner]
    edge = np.stack([np.bincount(kind, weights=off[:, j], minlength=len(model.edge)) for j in range(4)], axis=1).reshape(model.edge.shape)
    scores = np.bincount(forest.owner, weights=model.node[forest.features], minlength=len(labels)) * labels
    reached = scores.sum() + model.edge[kind, labels[forest.parent[inner]], labels[inner]].sum()
    return float(reached) - total, Model(node, edge)


@lru_cache(maxsize=1 << 16)
def _slot(feature: str, rows: int = NODE_ROWS) -> int:
    return zlib.crc32(feature.encode()) % rows


@lru_cache(maxsize=1 << 14)
def _named(tag: str, attributes: str) -> tuple[int, ...]:
    """Features of a start tag: its name, words of class, id and role, and their beginnings."""
    found = [f"tag {tag}"]
    values = dom.attribute_values(attributes) if attributes else {}
    for name in ("class", "id", "role", "aria-label"):
        for word in _WORD.findall(values.get(name, "")):
            word = word.lower()
            word = word[:-1] if len(word) > 3 and word.endswith("s") else word
            found += [f"word {word}", f"head {word[:5]}"]
    if re.search(r"\b(hidden|display:\s*none)", attributes):
        found.append("hidden")
    return tuple(sorted({_slot(f) for f in found}))


def _scale(n: int) -> int:
    return min(10, int(n).bit_length())


def page_tree(page: dom.Page) -> tuple[list[int], list[int], list[list[int]], list[int]]:
    """Parents, edge kinds and features of the nodes that hold text, and their places in the page."""
    n = len(page.parents)
    chars, links, leaves, first = [0] * n, [0] * n, [0] * n, [0] * n
    seen = 0
    for i, text in enumerate(page.texts):
        if text is not None:
            chars[i], links[i], leaves[i], first[i] = len(text), page.link_chars[i], 1, seen
            seen += 1
    for i in range(n - 1, 0, -1):
        if leaves[i]:
            up = page.parents[i]
            if not leaves[up] or first[i] < first[up]:
                first[up] = first[i]
            chars[up] += chars[i]
            links[up] += links[i]
            leaves[up] += leaves[i]
    kept = [i for i in range(n) if leaves[i]]
    place = {i: k for k, i in enumerate(kept)}
    parents, kinds, features = [], [], []
    for i in kept:
        up = page.parents[i]
        parents.append(place[up] if up >= 0 else -1)
        over = page.tags[up] if up >= 0 else ""
        path = f"{page.tags[page.parents[up]]}/{over}" if up > 0 else over
        tag, text = page.tags[i], page.texts[i]
        kinds.append(_slot(f"edge {over} {tag}", EDGE_ROWS))
        share, size = 4 * links[i] // chars[i], _scale(chars[i])
        if text is None:
            late = 4 * first[i] // max(1, seen)
            made = [*_named(tag, page.attributes[i]), _slot(f"in {over} {tag}"), _slot(f"in {path} {tag}"), _slot(f"size {size}"), _slot(f"links {share}"), _slot(f"links {share} size {size}")]
            made += [_slot(f"leaves {_scale(leaves[i])}"), _slot(f"late {late}"), _slot(f"part {4 * chars[i] // max(1, chars[0])}")]
        else:
            ends = min(3, len(_END.findall(text)))
            made = [_slot("text"), _slot(f"text in {over}"), _slot(f"text in {path}"), _slot(f"text size {size}"), _slot(f"text links {share}"), _slot(f"text links {share} size {size}"), _slot(f"text ends {ends}")]
        features.append(made)
    return parents, kinds, features, kept


def _forest(trees: list[tuple[list[int], list[int], list[list[int]]]]) -> Forest:
    starts = np.cumsum([0, *[len(t[0]) for t in trees]])
    parent = np.array([p + s if p >= 0 else -1 for t, s in zip(trees, starts.tolist()) for p in t[0]], dtype=np.int64)
    kind = np.array([k for t in trees for k in t[1]], dtype=np.int64)
    counts = np.array([len(f) for t in trees for f in t[2]], dtype=np.int64)
    features = np.array([x for t in trees for f in t[2] for x in f], dtype=np.int64)
    return Forest(parent, kind, features, np.repeat(np.arange(len(counts)), counts))


def region_labels(page: dom.Page, semantic: bool = False) -> list[int] | None:
    """1 for each text inside a content region, for each element with mostly such text; ``None`` where no region is marked.

    The innermost mark counts; text without any element is content. With ``semantic`` elements that say what they hold are marks where the page has
    one article (or main) element.
    """
    roots = [i for i, t in enumerate(page.tags) if t in ("article", "main")]
    use = semantic and len({page.tags[i] for i in roots}) == len(roots) > 0
    bare = all(t is not None for t in page.texts[1:])
    marks: list[int | None] = []
    for i, tag in enumerate(page.tags):
        attributes = page.attributes[i]
        up = marks[page.parents[i]] if i else (1 if bare else None)
        if html_layouts.MARK in attributes:
            up = int(dom.attribute_values(attributes)[html_layouts.MARK])
        elif use and tag in SEMANTIC:
            up = SEMANTIC[tag]
        marks.append(up)
    if not any(m == 1 for m in marks):
        return None
    chars, good = [0] * len(marks), [0] * len(marks)
    for i in range(len(marks) - 1, -1, -1):
        if page.texts[i] is not None:
            chars[i] = len(page.texts[i])
            good[i] = chars[i] * (marks[i] or 0)
        if i:
            chars[page.parents[i]] += chars[i]
            good[page.parents[i]] += good[i]
    return [int(2 * g > c) for g, c in zip(good, chars)]


def labelled_pages(pages: DataFrame, html: str = "html", sample: int = SAMPLE_PAGES, dressed: int = DRESSED) -> DataFrame:
    """Pages with marked regions as ``html, semantic``: some real ones, and their texts in ``dressed`` drawn layouts each.

    About ``sample`` pages are drawn by a hash of the row's own columns, whatever the size of the table; at most
    twice as many are used. Real pages are marked by their semantic elements and teach nothing without. A table
    without pages of at least one paragraph gives no rows.
    """
    n = pages.count()
    keys = [F.col(f"`{c}`") for c in pages.columns if c != html] or [F.col(f"`{html}`")]
    draw = F.pmod(F.xxhash64(F.lit("sample"), *keys), F.lit(1 << 40))
    drawn = pages.where(draw <= F.lit(int((1 << 40) * min(1.0, sample / max(1, n))))).select(F.col(f"`{html}`").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, bool]] = []
            for source in batch.column(0).to_pylist():
                texts = [t for t in dom.parse(source or "").texts if t]
                long = [t for t in texts if len(t) >= 40]
                short = [t[:40] for t in texts if len(t) < 60] or [t[:20] for t in texts]
                out.append((source or "", True))
                if long:
                    seed = zlib.crc32((source or "").encode())
                    out += [(html_layouts.dress(f"{seed}-{i}", long, short), False) for i in range(dressed)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.bool_())], names=["html", "semantic"])

    return stored(drawn, "page-sample").limit(2 * sample).repartition(TRAINING_TASKS).mapInArrow(run, "html string, semantic boolean")


def _training_rows(labelled: DataFrame) -> DataFrame:
    ints = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for source, semantic in zip(batch.column("html").to_pylist(), batch.column("semantic").to_pylist()):
                page = dom.parse(source)
                labels = region_labels(page, semantic)
                if labels is None:
                    continue
                parents, kinds, features, kept = page_tree(page)
                for column, values in zip(rows, (parents, kinds, [x for f in features for x in f], [len(f) for f in features], [labels[i] for i in kept])):
                    column.append(values)
            yield pa.RecordBatch.from_arrays([pa.array(c, ints) for c in rows], names=["parent", "kind", "feature", "counts", "label"])

    schema = ", ".join(f"{n} array<int>" for n in ("parent", "kind", "feature", "counts", "label"))
    return stored(labelled.mapInArrow(run, schema), "page-trees")


def _slope(rows: DataFrame, model: Model) -> tuple[int, float, Model]:
    """Nodes, log-likelihood and slope over all training pages, summed from one vector a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, reached = 0, 0.0
        node, edge = np.zeros_like(model.node), np.zeros_like(model.edge)
        for batch in batches:
            flat = {n: batch.column(n).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for n in batch.schema.names}
            if not len(flat["parent"]):
                continue
            sizes = np.diff(batch.column("parent").offsets.to_numpy())
            shift = np.repeat(np.cumsum(sizes) - sizes, sizes)
            parent = np.where(flat["parent"] >= 0, flat["parent"] + shift, -1)
            forest = Forest(parent, flat["kind"], flat["feature"], np.repeat(np.arange(len(parent)), flat["counts"]))
            value, slope = gradient(model, forest, flat["label"])
            nodes, reached = nodes + len(parent), reached + value
            node += slope.node
            edge += slope.edge
        yield pa.RecordBatch.from_arrays([pa.array([nodes]), pa.array([reached]), pa.array([np.concatenate([node, edge.ravel()]).tobytes()], pa.binary())], names=["nodes", "value", "slope"])

    # One row a task; the number of tasks does not follow the corpus.
    parts = rows.mapInArrow(run, "nodes bigint, value double, slope binary").toArrow().to_pylist()
    parts.sort(key=lambda r: (r["nodes"], r["value"]))
    total = sum((np.frombuffer(r["slope"]) for r in parts), np.zeros(len(model.node) + model.edge.size))
    return sum(r["nodes"] for r in parts), sum(r["value"] for r in parts), Model(total[: len(model.node)], total[len(model.node) :].reshape(model.edge.shape))


def fit(labelled: DataFrame, rounds: int = ROUNDS) -> Model:
    """Node weights and parent-child potentials that make the marked regions of ``html`` likely.

    ``labelled`` has ``html`` with regions marked by the attribute ``data-region`` (1 or 0) and ``semantic``, true
    where elements like ``article`` and ``nav`` mark them too. Tasks sum the slope of the likelihood, the driver holds the two
    hashed tables only and takes ``rounds`` steps, each scaled by the slope's own size (Adam). Without pages all is 0.
    """
    rows = _training_rows(labelled)
    model = Model(np.zeros(NODE_ROWS), np.zeros((EDGE_ROWS, 2, 2)))
    flat = np.zeros(NODE_ROWS + EDGE_ROWS * 4)
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    for k in range(1, rounds + 1):
        nodes, _, slope = _slope(rows, model)
        if not nodes:
            break
        g = np.concatenate([slope.node, slope.edge.ravel()]) / nodes - DECAY * flat
        mean = 0.9 * mean + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        flat = flat + STEP * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-7)
        model = Model(flat[:NODE_ROWS], flat[NODE_ROWS:].reshape(EDGE_ROWS, 2, 2))
    return model


def extract_texts(sources: list[str], model: Model) -> list[str]:
    """The main text of each page: texts whose content marginal is at least a half, in page order."""
    pages = [dom.parse(s) for s in sources]
    trees = [page_tree(p) for p in pages]
    p, _, _ = marginals(model, _forest([t[:3] for t in trees]))
    out, at = [], 0
    for page, (_, _, _, kept) in zip(pages, trees):
        chosen = [page.texts[i] for i, q in zip(kept, p[at : at + len(kept)].tolist()) if q >= 0.5 and page.texts[i] is not None]
        out.append("\n\n".join(chosen))
        at += len(kept)
    return out


SLICE_CHARS = 1 << 20


def extract_content(pages: DataFrame, model: Model, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` of each page; one narrow pass with the model beside it.

    A page is read whole, whatever its length; pages go through the model together up to a bounded number of
    characters. A null or empty page has the empty text, and so has a page without content. Repeated rows give repeated results, nulls in
    ``keep`` stay, an empty table gives no rows; other columns are not read.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = [s or "" for s in batch.column(batch.num_columns - 1).to_pylist()]
            texts: list[str] = []
            while len(texts) < len(sources):
                end, size = len(texts), 0
                while end < len(sources) and (size == 0 or size + len(sources[end]) <= SLICE_CHARS):
                    size += len(sources[end]) + 1
                    end += 1
                texts += extract_texts(sources[len(texts) : end], model)
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], *made], names=[*keep, "text", "n_chars"])

    return pages.select(*keep, pages[html].alias("_html")).mapInArrow(run, f"{fields}, text string, n_chars bigint")


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: the model is trained on a bounded sample of the table, then applied to all of it."""
    return extract_content(pages, fit(labelled_pages(pages.select("page_id", "url", "html"))))
