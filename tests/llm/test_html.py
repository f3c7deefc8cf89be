"""HTML extraction: parser, exact marginals, slope, and texts of real and drawn pages."""

import html
import itertools
import random
import re

import numpy as np
import pytest

from listloom.llm import dom, html_extraction, html_layouts
from listloom.llm.common import prepare

DATA = "/root/testdata/sf0.001"


def leaves(source):
    return [t for t in dom.parse(source).texts if t is not None]


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        ("<p>a<p>b<b>c<br>d<p>e", ["a", "bc d", "e"]),
        ("<div>a<div>b</div>c</div>d", ["a", "b", "c", "d"]),
        ("<ul><li>a<li>b <ul><li>c</ul> d</ul>", ["a", "b", "c", "d"]),
        ("<script>var t='</p>'; <p>no</script>yes<style>p{}</style><!-- <p>no --><p>more", ["yes", "more"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
        ("a&nbsp;b \t\n c&#233;&eacute;&am &amp", ["a b céé&am &"]),
        ("<a title='x>y' href=\"<p>\">link</a> text <unknown>z</unknown>", ["link text", "z"]),
        ("<head><title>no</title><p>yes", ["yes"]),
        ("<select><option>no</select><textarea><p>no</textarea><button>no</button>yes", ["yes"]),
        ("</p></div>a</b>b</span></p>c", ["ab", "c"]),
        ("x <p class=\"open>y</p>", ["x", "y"]),
        ("1 < 2 <p", ["1 < 2"]),
        ("<noscript><p>no</p></noscript><p>yes</p><svg><text>no</text></svg>", ["yes"]),
    ],
)
def test_texts_of_a_page(source, wanted):
    assert leaves(source) == wanted


def test_links_and_parents():
    page = dom.parse("<div class='m n'><p>one <a>two</a> three</p></div>")
    assert page.tags == ["#page", "div", "p", "#text"] and page.parents == [-1, 0, 1, 2]
    assert page.link_chars[3] == 3 and dom.attribute_values(page.attributes[1]) == {"class": "m n"}


def test_deep_and_broken_pages_end():
    assert leaves("<div>" * 5000 + "deep" + "</div>" * 4000) == ["deep"]
    assert leaves("<" * 20_000) == ["<" * 20_000]
    model = html_extraction.Model(np.zeros(html_extraction.NODE_ROWS), np.zeros((html_extraction.EDGE_ROWS, 2, 2)))
    model.node[html_extraction._slot("text")] = 1
    assert html_extraction.extract_texts(["<div>" * 3000 + "deep", ""], model) == ["deep", ""]


def small_forest(draw, n):
    parent = np.array([-1 if i == 0 or draw.random() < 0.2 else draw.randrange(i) for i in range(n)], dtype=np.int64)
    kind = np.array([draw.randrange(html_extraction.EDGE_ROWS) for _ in range(n)], dtype=np.int64)
    owner = np.sort(np.array([draw.randrange(n) for _ in range(3 * n)], dtype=np.int64))
    features = np.array([draw.randrange(html_extraction.NODE_ROWS) for _ in range(3 * n)], dtype=np.int64)
    return html_extraction.Forest(parent, kind, features, owner)


def score(model, forest, states):
    own = sum(model.node[f] * states[o] for f, o in zip(forest.features, forest.owner))
    return own + sum(model.edge[k, states[p], states[i]] for i, (p, k) in enumerate(zip(forest.parent, forest.kind)) if p >= 0)


def random_model(seed):
    draw = np.random.default_rng(seed)
    return html_extraction.Model(draw.normal(size=html_extraction.NODE_ROWS), draw.normal(size=(html_extraction.EDGE_ROWS, 2, 2)))


@pytest.mark.parametrize("seed", range(6))
def test_messages_give_the_marginals_of_all_labellings(seed):
    draw, model = random.Random(seed), random_model(seed)
    forest = small_forest(draw, 9)
    weights = {s: np.exp(score(model, forest, s)) for s in itertools.product((0, 1), repeat=9)}
    total = sum(weights.values())
    p, joint, log_total = html_extraction.marginals(model, forest)
    assert np.isclose(log_total, np.log(total))
    for i in range(9):
        assert np.isclose(p[i], sum(w for s, w in weights.items() if s[i]) / total)
        up = forest.parent[i]
        if up >= 0:
            for x, y in itertools.product((0, 1), repeat=2):
                assert np.isclose(joint[i, x, y], sum(w for s, w in weights.items() if (s[up], s[i]) == (x, y)) / total)


def test_slope_is_that_of_the_likelihood():
    draw, model = random.Random(7), random_model(7)
    forest = small_forest(draw, 8)
    labels = np.array([draw.randrange(2) for _ in range(8)])
    value, slope = html_extraction.gradient(model, forest, labels)
    assert np.isclose(value, score(model, forest, labels) - html_extraction.marginals(model, forest)[2])
    for f in forest.features[:5]:
        moved = html_extraction.Model(model.node.copy(), model.edge)
        moved.node[f] += 1e-5
        assert np.isclose((html_extraction.gradient(moved, forest, labels)[0] - value) / 1e-5, slope.node[f], atol=1e-3)
    for i in np.flatnonzero(forest.parent >= 0)[:4]:
        moved = html_extraction.Model(model.node, model.edge.copy())
        moved.edge[forest.kind[i], 1, 0] += 1e-5
        assert np.isclose((html_extraction.gradient(moved, forest, labels)[0] - value) / 1e-5, slope.edge[forest.kind[i], 1, 0], atol=1e-3)


def plain_text(source):
    """The article of the test pages, cut at its headings and paragraphs."""
    inner = source[source.index("<article>") + 9 : source.index("</article>")]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def model(spark):
    pages = prepare(spark).read.parquet(f"{DATA}/pages.parquet")
    return html_extraction.fit(html_extraction.labelled_pages(pages))


def test_texts_of_the_table(spark, model):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r["page_id"]: r for r in html_extraction.extract_content(pages, model).collect()}
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    assert {k: r["text"] for k, r in got.items()} == {k: plain_text(s) for k, s in sources.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_held_out_layouts(spark, model):
    texts = [[t for t in leaves(r["html"])] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    both = either = 0
    for i, found in enumerate(texts):
        long, short = [t for t in found if len(t) >= 40], [t[:40] for t in found if len(t) < 60]
        if not long or not short:
            continue
        source = html_layouts.dress(f"held out {i}", long, short)
        page = dom.parse(source)
        wanted = {t for t, label in zip(page.texts, html_extraction.region_labels(page)) if t and label}
        got = set(html_extraction.extract_texts([source], model)[0].split("\n\n"))
        both, either = both + len(wanted & got), either + len(wanted | got)
    assert both / either > 0.95


def test_odd_pages(spark, model):
    prose = "Some words of a sentence that goes on for a while. And another one."
    rows = [(1, "u", None), (2, None, ""), (None, "v", " \n"), (4, "w", prose), (4, "w", prose), (5, "x", "<p>" + prose * 5000), (6, "y", f"<nav><a>{prose}</a></nav>"), (7, "z", "<script>" + prose)]
    frame = spark.createDataFrame([(*r, "t", 1, "h") for r in rows], "page_id bigint, url string, html string, text string, n_chars int, _html string").repartition(3)
    got = sorted(((r["page_id"] or 0, r["url"], r["text"]) for r in html_extraction.extract_content(frame, model).collect()), key=repr)
    wanted = [(r[0] or 0, r[1], {4: prose, 5: prose * 5000}.get(r[0], "")) for r in rows]
    assert got == sorted(wanted, key=repr)


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert html_extraction.extract_pages(none).collect() == []
