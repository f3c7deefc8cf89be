"""Labelled pages: texts of real pages put into layouts whose regions are known."""

from __future__ import annotations

import html
import random

# Elements, classes and ids that pages commonly use for a region.
CONTENT = (
    "article", "main", "article class=post", "div class=post-content", "div class=entry-content", "div class=article-body", "div id=content", "div id=main-content",
    "section class=story", "td class=text", "div class=page-body", "section", "div",
)
REGIONS = {
    "menu": ("nav", "nav class=menu", "div class=nav", "ul class=menu", "div id=navigation", "div class=navbar", "div class=breadcrumbs", "ul", "div class=topnav", "menu"),
    "header": ("header", "div id=header", "div class=site-header", "header class=masthead", "div class=page-header"),
    "footer": ("footer", "div id=footer", "div class=site-footer", "footer class=copyright", "div class=bottom"),
    "sidebar": ("aside", "div class=sidebar", "aside class=widget", "div id=sidebar", "div class=related", "div class=side-column", "section class=recommended"),
    "notice": ("div class=cookie-notice", "div id=cookie-banner", "div class=notice", "div class=consent", "section class=gdpr", "div class=alert", "dialog", "div class=popup", "div class=disclaimer"),
    "advert": ("div class=ad", "div class=ads", "div class=advert", "aside class=advertisement", "div class=sponsored", "div id=ad-slot", "div class=promo", "section class=banner"),
    "form": ("form", "form class=search", "div class=newsletter", "form id=login", "div class=subscribe", "fieldset", "div class=signup"),
    "comments": ("section class=comments", "div id=comments", "ol class=comment-list", "div class=comment", "section id=discussion", "div class=replies", "div class=reader-comments", "div class=responses"),
    "share": ("div class=share", "ul class=social", "div class=tags", "div class=byline-share"),
}
WRAPPERS = ("div", "div class=container", "div class=row", "div id=page", "div class=wrapper", "section", "div class=column", "div class=layout")
# The attribute that names a region in a labelled page; it is never a feature.
MARK = "data-region"


def _pick(draw: random.Random, shells: tuple[str, ...]) -> str:
    """The first shell, the most common one on real pages, more often than the others."""
    return shells[0] if draw.random() < 0.4 else draw.choice(shells)


def _open(shell: str, mark: str | None = None) -> tuple[str, str]:
    tag, *rest = shell.split(" ")
    attributes = "".join(f' {name}="{value}"' for name, value in (x.split("=") for x in rest))
    return f"<{tag}{attributes}{'' if mark is None else f' {MARK}={mark}'}>", f"</{tag}>"


def _paragraph(draw: random.Random, text: str) -> str:
    words = html.escape(text, quote=False).split(" ")
    if len(words) > 6 and draw.random() < 0.3:
        i = draw.randrange(len(words) - 2)
        words[i] = f'<a href="/x">{words[i]}'
        words[i + 1] += "</a>"
    if draw.random() < 0.2:
        words[0] = f"<b>{words[0]}</b>"
    return " ".join(words)


def _body(draw: random.Random, texts: list[str]) -> str:
    """Paragraphs, headings, lists, quotes and cells that carry the content."""
    out = []
    if draw.random() < 0.8:
        title = _paragraph(draw, texts[0][: draw.choice((6, 12, 25, 60))])
        out.append(f"<header><h1>{title}</h1></header>" if draw.random() < 0.08 else f"<h1>{title}</h1>")
    for text in texts:
        kind = draw.random()
        part = _paragraph(draw, text)
        if kind < 0.7:
            out.append(f"<p>{part}</p>")
        elif kind < 0.78:
            out.append(f"<h2>{part[:50] if '<' not in part else 'x'}</h2>")
        elif kind < 0.86:
            out.append("<ul>" + "".join(f"<li>{html.escape(x, quote=False)}</li>" for x in (text[:40], text[40:90], text[90:150]) if x.strip()) + "</ul>")
        elif kind < 0.9:
            out.append(f"<blockquote><p>{part}</p></blockquote>")
        elif kind < 0.94:
            out.append(f"<table><tr><td>{part}</td><td>{html.escape(text[:12], quote=False)}</td></tr></table>")
        elif kind < 0.97:
            out.append(f"<figure><img src=x><figcaption>{part}</figcaption></figure>")
        else:
            out.append(f"<div><p>{part}</p></div>")
    return "".join(out)


def _filling(draw: random.Random, region: str, long: list[str], short: list[str]) -> str:
    def brief() -> str:
        return html.escape(draw.choice(short)[: draw.randrange(4, 41)], quote=False)

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{i}">{brief()}</a></li>' for i in range(n))

    prose = html.escape(draw.choice(long), quote=False)
    if region == "menu":
        return links(draw.randrange(2, 9))
    if region == "share":
        return links(draw.randrange(1, 4)) if draw.random() < 0.6 else brief()
    if region == "comments":
        entries = [(brief(), html.escape(draw.choice(long), quote=False)) for _ in range(draw.randrange(1, 5))]
        return "<h3>" + brief() + "</h3>" + "".join(f"<div><b>{who}</b><p>{said}</p></div>" if draw.random() < 0.5 else f"<li><p>{said}</p></li>" for who, said in entries)
    if region == "form":
        return f"<p>{prose[:60].split('&')[0]}</p><label>{brief()}</label><input name=q><button>x</button>"
    if region in ("header", "footer"):
        head = f"<h1>{brief()}</h1>" if region == "header" and draw.random() < 0.7 else ""
        if head and draw.random() < 0.5:
            return head
        return head + (f"<ul>{links(3)}</ul>" if draw.random() < 0.5 else f"<p>{brief()}</p>")
    if region == "sidebar":
        head = f"<h3>{brief()}</h3>" if draw.random() < 0.7 else ""
        return head + (f"<ul>{links(4)}</ul>" if draw.random() < 0.5 else f"<p>{prose if draw.random() < 0.6 else brief()}</p>")
    return f"<p>{prose}</p>" if draw.random() < 0.6 else prose


def dress(seed: str, long: list[str], short: list[str]) -> str:
    """A page of the given texts in a layout drawn by ``seed``, its regions marked ``1`` (content) or ``0``.

    ``long`` are paragraphs, ``short`` texts of links and captions; both must have an entry. Some pages are
    nothing but content: a body of paragraphs, or text without any element, which needs no mark.
    """
    draw = random.Random(seed)
    if (bare := draw.random()) < 0.1:
        texts = long[: 1 + draw.randrange(len(long))]
        return html.escape("\n".join(texts), quote=False) if bare < 0.05 else f"<body {MARK}=1>{_body(draw, texts)}</body>"

    def region(kind: str) -> str:
        begin, end = _open(_pick(draw, REGIONS[kind]), "0")
        return begin + _filling(draw, kind, long, short) + end

    begin, end = _open(_pick(draw, CONTENT), "1")
    chosen = long if draw.random() < 0.6 else long[: 1 + draw.randrange(len(long))]
    brief = 1.0 if draw.random() < 0.15 else 0.15
    chosen = [draw.choice(short)[: draw.randrange(4, 30)] if draw.random() < brief else text for text in chosen]
    body = _body(draw, chosen[:2] if brief == 1.0 else chosen)
    for kind in ("advert", "share", "comments", "form", "sidebar"):
        if draw.random() < 0.2:
            inner = region(kind)
            body = body + inner if kind == "comments" or draw.random() < 0.5 else inner + body
    parts = [begin + body + end]
    if begin.startswith("<td"):
        parts = [f"<table><tr>{parts[0]}</tr></table>"]
    for kind in ("menu", "header", "notice", "advert"):
        if draw.random() < 0.6:
            parts.insert(0 if draw.random() < 0.7 else len(parts), region(kind))
    for kind in ("sidebar", "comments", "form", "footer"):
        if draw.random() < 0.55:
            parts.insert(len(parts) if draw.random() < 0.8 else 0, region(kind))
    if draw.random() < 0.4:
        a, b = sorted((draw.randrange(len(parts) + 1), draw.randrange(len(parts) + 1)))
        start, stop = _open(draw.choice(WRAPPERS))
        parts[a:b] = [start + "".join(parts[a:b]) + stop]
    if draw.random() < 0.5:
        start, stop = _open(draw.choice(WRAPPERS))
        parts = [start, *parts, stop]
    return f"<html><head><title>{html.escape(short[0], quote=False)}</title></head><body>{''.join(parts)}</body></html>"
