"""The block structure of an HTML page: elements that hold text, and their runs of text."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names with a meaning of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is no text of the page.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
UNSEEN = frozenset("head script style title textarea iframe noembed noframes noscript template object svg math canvas audio video select button datalist map".split())
INLINE = frozenset(
    "a abbr acronym b basefont bdi bdo big blink cite code data del dfn em font i img input ins kbd label link mark meta meter nobr output picture progress q rp rt ruby "
    "s samp small source span strike strong sub sup time track tt u var wbr area base col embed param".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p "
    "pre search section summary table ul".split()
)
# A start tag ends an open element of these names, up to the nearest of those that hold it.
ENDS = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th caption colgroup", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "thead": ("thead tbody tfoot tr td th caption colgroup", "table"), "tbody": ("thead tbody tfoot tr td th caption colgroup", "table"), "tfoot": ("thead tbody tfoot tr td th caption colgroup", "table"),
    "body": ("head", "html"),
}
_ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
# An end tag inside these does not close what stands outside of them.
SCOPES = frozenset(["table", "td", "th", "caption"])

_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|<(?=[a-zA-Z/!?])[^>]*\Z|([^<]+|<)""", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+))""")


@dataclass
class Page:
    """Nodes in page order, each behind its parent. ``texts[i]`` is ``None`` for an element."""

    parents: list[int] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    texts: list[str | None] = field(default_factory=list)
    link_chars: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, attributes: str = "", text: str | None = None, links: int = 0) -> int:
        self.parents.append(parent)
        self.tags.append(tag)
        self.attributes.append(attributes)
        self.texts.append(text)
        self.link_chars.append(links)
        return len(self.parents) - 1


def attribute_values(attributes: str) -> dict[str, str]:
    """Attributes with a value, first one of a name; character references decoded."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), html.unescape("".join(values)))
    return found


def parse(source: str) -> Page:
    """Elements other than inline ones, and runs of text between their tags as leaves.

    End tags may be missing, wrong or unmatched: a start tag ends what it cannot stand in, the end of an
    element ends all inside it, an unmatched end tag is ignored. Character references are decoded and any white space,
    also a line break element, becomes one space. Scripts, styles, form controls, embedded media and comments
    hold no text. Nothing recurses, so depth has no bound.
    """
    page = Page()
    root = page.add(-1, "#page")
    stack: list[tuple[str, int]] = [("#page", root)]
    run: list[str] = []
    linked = 0
    link_at = 0  # depth of the stack where a link is open, else 0
    paragraphs = 0  # open ones
    unseen = 0  # depth of the stack where an element without text is open, else 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                page.add(stack[-1][1], "#text", "", text, min(linked, len(text)))
            run.clear()
        linked = 0

    def cut(depth: int) -> None:
        nonlocal link_at, unseen, paragraphs
        paragraphs -= sum(name == "p" for name, _ in stack[depth:])
        del stack[depth:]
        if link_at > depth:
            link_at = 0
        if unseen >= depth:
            unseen = 0

    at, end = 0, len(source)
    while at < end:
        m = _TOKEN.match(source, at)
        at = m.end()
        text = m[7]
        if text is not None:
            if not unseen:
                text = html.unescape(text) if "&" in text else text
                run.append(text)
                if link_at:
                    linked += len(text.strip())
            continue
        name = m[2] or m[5]
        if name is None:
            continue
        tag = name.lower()
        if m[1] or m[4]:
            if tag == "a":
                link_at = 0
            elif tag == "br":
                run.append(" ")
            elif tag not in INLINE:
                if tag == "p":
                    flush()
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == tag:
                        flush()
                        cut(depth)
                        break
                    if stack[depth][0] in SCOPES and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                        break
            continue
        if tag == "br":
            run.append(" ")
            continue
        attributes = m[3] or m[6] or ""
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(source, at)
            at = close.end() if close else end
            continue
        if tag == "a":
            link_at = len(stack)
            continue
        if tag == "html" or tag in INLINE and tag not in UNSEEN:
            continue
        flush()
        if stack[-1][0] == "head" and tag not in UNSEEN and tag not in VOID:
            cut(len(stack) - 1)
        if tag in CLOSES_P and paragraphs:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    cut(depth)
                    break
                if stack[depth][0] in SCOPES:
                    break
        if tag in _ENDS:
            ended, holders = _ENDS[tag]
            lowest = 0
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in holders:
                    break
                if stack[depth][0] in ended:
                    lowest = depth
            if lowest:
                cut(lowest)
        if tag in VOID:
            continue
        if tag in UNSEEN and not unseen:
            unseen = len(stack)
        paragraphs += tag == "p"
        stack.append((tag, root if unseen else page.add(stack[-1][1], tag, attributes)))
    flush()
    return page
