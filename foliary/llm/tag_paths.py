"""Main text of web pages by tag-path ratios.

A page is a sequence of text blocks, each with the path of tags from the root to it. Text length and punctuation are summed
per path and divided by the path's blocks; the product of both ratios is smoothed along the page, fused with a weight for
what elements, roles and words of class and id say, and held against a threshold (a share of its spread). Every block that
passes is content, wherever it stands. A node (the element around paragraphs, lists and tables) whose blocks pass in the mean,
weighted by length, is content too, so that its short lines and lists stay; so are the nodes below it, whatever the length of their
blocks: a list, table, code or section inside an article stays with the article. Blocks known as menus, headers, footers, sidebars,
notices, adverts, forms or comments have a small weight, which a ratio far above the page's others outweighs. Class and id names count as
wholes or by their head, the last part that isn't a general one (``site-footer`` and ``nav-list`` do, ``sidebar-layout`` doesn't); a ``header`` inside an article is its own.

Character references are decoded; white space inside a block becomes one space; blocks without text vanish. Null or empty
html, or a page of boilerplate alone, gives an empty text. Pages may end anywhere, tags may be left open. Whole pages are
read; nothing is cut. Repeated rows repeat; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from foliary.llm.common import quiet_threads, slices

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
# How HTML treats its elements.
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
_CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
_CLOSES_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = {"ul", "ol", "dl", "table", "select", "menu"}
# Elements that are no text of a page, and elements, roles and words of class and id that speak against a block.
_NOT_TEXT = {"head", "script", "style", "noscript", "iframe", "template", "textarea", "title", "button", "select", "option", "svg", "canvas", "object", "dialog", "xmp"}
_DOUBTED = {"nav", "header", "footer", "aside", "form", "menu"}
_GENERAL = {"area", "bar", "block", "body", "box", "container", "content", "group", "inner", "item", "items", "line", "link", "links", "list", "outer", "panel", "row", "section", "top", "bottom", "left", "right", "unit", "wrap", "wrapper"}
_NOT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar", "toolbar"}
_NOT_WORDS = re.compile(r"^(?:nav\w*|menu\w*|foot(?:er)?|header|masthead|side(?:bar)?|aside|ads?|adv|advert\w*|banner|promo\w*|sponsor\w*|cookies?|notices?|consent|gdpr|popup|modal|overlay|comments?|commentlist|disqus|replies|respond|discussion|share|sharing|social|related|recommend\w*|breadcrumbs?|pagination|pager|subscribe|subscription|newsletter|login|signin|signup|search|form|toolbar|widget|legal|copyright|disclaimer|skip|hidden)$")
# Weight of a doubted block, and the product of ratios (some 200 characters, 5 signs) from which it counts at all.
_DOUBT, _SENTENCES = 0.02, 1000.0
_HEADS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_PARTS = _HEADS | {"p", "li", "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", "table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "figure", "figcaption", "fieldset", "legend", "address"}
_PUNCTUATION = re.compile(r"[.,;:!?…](?!\w)|[。，、；：！？]")  # the stops of an address are none


class _Element:
    __slots__ = ("doubted", "name", "number", "out", "parent")

    def __init__(self, name: str, parent: _Element | None, number: int, out: bool, doubted: bool = False) -> None:
        self.name, self.parent, self.number, self.out, self.doubted = name, parent, number, out, doubted


def _speaks_against(name: str) -> bool:
    """Whether a name of class or id says that a block is something else: as a whole, or by its head."""
    if _NOT_WORDS.match(name):
        return True
    parts = [w for w in re.split(r"[_-]+", name) if w]
    while len(parts) > 1 and (parts[-1] in _GENERAL or parts[-1].isdigit()):
        parts.pop()
    return bool(parts) and bool(_NOT_WORDS.match(parts[-1]))


def _is_out(name: str, attributes: str, parent: _Element) -> tuple[bool, bool]:
    """(never shown as text, known as something else than the article)."""
    if name in _NOT_TEXT:
        return True, True
    doubted = name in _DOUBTED and not (name == "header" and _within(parent, "article"))
    if not attributes:
        return False, doubted
    if re.search(r"\bhidden\b(?!\s*=\s*[\"']?(?:false|until-found))", re.sub(r"=\s*(?:\"[^\"]*\"|'[^']*')", "", attributes)):
        return True, True
    for key, *values in _ATTRIBUTE.findall(attributes):
        value, key = "".join(values).lower(), key.lower()
        if key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, True
        if key in ("class", "id") and name not in ("html", "body", "article", "main") and any(map(_speaks_against, value.split())):
            doubted = True
        if key == "role" and value in _NOT_ROLES:
            doubted = True
    return False, doubted


def blocks(page: str) -> list[tuple[str, _Element, int]]:
    """(text, innermost block element, characters of it in links) of each block in page order."""
    root = _Element("#root", None, 0, False)
    here, number, found = root, 0, []
    parts: list[str] = []
    linked: list[int] = [0]
    in_link = at = 0

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                found.append((text, here, linked[0]))
            parts.clear()
        linked[0] = 0

    size = len(page)
    while at < size:
        m = _TAG.search(page, at)
        upto = m.start() if m else size
        if upto > at:
            parts.append(page[at:upto])
            if in_link:
                linked[0] += upto - at
        if not m:
            break
        at = max(m.end(), upto + 1)
        name = m.group(2)
        if not name:
            continue
        name = name.lower()
        if m.group(1):
            if name in _INLINE:
                in_link = 0 if name == "a" else in_link
                continue
            x = here
            while x.parent is not None and x.name != name:
                x = x.parent
            flush()
            if x.parent is not None:
                here = x.parent
            continue
        if name in _INLINE:
            in_link = 1 if name == "a" else in_link
            continue
        if name in ("br", "wbr", "img", "input", "embed"):
            parts.append(" " if name != "wbr" else "")
            continue
        flush()
        if name in _VOID:
            continue
        if name in _CLOSES_P or name in _CLOSES_LIKE:
            shut = _CLOSES_LIKE.get(name, set()) | ({"p"} if name in _CLOSES_P else set())
            x, top = here, None
            while x.parent is not None and x.name not in _SCOPES:
                if x.name in shut:
                    top = x
                if x.name in ("div", "section", "article", "main", "body") and name in _CLOSES_P:
                    break
                x = x.parent
            if top is not None:
                here = top.parent
        if name == "body":
            while here.parent is not None and here.name != "html":
                here = here.parent
        number += 1
        out, doubted = _is_out(name, m.group(3), here)
        element = _Element(name, here, number, here.out or out, here.doubted or doubted)
        if m.group(3).rstrip().endswith("/") and name not in _CLOSES_P:
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        here, in_link = element, 0
    flush()
    return found


def _within(element: _Element | None, name: str) -> bool:
    while element is not None and element.name != name:
        element = element.parent
    return element is not None


def _path(element: _Element) -> str:
    names = []
    while element.parent is not None:
        names.append(element.name)
        element = element.parent
    return ">".join(reversed(names))


def _smooth(x: np.ndarray, reach: int = 2) -> np.ndarray:
    kernel = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * max(1.0, reach / 2) ** 2))
    padded = np.pad(x, reach)
    weight = np.convolve(np.pad(np.ones(len(x)), reach), kernel / kernel.sum(), "valid")
    return np.convolve(padded, kernel / kernel.sum(), "valid") / weight


def path_ratios(found: list[tuple[str, _Element, int]], length: np.ndarray) -> np.ndarray:
    """Per block the product of its path's ratios: text outside links, and punctuation, by the path's blocks."""
    paths = [_path(e) for _, e, _ in found]
    names = {p: i for i, p in enumerate(dict.fromkeys(paths))}
    code = np.array([names[p] for p in paths])
    signs = np.array([len(_PUNCTUATION.findall(t)) for t, _, _ in found], float)
    nodes = np.bincount(code)
    ratio = [(np.bincount(code, x) / nodes)[code] for x in (length, signs)]
    return ratio[0] * (ratio[1] + 0.1)


def content_flags(found: list[tuple[str, _Element, int]], share: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """(selected, fused ratio) per block."""
    length = np.array([len(t) - min(k, len(t)) for t, _, k in found], float)
    product = path_ratios(found, length)
    # a path of links alone has no ratio of its own, whatever stands beside it; a heading may be a link
    shown = np.array([not e.out for _, e, _ in found]) & ((product > 0) | np.array([e.name in _HEADS for _, e, _ in found]))
    doubted = np.array([e.doubted for _, e, _ in found])
    fused = np.zeros(len(found))
    if not shown.any():
        return shown, fused
    own = product * np.where(doubted, _DOUBT, 1)
    for kind, weight in ((shown & ~doubted, 1), (shown & doubted, _DOUBT)):  # neither kind lends the other its ratios
        if kind.any():
            fused[kind] = _smooth(product[kind]) * weight
    inside = shown & (~doubted | (product >= _SENTENCES))
    limit = share * fused[shown].std()
    # nodes by the mean of their blocks, each weighted by its length
    node = np.array([_node(e) for _, e, _ in found])
    free = inside & ~doubted
    weight = np.bincount(node[free], length[free], node.max() + 1)
    total = np.bincount(node[free], (length * fused)[free], node.max() + 1)
    passed = (total >= limit * weight) & (total > 0)
    # what only its neighbours lift over the limit must be a heading or share its node with a block that needs none
    alone = inside & (own >= limit) & (own > 0)
    holds = np.bincount(node[alone], minlength=node.max() + 1) > 0
    lifted = inside & (fused >= limit) & (fused > 0) & (holds[node] | np.array([e.name in _HEADS for _, e, _ in found]))
    rides = (passed & holds)[node]
    for i in np.flatnonzero(free & ~rides):  # with a node around it, but not with the whole page
        x = found[i][1].parent
        while x is not None and x.name not in ("body", "html", "#root") and not rides[i]:
            rides[i] = (holds & passed)[x.number] if x.number < len(holds) else False
            x = x.parent
    return alone | lifted | free & rides, fused


def main_text(page: str | None) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    selected, _ = content_flags(found)
    return "\n".join(found[i][0] for i in np.flatnonzero(selected))


def _node(element: _Element) -> int:
    """The element around the paragraphs, lists and tables that a block belongs to."""
    while element.name in _PARTS and element.parent is not None:
        element = element.parent
    return element.number


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for start, stop in slices(batch.column("html"), 8_000_000):
                part = batch.slice(start, stop - start)
                found = [main_text(h.as_py()) for h in part.column("html")]
                yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
