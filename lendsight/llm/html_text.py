"""Main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|(?=[\"'])[^>]*+(?:>|\Z)|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre search section summary "
    "table tbody tfoot thead tr ul".split()
)
#: An opening tag that ends an open element of the kinds named, unless one of the fences lies between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
ENDS_P = BLOCK - {"html", "head", "body", "option", "caption", "tbody", "tfoot", "thead", "tr"}
FENCES_P = {"article", "aside", "body", "button", "div", "main", "section", "td", "th", "li", "blockquote", "nav", "footer", "header"}

NEVER = frozenset("head nav footer aside form button select input textarea dialog menu search label fieldset".split()) | RAW
#: Of the kinds that are never an article, those that may be wrapped around one.
WRAPPERS = frozenset("form label fieldset dialog".split())
#: Foreign elements: an opening tag of theirs that ends in a slash is empty.
FOREIGN = frozenset(["svg", "math"])
CONTENT = frozenset(["article", "main"])
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu menubar".split())
NOISE = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice alert popup modal overlay newsletter subscribe subscription signup login paywall nav navbar navigation menu "
    "breadcrumb breadcrumbs pagination pager sidebar rail related recommended recommendations widget share sharing social "
    "toolbar footer copyright masthead topbar header comment comments commentlist respond reply replies disqus discussion "
    "hidden".split()
)
#: What a name of noise leaves of the density of an element and all it holds.
LOWERED = 0.1
#: Pieces of running text, which have to bear such a name as a whole.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th a b i em strong span blockquote pre code figure".split())


class Page:
    """Elements of a page in the order they open: every element comes after its parent."""

    def __init__(self, html: str):
        self.tag, self.parent = ["#page"], [-1]
        #: Left out by kind, role or because it is not shown; and named like noise.
        self.noise, self.named = [False], [False]
        self.chars, self.linked, self.in_content = [0], [False], [False]
        #: (element, text) in page order; element -1 marks the border of a block.
        self.flow: list[tuple[int, str]] = []
        self._parse(html)

    def _open(self, tag: str, attributes: str, parent: int) -> int:
        noise, named = self._judge(tag, attributes, parent)
        self.tag.append(tag)
        self.parent.append(parent)
        self.noise.append(noise)
        self.named.append(named)
        self.linked.append(tag == "a" or self.linked[parent])
        self.in_content.append(tag in CONTENT or self.in_content[parent])
        self.chars.append(0)
        return len(self.tag) - 1

    def _judge(self, tag: str, attributes: str, parent: int) -> tuple[bool, bool]:
        if tag in NEVER:
            return True, False
        if tag in ("html", "body", "main"):
            return False, False
        if tag == "header" and not self.in_content[parent]:
            return True, False
        if "=" not in attributes and "hidden" not in attributes:
            return False, False
        values = {k.lower(): unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(attributes)}
        given = " ".join([values.get("class", ""), values.get("id", "")])
        names = {n.lower() for n in (given.split() if tag in RUNNING or tag == "article" else NAME_PART.findall(given))}
        if tag == "header" or re.fullmatch("h[1-6]", tag):
            names.discard("header")
        style = values.get("style", "").replace(" ", "").lower()
        unseen = (
            values.get("role", "").lower() in ROLES or values.get("aria-hidden") == "true"
            or "display:none" in style or "visibility:hidden" in style
            or bool(re.search(r"(?:^|\s)hidden(?:\s|=|$)", ATTRIBUTE.sub(" ", attributes)))
        )
        return unseen, bool(names & NOISE)

    def _text(self, node: int, text: str) -> None:
        if text:
            text = unescape(text) if "&" in text else text
            self.chars[node] += len(text.strip())
            self.flow.append((node, text))

    def _parse(self, html: str) -> None:
        stack, at = [0], 0
        is_open: Counter = Counter()
        while (found := TOKEN.search(html, at)) is not None:
            self._text(stack[-1], html[at: found.start()])
            at = found.end()
            if found[2] is None:
                continue
            tag = found[2].lower()
            if tag in BLOCK:
                self.flow.append((-1, ""))
            elif tag in ("br", "td", "th"):
                self.flow.append((stack[-1], " "))
            if found[1]:
                self._close(stack, is_open, {tag}, frozenset())
                continue
            if tag in ENDS:
                self._close(stack, is_open, *ENDS[tag])
            elif tag in ENDS_P:
                self._close(stack, is_open, {"p"}, FENCES_P)
            node = self._open(tag, found[3], stack[-1])
            if tag in RAW and not (tag in FOREIGN and found[3].endswith("/")):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|\Z", re.I).search(html, at)
                at = end.end()
            elif tag not in VOID and not found[3].endswith("/"):
                stack.append(node)
                is_open[tag] += 1
        self._text(stack[-1], html[at:])

    def _close(self, stack: list[int], is_open: Counter, tags: set[str], fences: frozenset[str] | set[str]) -> None:
        """Close the innermost element of ``tags`` that no fence hides; without an open one the stack is not walked."""
        if not any(is_open[t] for t in tags):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[depth]]
            if tag in tags:
                is_open.subtract(self.tag[n] for n in stack[depth:])
                del stack[depth:]
                return
            if tag in fences:
                return


def _densities(page: Page, dropped: list[bool], weight: list[float]) -> tuple[list[float], list[float]]:
    """Composite density of each element, lowered by its weight, and the sum over its children.

    With C characters, T tags, LC characters and LT tags of links below an
    element (each at least one) and LCb / Cb the share of links in the page:
    C / T * log(C / LC * T / LT), the logarithm to the base
    ln(C / (C - LC) * LC + LCb / Cb * C + e).
    """
    size = len(page.tag)
    chars, tags, link_chars, link_tags = [0] * size, [0] * size, [0] * size, [0] * size
    for node in range(size - 1, -1, -1):
        if dropped[node]:
            continue
        chars[node] += page.chars[node]
        if page.linked[node]:
            link_chars[node] += page.chars[node]
        if (up := page.parent[node]) >= 0:
            chars[up] += chars[node]
            tags[up] += tags[node] + 1
            link_chars[up] += link_chars[node]
            link_tags[up] += link_tags[node] + (page.tag[node] == "a")
    share = link_chars[0] / max(chars[0], 1)
    density, sums = [0.0] * size, [0.0] * size
    for node in range(size - 1, -1, -1):
        if dropped[node] or not chars[node]:
            continue
        c, t = chars[node], max(tags[node], 1)
        links, free = max(link_chars[node], 1), max(c - link_chars[node], 1)
        base = math.log(c / free * links + share * c + math.e)
        linkless = max(c / links * t / max(link_tags[node], 1), 1.0)
        density[node] = weight[node] * c / t * math.log(linkless) / math.log(base)
        if (up := page.parent[node]) >= 0:
            sums[up] += density[node]
    return density, sums


def _core(page: Page, density: list[float], sums: list[float]) -> int:
    """The element with the greatest sum of child densities, the outermost of equal ones."""
    return max(range(len(page.tag)), key=lambda n: (sums[n], density[n], -n))


def main_text(html: str | None) -> str:
    """Blocks of the article in page order, one a line; empty if there are none.

    Elements that are no article by kind or role, or are not shown, are left
    out first, unless they hold the article. Each other element gets its
    characters per tag, lowered by the share of links in it, and lowered again
    if it or an element around it is named like a menu, notice, advert or
    comment; the element whose children have the greatest sum of densities is
    the core. A name alone loses no text: elements named like noise go only
    where they stand beside the core, hold at most half of its text (or of the
    article or main element below it that they are in), or where such an
    element is there to be taken instead. The
    least density on the way from the core to the body is the threshold:
    beside that way, an element at least as dense belongs to the text too. An
    article or main element around the core is taken whole. Where all text of
    a page stands in noscript elements, these are read.
    """
    text = _main_text(html or "")
    if not text and "<noscript" in (html or "").lower():
        text = _main_text(re.sub(r"(?i)</?noscript[^>]*>", "", html))
    return text


def _main_text(html: str) -> str:
    page = Page(html)
    size = len(page.tag)
    never = [tag in NEVER and tag not in WRAPPERS for tag in page.tag]
    weight = [1.0] * size
    for node in range(1, size):
        never[node] |= never[page.parent[node]]
        weight[node] = min(weight[page.parent[node]], LOWERED if page.named[node] else 1.0)
    holds = [tag in CONTENT and not out and w == 1 for tag, out, w in zip(page.tag, never, weight, strict=True)]
    chars = [0 if out else n for n, out in zip(page.chars, never, strict=True)]
    inner = [False] * size  # an article or main element below
    for node in range(size - 1, 0, -1):
        holds[page.parent[node]] |= holds[node]
        inner[page.parent[node]] |= holds[node]
        chars[page.parent[node]] += chars[node]
    for node, tag in enumerate(page.tag):
        holds[node] |= tag in WRAPPERS and 2 * chars[node] > chars[0]
    dropped = [False] * size
    for node in range(1, size):
        noisy = page.noise[node] and (never[node] or not holds[node])
        dropped[node] = dropped[page.parent[node]] or noisy
    density, sums = _densities(page, dropped, weight)

    core = _core(page, density, sums)
    path = [core]
    while path[-1] > 0:
        path.append(page.parent[path[-1]])
    way = set(path)
    host = [-1] * size  # the article or main element around a node below the core, or else the core
    for node in range(1, size):
        up = page.parent[node]
        within = up == core or (host[up] >= 0 and page.tag[up] in CONTENT and weight[up] == 1)
        host[node] = up if within else host[up]
        spared = node in way or (host[node] >= 0 and 2 * chars[node] > chars[host[node]] and not inner[host[node]])
        dropped[node] |= dropped[up] or (page.named[node] and not spared)
    around = [n for n in path if page.tag[n] in CONTENT]
    chosen = {around[-1] if around else core}
    if not around:
        threshold = min(density[n] for n in path)
        chosen.update(
            n for n in range(1, size) if page.parent[n] in way and n not in way and density[n] >= threshold > 0
        )
        if sums[core] == 0:
            chosen = {0}
    inside = [False] * size
    for node in range(size):
        inside[node] = not dropped[node] and (node in chosen or (node > 0 and inside[page.parent[node]]))

    blocks, held = [], []
    for node, text in [*page.flow, (-1, "")]:
        if node >= 0:
            if inside[node]:
                held.append(text)
        elif held:
            block = " ".join("".join(held).split())
            if block:
                blocks.append(block)
            held = []
    return "\n".join(blocks)


def extract_text(html: Column) -> Column:
    """``main_text`` of a column of whole pages; a NULL page gives an empty text."""

    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p) for p in pages.to_pylist()], pa.string())

    return extract(html)
