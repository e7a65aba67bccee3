"""Leaf blocks of an HTML page: runs of text between block-level tags, with what surrounds them.

The scanner goes over the page once and keeps the stack of open elements, closed as browsers do where a
page leaves tags open. Comments, scripts, styles and other elements without readable text are skipped
whole. All steps are linear in the page's length, however broken the page is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

# HTML's element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template svg math iframe object canvas audio video title textarea select datalist head".split())
RAW = frozenset("script style title textarea iframe noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output progress q ruby rb rp rt s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
#: A start tag of the key closes open elements of the value.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "option": ("option",), "body": ("head",),
}
#: Elements that tell what a block below them is.
CONTEXT = frozenset(
    "article main section nav header footer aside form ul ol li dl dd dt table td th figure figcaption blockquote pre p div h1 h2 h3 h4 h5 h6 address button label "
    "details summary fieldset dialog body".split()
)
#: Elements that may stand in a page's head.
HEADISH = frozenset("meta link base script style title noscript template".split())
#: Elements that a closing search does not go beyond.
BARRIER = frozenset("table td th body html ul ol dl div section article aside main nav header footer form".split())

# Words of class, id and role that say what an element is for.
HINTS = {
    "main": "article content main post entry story body text page prose blogpost maincontent articlebody",
    "aside": (
        "nav navigation navbar menu menubar header masthead banner logo topbar footer foot bottom copyright legal colophon sidebar side aside rail widget related "
        "recommended more popular trending ad ads adv advert advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup "
        "modal overlay dialog subscribe subscription newsletter signup signin login register search form comment comments reply replies respond disqus discussion "
        "reader readers share sharing social follow tags breadcrumb breadcrumbs pagination pager toolbar skip contentinfo complementary feedback rating survey"
    ),
}
HINT_OF = {w: kind for kind, listed in HINTS.items() for w in listed.split()}

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_END = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++)))?+""")
_NAME_PART = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: The attribute of labelled pages: 1 for main text, 0 for the rest; the nearest one counts.
LABEL = "data-main"


class Open:
    """An open element: tag, all tags and hint words of it and above it, label, and the innermost
    element at or above it that is not inline."""

    __slots__ = ("tag", "tags", "words", "label", "block", "score")

    def __init__(self, tag: str, tags: frozenset, words: frozenset, label: int | None, block: Open | None):
        self.tag, self.tags, self.words, self.label, self.score = tag, tags, words, label, None
        self.block = block or self


@dataclass(slots=True)
class Block:
    """A leaf block: its text, the length of the text inside links, its line breaks, and the element around it."""

    text: str
    linked: int
    breaks: int
    around: Open


def _named(attributes: str) -> tuple[frozenset, int | None]:
    """Hint words of class, id and role, and the label."""
    words: set[str] = set()
    label = None
    for name, *values in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role"):
            words.update(w for w in _NAME_PART.findall(_CAMEL.sub(" ", "".join(values)).lower()) if w in HINT_OF)
        elif name == LABEL:
            label = int("".join(values) or 0)
    return frozenset(words), label


_RAW_END = {t: re.compile(f"</{t}(?=[\\s/>])", re.I) for t in RAW}


def _after_raw(html: str, at: int, tag: str) -> int:
    """Position after the end tag of an element whose content is plain text."""
    m = _RAW_END[tag].search(html, at)
    end = -1 if m is None else html.find(">", m.end())
    return len(html) if end < 0 else end + 1


class _Stack:
    """Open elements, with the places of each tag and of the barriers, so that no search walks the stack."""

    def __init__(self):
        self.items = [Open("", frozenset(), frozenset(), None, None)]
        self.places: dict[str, list[int]] = {}
        self.barriers: list[int] = []
        self.links = self.skipped = 0

    def last(self, tag: str) -> int:
        """Place of the innermost open element of a tag, -1 if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else -1

    def barrier(self, but: tuple[str, ...] = ()) -> int:
        """Place of the innermost barrier whose tag is not in ``but``."""
        for k in reversed(self.barriers):
            if self.items[k].tag not in but:
                return k
        return 0

    def push(self, opened: Open) -> None:
        k, tag = len(self.items), opened.tag
        self.items.append(opened)
        self.places.setdefault(tag, []).append(k)
        if tag in BARRIER:
            self.barriers.append(k)
        self.links += tag == "a"
        self.skipped += tag in SKIPPED

    def close(self, k: int) -> None:
        """Close the elements from place ``k`` on."""
        while len(self.items) > k:
            tag = self.items.pop().tag
            self.places[tag].pop()
            if tag in BARRIER:
                self.barriers.pop()
            self.links -= tag == "a"
            self.skipped -= tag in SKIPPED

    def end(self, tag: str) -> None:
        """An end tag: closes its element and all inside; inline ones not across a table cell."""
        k = self.last(tag)
        if k > 0 and not (tag in INLINE and max(self.last("td"), self.last("th")) > k):
            self.close(k)

    def make_way(self, tag: str) -> None:
        """Close what a start tag ends without an end tag."""
        if self.last("head") > 0 and tag not in HEADISH:
            self.close(self.last("head"))
        if tag not in INLINE and self.last("p") > self.barrier():
            self.close(self.last("p"))
        if tag == "a" and self.last("a") > self.barrier():
            self.close(self.last("a"))
        ends = CLOSES.get(tag, ())
        if any(self.last(t) > 0 for t in ends):
            low = self.barrier(ends)
            while (k := max(self.last(t) for t in ends)) > low:
                self.close(k)


def blocks(html: str) -> Iterator[Block]:
    """The leaf blocks of a page in order, without empty ones."""
    stack = _Stack()
    held: list[str] = []
    linked = breaks = at = 0
    n = len(html)

    def flush() -> Block | None:
        nonlocal linked, breaks
        text = " ".join("".join(held).split())
        found = Block(text, min(linked, len(text)), breaks, stack.items[-1].block) if text else None
        held.clear()
        linked = breaks = 0
        return found

    def take(piece: str) -> None:
        nonlocal linked
        if piece and not stack.skipped:
            piece = unescape(piece) if "&" in piece else piece
            held.append(piece)
            if stack.links:
                linked += len(piece.strip())

    while at < n:
        start = html.find("<", at)
        if start < 0:
            take(html[at:])
            break
        take(html[at:start])
        if html.startswith("<!--", start):
            end = html.find("-->", start + 2)
            at = n if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), start):
            end = html.find(">", start)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(html, start)
        if m is None:
            take("<")
            at = start + 1
            continue
        closed = _END.match(html, m.end())
        if closed is None:  # the page ends inside a tag
            break
        at, tag = closed.end(), m.group(2).lower()
        inline = tag in INLINE
        if held and not inline and tag != "br":
            found = flush()
            if found:
                yield found
        if m.group(1):
            stack.end(tag)
            continue
        if tag == "br":
            if not stack.skipped:
                held.append(" ")
                breaks += 1
            continue
        stack.make_way(tag)
        if tag in RAW:
            at = _after_raw(html, at, tag)
            continue
        if tag in VOID:
            continue
        above = stack.items[-1]
        if inline:
            stack.push(Open(tag, above.tags, above.words, above.label, above.block))
            continue
        attributes = html[m.end() : at - 1]
        words, label = _named(attributes) if attributes.strip() else (frozenset(), None)
        tags = above.tags | {tag} if tag in CONTEXT and tag not in above.tags else above.tags
        stack.push(Open(tag, tags, above.words | words if words else above.words, above.label if label is None else label, None))
    found = flush()
    if found:
        yield found
