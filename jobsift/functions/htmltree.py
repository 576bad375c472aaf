"""A page as a small element tree, in time linear in its length whatever it holds.

Columns of regular expressions cannot tell an element's parent or the kinds of
quotes and entities, which the field rules need; so pages are parsed in Arrow
batches, each page by itself. No text is an error: what is not markup is text, and
markup that never ends is skipped as browsers do.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SILENT = frozenset(("script", "style"))
#: Elements beyond which a new p or li does not close an older one.
P_SCOPE, LI_SCOPE = ("td", "th", "button"), ("ul", "ol")

_MARKUP = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"[a-zA-Z][^\t\n\r\f />\x00]*+")
# What stands between a tag's name and its end; a quote counts only behind an equals sign.
_INSIDE = re.compile(r"""(?:[^>=]++|=[\t\n\r\f ]*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+>""")
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {t: re.compile(rf"</{t}(?=[\t\n\r\f />])", re.I) for t in SILENT}


def attributes(inside: str) -> dict[str, str]:
    """The attributes written between a tag's name and its end, names in lower case; the first of a name counts."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(inside):
        name = m[1].lower()
        if name not in out:
            value = m[2] or m[3] or m[4] or ""
            out[name] = unescape(value) if "&" in value else value
    return out


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """("text", "", text), ("start", tag, inside) and ("end", tag, "") in document order.

    Comments, declarations and processing instructions are skipped, and so is
    whatever begins with ``<![``. A comment that never ends reaches to the end of the
    page. Contents of scripts and styles are skipped. A tag whose quotes never end is ended
    by the next ``>``; from there on quotes no longer count, so that at most one search per page reaches the
    end in vain. A tag without any end is text.
    """
    at, text_from, size, quotes = 0, 0, len(html), True
    while True:
        m = _MARKUP.search(html, at)
        if m is None:
            break
        begin = m.start()
        mark = html[begin + 1]
        name = None
        if mark == "!" and html.startswith("--", begin + 2):
            end = _COMMENT_END.search(html, begin + 2)
            after = end.end() if end else size
        elif mark in "!?" or mark == "/" and not html[begin + 2:begin + 3].isascii() or mark == "/" and not html[begin + 2:begin + 3].isalpha():
            after = html.find(">", begin + 2) + 1
        else:
            name = _NAME.match(html, begin + (2 if mark == "/" else 1))
            end = _INSIDE.match(html, name.end()) if quotes else None
            after = end.end() if end else html.find(">", name.end()) + 1
            quotes = quotes and (end is not None or not after)
        if not after:
            break                                       # no tag ends any more: the rest is text
        if begin > text_from:
            yield "text", "", _decoded(html[text_from:begin])
        if name is not None:
            tag = name[0].lower()
            if mark == "/":
                yield "end", tag, ""
            else:
                yield "start", tag, html[name.end():after - 1]
                if tag in SILENT:
                    close = _RAW_END[tag].search(html, after)
                    after = close.start() if close else size
        at = text_from = after
    if text_from < size:
        yield "text", "", _decoded(html[text_from:])


def _decoded(text: str) -> str:
    return unescape(text) if "&" in text else text


def hrefs(html: str | None) -> list[str]:
    """The href of each link, in document order, without building the tree."""
    return [attributes(inside).get("href", "") for kind, tag, inside in tokens(html or "") if kind == "start" and tag == "a"]


class Page:
    """Elements as (tag, inside, parent, first text, last text) and text nodes as (text, parent), in document order.

    A new p ends an open one, as do block elements; a new li ends the one open in
    the same list. Scripts, styles and comments give no text.
    """

    def __init__(self, html: str | None):
        self.tags: list[str] = []
        self.inside: list[str] = []
        self.parents: list[int] = []
        self.first_text: list[int] = []
        self.last_text: list[int] = []
        self.texts: list[tuple[str, int]] = []
        self._open: list[int] = []
        self._depths: dict[str, list[int]] = {}             # where each tag is open, so that none is looked for
        for kind, tag, inside in tokens(html or ""):
            if kind == "text":
                self.texts.append((inside, self._open[-1] if self._open else -1))
            elif kind == "start":
                self._start(tag, inside)
            elif tag not in VOID:
                self._close_tag(tag)
        self._close_to(0)

    def _close_to(self, depth: int) -> None:
        while len(self._open) > depth:
            element = self._open.pop()
            self._depths[self.tags[element]].pop()
            self.last_text[element] = len(self.texts)

    def _close_tag(self, tag: str, scope: tuple[str, ...] = ()) -> None:
        depths = self._depths.get(tag)
        if depths and all(not self._depths.get(s) or self._depths[s][-1] < depths[-1] for s in scope):
            self._close_to(depths[-1])

    def _start(self, tag: str, inside: str) -> None:
        if tag in CLOSES_P:
            self._close_tag("p", P_SCOPE)
        if tag == "li":
            self._close_tag("li", LI_SCOPE)
        self.tags.append(tag)
        self.inside.append(inside)
        self.parents.append(self._open[-1] if self._open else -1)
        self.first_text.append(len(self.texts))
        self.last_text.append(len(self.texts))
        if tag not in VOID:
            self._depths.setdefault(tag, []).append(len(self._open))
            self._open.append(len(self.tags) - 1)

    def elements(self, *tags: str):
        return (i for i, t in enumerate(self.tags) if t in tags)

    def text(self, element: int) -> str:
        """All text inside an element: nodes stripped and joined."""
        return "".join(t.strip() for t, _ in self.texts[self.first_text[element]:self.last_text[element]])

    def first_text_like(self, pattern, parents=None) -> str:
        """The first text node that matches, under one of the parent tags if given, stripped; '' if none."""
        for t, p in self.texts:
            if pattern.search(t) and (parents is None or (p >= 0 and self.tags[p] in parents)):
                return t.strip()
        return ""

    def beside_image(self, alt: str) -> str:
        """Whole text of the parent of the first image with this alt text; '' if none."""
        for i in self.elements("img"):
            if attributes(self.inside[i]).get("alt") == alt:
                return self.text(self.parents[i]) if self.parents[i] >= 0 else ""
        return ""

    def links(self, fragment: str) -> list[tuple[int, str]]:
        found = ((i, attributes(self.inside[i]).get("href", "")) for i in self.elements("a"))
        return [(i, href) for i, href in found if fragment in href]

    def blocks(self) -> list[str]:
        return [self.text(i) for i in self.elements("p", "li")]
