"""HTML as flat lists of elements and texts with exact source offsets.

One pass of a tolerant tokenizer; elements are closed by their end tag, by one of an ancestor, by an element that
implies their end, or by the end of the page. Offsets are code points, so `html[start:end]` is the exact slice. What
the elements mean to each other is found by intervals, in DataFrame code (operators.extract).
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "xmp"))
#: An opening tag closes an open element of these kinds (up to the nearest container).
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"},
}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select", "datalist"}, "optgroup": {"select"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
BLOCKS = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
INLINE = frozenset("a b i em span strong small u font p".split())
_END = re.compile(r"\s*(/?)>")
_TAG = re.compile(r"<!--|<!|<\?|</([A-Za-z][^\s/>]*)|<([A-Za-z][^\s/>]*)")
_ATTR = re.compile(r"""\s*(?:/(?!>)|([^\s=/>"'][^\s=/>]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?|(["']))""")

#: ARIA roles that make an element a control, and what they count as.
ROLES = {
    "link": "link", "menuitem": "link", "button": "button", "checkbox": "button", "switch": "button", "tab": "button",
    "menuitemcheckbox": "button", "radio": "button", "option": "button",
}
#: Elements that paint something in an SVG.
PAINTS = re.compile(r"<(path|circle|rect|ellipse|line|polyline|polygon|text|image|use)\b", re.I)


@dataclass
class Outline:
    """Elements in order of their tags, an entry of each list for one; and texts as (start, end, value, element)."""

    tag: list[str] = field(default_factory=list)
    attrs: list[dict[str, str | None]] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    open_end: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    #: The outermost svg around each element, or None.
    svg: list[int | None] = field(default_factory=list)
    texts: list[tuple[int, int, str, int]] = field(default_factory=list)


def _attributes(doc: str, at: int) -> tuple[dict[str, str | None], int, bool]:
    attrs: dict[str, str | None] = {}
    n = len(doc)
    while at < n:
        # Nothing fits both patterns, and most tags end in a plain `>`.
        if doc[at] == ">":
            return attrs, at + 1, False
        m = _ATTR.match(doc, at)
        if not m or m.end() == at:
            if m := _END.match(doc, at):
                return attrs, m.end(), m[1] == "/"
            at += 1
            continue
        if m[1]:
            # Of the three ways to write a value one was taken, or none.
            attrs.setdefault(m[1].lower(), entities.unescape(m[m.lastindex]) if m.lastindex > 1 else None)
        at = m.end()
    return attrs, n, False


def tokens(doc: str, in_svg: Callable[[], bool]) -> Iterator[tuple]:
    """("text", start, end, value), ("open", tag, attrs, start, end, closed) and ("close", tag, start, end), in order.

    Scripts and the like hold nothing but one text, unless they stand in a graphic.
    """
    at, n = 0, len(doc)
    while at < n and (m := _TAG.search(doc, at)):
        if m.start() > at:
            yield "text", at, m.start(), entities.unescape(doc[at : m.start()])
        if not (m[1] or m[2]):
            sign = "-->" if m[0] == "<!--" else ">"
            end = doc.find(sign, m.end())
            at = n if end < 0 else end + len(sign)
        elif m[1]:
            end = doc.find(">", m.end())
            at = n if end < 0 else end + 1
            yield "close", m[1].lower(), m.start(), at
        else:
            tag = m[2].lower()
            attrs, at, closed = _attributes(doc, m.end())
            raw = tag in RAW and not in_svg()
            yield "open", tag, attrs, m.start(), at, closed and not raw
            if raw:
                end = re.compile(rf"</{tag}\s*/?>", re.I).search(doc, at)
                stop, after = (n, n) if not end else end.span()
                yield "text", at, stop, entities.unescape(doc[at:stop]) if tag in ("title", "textarea") else doc[at:stop]
                yield "close", tag, after, after
                at = after
    if at < n:
        yield "text", at, n, entities.unescape(doc[at:n])


def outline(doc: str) -> Outline:
    o = Outline()
    opened: list[int] = []

    def shut(depth: int, end: int) -> None:
        for k in opened[depth:]:
            o.end[k] = end
        del opened[depth:]

    def blank(at: int, element: int) -> None:
        o.texts.append((at, at + 1, " ", element))

    for kind, *t in tokens(doc, lambda: bool(opened) and (o.svg[opened[-1]] is not None or o.tag[opened[-1]] == "svg")):
        if kind == "text":
            if t[1] > t[0]:
                o.texts.append((*t, opened[-1] if opened else -1))
        elif kind == "close":
            tag, begin, end = t
            depth = next((d for d in range(len(opened) - 1, -1, -1) if o.tag[opened[d]] == tag), None)
            if depth is not None:
                shut(depth + 1, begin)
                shut(depth, end)
        else:
            tag, attrs, begin, open_end, closed = t
            if tag in BLOCKS:
                for d in range(len(opened) - 1, -1, -1):
                    if o.tag[opened[d]] not in INLINE:
                        break
                    if o.tag[opened[d]] == "p":
                        shut(d, begin)
                        break
            if tag in CLOSES:
                last = None
                for d in range(len(opened) - 1, -1, -1):
                    if o.tag[opened[d]] in HOLDS[tag]:
                        break
                    if o.tag[opened[d]] in CLOSES[tag]:
                        last = d
                if last is not None:
                    shut(last, begin)
            above, k = opened[-1] if opened else -1, len(o.tag)
            svg = None if above < 0 else o.svg[above] if o.svg[above] is not None else above if o.tag[above] == "svg" else None
            o.tag.append(tag)
            o.attrs.append(attrs)
            o.start.append(begin)
            o.open_end.append(open_end)
            o.end.append(open_end)
            o.parent.append(above)
            o.svg.append(svg)
            if tag in BLOCKS or tag == "br":
                blank(begin, k)
            if not (tag in VOID or closed and (tag == "svg" or svg is not None)):
                opened.append(k)
    shut(0, len(doc))
    # A block parts its texts from those behind it, too: a blank at its last character.
    o.texts += [(o.end[k] - 1, o.end[k], " ", k) for k, tag in enumerate(o.tag) if tag in BLOCKS]
    return o


def anchors(doc: str) -> list[tuple[int, str | None]]:
    """(position among the elements, href) of every `a`: tags only, nothing is built."""
    depth = n = 0
    out: list[tuple[int, str | None]] = []
    for kind, *t in tokens(doc, lambda: depth > 0):
        if kind == "open":
            if t[0] == "a":
                out.append((n, t[1].get("href")))
            elif t[0] == "svg" and not t[4]:
                depth += 1
            n += 1
        elif kind == "close" and t[0] == "svg":
            depth = max(0, depth - 1)
    return out
