"""A page's text lines, each with the part of the page it stands in."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

#: Parts: text somewhere on the page, text of the article, and furniture around it.
ANYWHERE, ARTICLE, FURNITURE = 0, 1, 2

# Element and class names by what they hold, in natural order.
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page.
OPAQUE = set(
    "audio button canvas datalist iframe math noscript object script select style svg template textarea title video".split()
)
#: Of these, those whose content is never markup: without an end tag they take the rest of the page. Others then end at the next block.
RAW = set("iframe noscript script style textarea title".split())
FURNITURE_ELEMENTS = set("aside dialog footer form header menu nav".split())
FURNITURE_ROLES = set("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
FURNITURE_NAMES = set(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header login masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination "
    "popup promo promoted related respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Not tracked unless they are furniture by name, since their end tags are often left out.
UNTRACKED = set("b big cite code dd dt em font i li option p s small strong sub sup tbody td tfoot th thead tr tt u".split())

_TAG = re.compile(
    r"<(?:!--(?P<comment>.*?)(?:-->|\Z)"
    r"|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>"
    r"|[a-zA-Z/!?][^>]*(?:>|\Z))",
    re.DOTALL,
)
_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS | {'article', 'main', 'p'}))})(?=[\s/>])", re.IGNORECASE)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")


class Line(NamedTuple):
    part: int
    #: The furniture a line belongs to, such as ``nav`` or ``ad``; empty elsewhere.
    slot: str
    text: str


def _furniture(name: str, rest: str, inside_article: bool) -> str:
    """Which furniture an element is, if any."""
    if name in FURNITURE_ELEMENTS and not (name == "header" and inside_article):
        return name
    if name in ("html", "body", "main") or "=" not in rest:
        return ""
    for attribute, value in _NAMES.findall(rest):
        words = _WORDS.findall(value.lower())
        known = FURNITURE_ROLES if attribute.lower() == "role" else FURNITURE_NAMES
        for word in words:
            if word in known and not (inside_article and word == "header"):
                return word
    return ""


def lines(page: str) -> list[Line]:
    """Text lines in page order: character references decoded, white space within a line made one space, none empty.

    Block elements and line breaks end a line. Heads, scripts, styles, comments and controls have no lines.
    """
    made: list[Line] = []
    pieces: list[str] = []
    #: Open elements: name, part, slot.
    stack: list[tuple[str, int, str]] = []
    #: Where each name stands in it, so that a closing tag need not look for its element.
    open_at: dict[str, list[int]] = {}
    #: Names without a closing tag in what is left of the page.
    unclosed: set[str] = set()
    part, slot = ANYWHERE, ""

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            open_at[stack.pop()[0]].pop()

    def end_line() -> None:
        if pieces:
            text = "".join(pieces)
            pieces.clear()
            if "&" in text:
                text = html.unescape(text)
            if text := " ".join(text.split()):
                made.append(Line(part, slot, text))

    place, size = 0, len(page)
    while place < size:
        found = _TAG.search(page, place)
        if found is None:
            pieces.append(page[place:])
            break
        if found.start() > place:
            pieces.append(page[place : found.start()])
        place = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["close"]:
            if name in BLOCKS:
                end_line()
            if open_at.get(name):
                end_line()
                close_to(open_at[name][-1])
                _, part, slot = stack[-1] if stack else ("", ANYWHERE, "")
            continue
        if name in OPAQUE or name == "head":
            if name in ("button", "select", "textarea", "title", "head"):
                end_line()
            if not found["rest"].endswith("/"):
                end = r"<body\b|</head\s*>" if name == "head" else rf"</{re.escape(name)}\s*>"
                closing = None if name in unclosed else re.compile(end, re.IGNORECASE).search(page, place)
                if closing is not None:
                    place = closing.start() if name == "head" else closing.end()
                elif name in RAW or name == "head":
                    place = size
                else:
                    unclosed.add(name)
                    block = _BLOCK.search(page, place)
                    place = size if block is None else block.start()
            continue
        if name in BLOCKS:
            end_line()
            while stack and stack[-1][0] == "p":
                close_to(len(stack) - 1)
                _, part, slot = stack[-1] if stack else ("", ANYWHERE, "")
        if name in VOID:
            continue
        inside = part == ARTICLE
        kind = _furniture(name, found["rest"], inside)
        if kind in ("article", "main"):
            kind = ""
        if not kind and name in UNTRACKED:
            continue
        new = (name, part, slot)
        if kind and part != FURNITURE:
            new = (name, FURNITURE, kind)
        elif name in ("article", "main") and not kind and not slot.startswith("comment"):
            # An article in a page-wide form, or in a frame named after its sidebar, is still the article.
            if slot not in ("nav", "aside", "footer", "menu"):
                new = (name, ARTICLE, "")
        if new[1:] != (part, slot):
            end_line()
        open_at.setdefault(name, []).append(len(stack))
        stack.append(new)
        _, part, slot = new
    end_line()
    return made
