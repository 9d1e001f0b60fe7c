"""Blocks of a web page: runs of text between the tags of block elements, with their tag paths.

Reads tag soup from left to right in one pass, with a stack of open elements; time and memory are
linear in the page. Unclosed elements end where an enclosing one ends, or where HTML lets them end
(p, li, table cells and the like). Character references are decoded; comments, declarations and
elements without readable text (scripts, styles, titles, frames, entry fields) are left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html import unescape
from typing import NamedTuple
from zlib import crc32

PATH_BUCKETS = 1024
PATH_TOKENS = 24  # of the innermost elements

_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"?|'[^']*+'?)?+)*+)(?:>|\Z)",
    re.S)
_NAMED = re.compile(r"(?<![\w-])(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style title textarea iframe noembed noframes template svg math object select noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br input button".split())
LISTS = frozenset("ul ol dl table tbody thead tfoot tr".split())
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
            "tr": {"tr"}, "option": {"option"}}
_CLOSERS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in UNREAD}


class Element(NamedTuple):
    name: str
    path: tuple[int, ...]  # buckets of the names, classes and ids of the innermost elements
    region: str | None


class Block(NamedTuple):
    path: tuple[int, ...]
    text: str
    links: float  # share of its characters inside links
    region: str | None


def bucket(token: str) -> int:
    return crc32(token.encode("utf-8", "replace")) % PATH_BUCKETS


def named(rest: str) -> list[str]:
    """Lower-case words of an element's class, id, role and itemprop."""
    return [w.lower() for _, value in _NAMED.findall(rest) for w in _WORD.findall(value)]


def blocks(html: str, region: Callable[[str, str, str | None], str | None] | None = None) -> list[Block]:
    """The page's blocks with text, in order. `region(name, attributes, enclosing)` marks elements
    of training pages; it is no part of the path."""
    root = Element("", (), None)
    stack, open_ = [root], {}
    known: dict[tuple[str, str], tuple[int, ...]] = {}
    out: list[Block] = []
    parts: list[str] = []
    first, linked, links = root, 0, 0

    def say(text: str) -> None:
        nonlocal first, linked
        if "&" in text:
            text = unescape(text)
        if not parts:
            if not text or text.isspace():
                return
            first = stack[-1]
        parts.append(text)
        if links:
            linked += len(text)

    def flush() -> None:
        nonlocal linked
        if parts:
            whole = "".join(parts)
            text = " ".join(whole.split())
            if text:
                out.append(Block(first.path + (bucket("leaf " + first.name),), text, min(1.0, linked / len(whole)), first.region))
            parts.clear()
        linked = 0

    def close(at: int) -> None:
        nonlocal links
        for e in stack[at:]:
            open_[e.name] -= 1
            if e.name == "a":
                links -= 1
        del stack[at:]

    def find(names: set[str], until: frozenset[str]) -> int:
        """Place of the innermost open element of these names, with none of `until` inside it; else 0."""
        if not any(open_.get(n) for n in names):
            return 0
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].name in names:
                return at
            if stack[at].name in until:
                return 0
        return 0

    here, size = 0, len(html)
    while here < size:
        tag = _TAG.search(html, here)
        if tag is None:
            say(html[here:])
            break
        if tag.start() > here:
            say(html[here : tag.start()])
        here = tag.end()
        name = tag["name"]
        if name is None:
            continue
        name = name.lower()
        block = name not in INLINE
        if tag["end"]:
            if block:
                flush()
            if open_.get(name):
                at = len(stack) - 1
                while stack[at].name != name:
                    at -= 1
                if block or not any(e.name not in INLINE for e in stack[at + 1 :]):
                    close(at)
            continue
        if name in UNREAD:
            end = _CLOSERS[name].search(html, here)
            here = end.end() if end else size
            continue
        if block:
            flush()
            if open_.get("p"):
                at = find({"p"}, frozenset({"td", "th", "button"}))
                if at:
                    close(at)
            if name in ENDED_BY:
                at = find(ENDED_BY[name], LISTS - {name})
                if at:
                    close(at)
        if name in VOID:
            if name in ("br", "hr", "img"):
                say(" ")
            continue
        rest = tag["rest"]
        if rest.endswith("/"):
            rest = rest[:-1]
        own = known.get((name, rest))
        if own is None:
            own = (bucket(name), *(bucket("." + w) for w in named(rest)[:8]))
            if len(known) < 10_000:
                known[name, rest] = own
        outer = stack[-1]
        marked = region(name, rest, outer.region) if region else None
        stack.append(Element(name, (outer.path + own)[-PATH_TOKENS:], marked))
        open_[name] = open_.get(name, 0) + 1
        if name == "a":
            links += 1
    flush()
    return out
