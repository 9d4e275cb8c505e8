"""Leaf blocks of HTML pages: texts with the path of block elements around them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Elements that begin and end blocks.
BLOCK_TAGS = frozenset(
    "html body p div section article main header footer nav aside h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre form fieldset figure figcaption address details summary center menu dialog hgroup".split()
)
# Elements whose content is no text of the page.
SILENT_TAGS = frozenset("head title script style noscript template svg math iframe object canvas select textarea button audio video".split())
# Of those, the ones whose content is not markup.
RAW_TAGS = frozenset("title script style textarea iframe".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that an open one of the same group ends, if they are not nested in a container of their own.
SIBLINGS = {t: g for g in (("li",), ("dt", "dd"), ("td", "th"), ("tr",), ("option",)) for t in g}
CONTAINERS = frozenset("ul ol dl table menu".split())

# A comment; a tag with quoted attributes, or else up to the next ">"; other markup; a tag that the page's end cuts off.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</?[a-zA-Z].*\Z",
    re.DOTALL,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    path: tuple[tuple[str, ...], ...]  # of each element around: its tag, then parts of its class, id and role
    text: str
    linked: int = 0  # characters inside links
    label: int = 0


@dataclass
class _Open:
    tag: str
    tokens: tuple[str, ...]


@dataclass
class _Page:
    stack: list[_Open] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    in_link: bool = False

    def end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(tuple(o.tokens for o in self.stack), text, self.linked))
            self.parts, self.linked = [], 0

    def close(self, at: int) -> None:
        self.end_block()
        del self.stack[at:]
        self.in_link = False

    def open(self, tag: str, attributes: str) -> None:
        self.end_block()
        if self.stack and self.stack[-1].tag == "p":
            self.stack.pop()
        group = SIBLINGS.get(tag)
        if group:
            for at in range(len(self.stack) - 1, -1, -1):
                if self.stack[at].tag in group:
                    self.close(at)
                    break
                if self.stack[at].tag in CONTAINERS:
                    break
        tokens = [tag]
        if attributes.strip():
            for found in _NAMES.findall(attributes):
                tokens += [t.lower() for t in _PARTS.findall(" ".join(found))]
            if _HIDDEN.search(attributes):
                tokens.append("hidden")
        self.stack.append(_Open(tag, tuple(tokens)))


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks of a page in order.

    White space inside a block becomes one space and character references are decoded; text directly
    in an element, between its block children, is a block, too. Unclosed elements end
    where their container does, unclosed tags and comments at the end of the page are dropped.
    """
    state = _Page()
    at, silent = 0, ""
    depth = 0
    n = len(page)
    while at < n:
        token = _TOKEN.search(page, at)
        begin = token.start() if token else n
        if begin > at and not silent:
            text = html.unescape(page[at:begin])
            state.parts.append(text)
            if state.in_link:
                state.linked += len(text)
        if not token:
            break
        at = token.end()
        tag = token[2] or token[5]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), bool(token[1] or token[4]), token[3] or token[6] or ""
        if silent:
            if tag == silent:
                depth += -1 if closing else 1
                if not depth:
                    silent = ""
            elif silent == "head" and tag == "body":
                silent = ""
                state.open(tag, attributes)
            continue
        if tag in SILENT_TAGS:
            if closing or attributes.endswith("/"):
                continue
            if tag in RAW_TAGS:
                end = re.compile(rf"</{tag}[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else n
            else:
                silent, depth = tag, 1
        elif tag in BLOCK_TAGS:
            if not closing:
                state.open(tag, attributes)
                continue
            for i in range(len(state.stack) - 1, -1, -1):
                if state.stack[i].tag == tag:
                    state.close(i)
                    break
            else:
                state.end_block()
        elif tag == "br":
            state.parts.append(" ")
        elif tag == "hr":
            state.end_block()
        elif tag == "a":
            state.in_link = not closing
    state.end_block()
    return state.blocks
