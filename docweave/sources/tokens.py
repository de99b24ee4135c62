"""HTML as tokens: start tags, end tags and texts in order.

Markup that stands as it should is read by one pattern, a tag at a time; a page
with anything else (a stray bracket, an open comment, odd attributes) goes through
the standard library's parser as a whole, with the same tokens.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from typing import NamedTuple

_NAME = r"[a-zA-Z][a-zA-Z0-9:_-]*"
_VALUE = r"""\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`/]+)"""
_ATTRIBUTE = re.compile(rf"\s+([a-zA-Z_:][a-zA-Z0-9:._-]*)(?:{_VALUE})?")
#: A start tag (name, attributes, slash), an end tag (name), a comment or a document type.
TAG = re.compile(
    rf"<(?:({_NAME})((?:\s+[a-zA-Z_:][a-zA-Z0-9:._-]*(?:{_VALUE.replace('(', '(?:')})?)*)\s*(/?)>"
    r"|/([a-zA-Z][a-zA-Z0-9:._-]*)\s*>|!--(?:[^-]|-(?!-))*-->|![dD][oO][cC][tT][yY][pP][eE][^<>]*>)"
)
#: Elements whose content is text whatever it looks like, with their ends.
_RAW = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in ("script", "style")}


class Token(NamedTuple):
    """A start tag (balance 1), an end tag (-1) or a text (0); ``empty`` marks both tokens of a tag that ends itself."""

    balance: int
    tag: str
    text: str
    attrs: dict[str, str]
    empty: bool = False


def shown(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """A start tag as text again."""
    return f"<{tag}{''.join(f' {k}={chr(34)}{v}{chr(34)}' for k, v in attrs)}>"


def attributes(source: str) -> list[tuple[str, str | None]]:
    """Names and values of the attributes of a start tag; None where there is no value."""
    out = list[tuple[str, str | None]]()
    for name, value in _ATTRIBUTE.findall(source):
        plain = value[1:-1] if value[:1] in ("'", '"') else value
        out.append((name.lower(), (unescape(plain) if "&" in plain else plain) if value else None))
    return out


def _start(tag: str, attrs: list[tuple[str, str | None]], empty: bool) -> Token:
    return Token(1, tag, shown(tag, attrs), {k: v or "" for k, v in attrs}, empty)


@lru_cache(4096)
def _start_of(name: str, source: str, slash: str) -> Token:
    """The same tags stand in page after page; tokens aren't changed by anyone."""
    return _start(name.lower(), attributes(source), bool(slash))


@lru_cache(1024)
def _end_of(tag: str, empty: bool = False) -> Token:
    return Token(-1, tag, f"</{tag}>", {}, empty)


class _Library(HTMLParser):
    def __init__(self, html: str):
        super().__init__()
        self.tokens = list[Token]()
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tokens.append(_start(tag, attrs, False))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tokens += [_start(tag, attrs, True), _end_of(tag, True)]

    def handle_endtag(self, tag: str) -> None:
        self.tokens.append(_end_of(tag))

    def handle_data(self, data: str) -> None:
        self.tokens.append(Token(0, "", data, {}))


def _regular(html: str) -> list[Token] | None:
    """The tokens of a page without odd markup, else None."""
    out, at = list[Token](), 0
    while (start := html.find("<", at)) >= 0:
        if start > at:
            text = html[at:start]
            out.append(Token(0, "", unescape(text) if "&" in text else text, {}))
        found = TAG.match(html, start)
        if found is None:
            return None
        name, source, slash, closed = found.groups()
        at = found.end()
        if closed is not None:
            out.append(_end_of(closed.lower()))
        elif name is not None:
            token = _start_of(name, source, slash)
            out.append(token)
            if slash:
                out.append(_end_of(token.tag, True))
            elif token.tag in _RAW:
                end = _RAW[token.tag].search(html, at)
                if end is None:
                    return None
                if end.start() > at:
                    out.append(Token(0, "", html[at : end.start()], {}))
                out.append(_end_of(token.tag))
                at = end.end()
    if at < len(html):
        text = html[at:]
        out.append(Token(0, "", unescape(text) if "&" in text else text, {}))
    return out


def tokens(html: str) -> list[Token]:
    """All tokens of a page; the texts of scripts and styles stay as they are, others have their references resolved."""
    found = _regular(html)
    return _Library(html).tokens if found is None else found
