"""Helpers of page readers: elements, attributes and text of HTML fragments.

Patterns are matched as ASCII, so that white space and word borders in tags mean
what the markup means by them.
"""

from __future__ import annotations

import re
from functools import cache
from html.entities import name2codepoint

_REFERENCE = re.compile(r"&(#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_TAGS = re.compile("<[^>]*>")


@cache
def pattern(text: str, whole_lines: bool = False) -> re.Pattern[str]:
    """A compiled pattern, blind to case; its dot takes line ends too unless ``whole_lines``."""
    return re.compile(text, re.ASCII | re.IGNORECASE | (0 if whole_lines else re.DOTALL))


def _character(reference: re.Match[str]) -> str:
    body = reference[1]
    if body[0] != "#":
        return chr(name2codepoint[body]) if body in name2codepoint else reference[0]
    number = int(body[2:], 16) if body[1] in "xX" else int(body[1:])
    if 1 <= number <= 0x10FFFF and not 0xD800 <= number <= 0xDFFF:
        return chr(number)
    return reference[0]


def unescaped(text: str) -> str:
    """Character references as the characters they stand for; unknown ones stay as they are."""
    return _REFERENCE.sub(_character, text) if "&" in text else text


def element(html: str, start: int, name: str, end: int | None = None) -> str:
    """Content of the element whose opening tag ends at ``start``, up to the closing tag that matches.

    Without one it is all up to ``end``.
    """
    end, depth = len(html) if end is None else end, 1
    for tag in pattern(rf"<(/?){name}\b[^>]*>").finditer(html, start, end):
        depth += -1 if tag[1] else 1
        if not depth:
            return html[start : tag.start()]
    return html[start:end]


def tag_name(opening: str) -> str:
    """Name in the pattern of an opening tag."""
    return re.search(r"<(\w+)", opening)[1]


def first_element(html: str, opening: str) -> str | None:
    """Content of the first element whose opening tag matches; None when there is none."""
    found = pattern(opening, whole_lines=True).search(html)
    return element(html, found.end(), tag_name(opening)) if found else None


def elements(html: str, opening: str) -> list[str]:
    """Content of each element that an opening tag begins; one inside another ends the outer one."""
    found = list(pattern(opening, whole_lines=True).finditer(html))
    ends = [*[tag.start() for tag in found[1:]], len(html)]
    return [element(html, tag.end(), tag_name(opening), end) for tag, end in zip(found, ends)]


def inner_text(fragment: str) -> str:
    """Text of a fragment; each piece between tags is trimmed, then all joined."""
    if "<" in fragment:
        fragment = "".join(piece.strip() for piece in _TAGS.split(fragment))
    return unescaped(fragment).strip()


def attribute(tag: str, name: str) -> str:
    """Value of an attribute of the first tag in ``tag``; blank when absent."""
    found = pattern(rf"""<[^>]*?\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)')""").match(tag)
    return unescaped(found[1] or found[2] or "") if found else ""


def first_with(texts: list[str], words: tuple[str, ...]) -> str:
    """First text with one of ``words`` in it, else blank."""
    return next((t for t in texts if any(w in t for w in words)), "")
