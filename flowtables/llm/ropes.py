"""Texts as shared concatenations, compared without being written out."""

from __future__ import annotations

from dataclasses import dataclass

_PRIME, _BASE = (1 << 61) - 1, 1_000_003


@dataclass(frozen=True, eq=False, slots=True)
class Rope:
    """A short text, or two ropes one after the other."""

    length: int
    code: int  # of the whole text: equal texts have equal codes
    left: Rope | None = None
    right: Rope | None = None
    text: str = ""


def leaf(text: str) -> Rope:
    code = 0
    for c in text:
        code = (code * _BASE + ord(c)) % _PRIME
    return Rope(len(text), code, text=text)


def join(a: Rope, b: Rope) -> Rope:
    if not a.length or not b.length:
        return b if not a.length else a
    return Rope(a.length + b.length, (a.code * pow(_BASE, b.length, _PRIME) + b.code) % _PRIME, a, b)


def less(a: Rope, b: Rope) -> bool:
    """Whether a text comes before another; parts of one length and code are equal."""
    mine, other = [a], [b]
    while mine and other:
        x, y = mine.pop(), other.pop()
        if x is y or (x.length == y.length and x.code == y.code):
            continue
        if x.left is None and y.left is None:
            n = min(x.length, y.length)
            if x.text[:n] != y.text[:n]:
                return x.text < y.text
            if x.length > n:
                mine.append(leaf(x.text[n:]))
            elif y.length > n:
                other.append(leaf(y.text[n:]))
        elif y.left is None or (x.left is not None and x.length >= y.length):
            mine += (x.right, x.left)
            other.append(y)
        else:
            other += (y.right, y.left)
            mine.append(x)
    return not mine and any(r.length for r in other)


def text_of(rope: Rope) -> str:
    out, todo = [], [rope]
    while todo:
        r = todo.pop()
        if r.left is None:
            out.append(r.text)
        else:
            todo += (r.right, r.left)
    return "".join(out)
