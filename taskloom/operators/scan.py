"""Masking, pairing, edits by position, and reproducible choices, shared by adapters and modifiers."""

from __future__ import annotations

import hashlib
import re

_LITERAL = re.compile(r'"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])\'|`(?:\\.|[^`\\])*`|//[^\n]*|/\*.*?\*/', re.S)
_RUBY_LITERAL = re.compile(r'"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'|(?<![\w&])#[^\n]*')


def mask(source: str, ext: str) -> str:
    """The source with strings and comments as blanks, of the same length."""
    blank = lambda m: re.sub(r"[^\n]", " ", m[0])
    return (_RUBY_LITERAL if ext == "rb" else _LITERAL).sub(blank, source)


def closing(text: str, at: int, pair: str = "{}") -> int:
    """Place of the delimiter that closes the one at ``at``; -1 if none does."""
    depth = 0
    for i in range(at, len(text)):
        depth += (text[i] == pair[0]) - (text[i] == pair[1])
        if not depth:
            return i
    return -1


Edit = tuple[int, int, str]


def _chance(*parts: object) -> float:
    return int.from_bytes(hashlib.md5("|".join(map(str, parts)).encode()).digest()[:6]) / 2**48


class Choice:
    """Reproducible choices of one call: by call number, so equal calls choose alike."""

    def __init__(self, *parts: object) -> None:
        self.parts, self.n = parts, 0

    def unit(self) -> float:
        self.n += 1
        return _chance(*self.parts, self.n)

    def of(self, options: list) -> object:
        return options[min(int(self.unit() * len(options)), len(options) - 1)]

    def shuffled(self, items: list) -> list:
        return [x for _, x in sorted(((self.unit(), i), x) for i, x in enumerate(items))]


def edited(source: str, edits: list[Edit]) -> str:
    """The source with edits applied; of overlapping ones the outermost is kept."""
    kept: list[Edit] = []
    for e in sorted(set(edits), key=lambda e: (e[0], -e[1])):
        if not kept or e[0] >= kept[-1][1]:
            kept.append(e)
    out, at = [], 0
    for start, end, text in kept:
        out += source[at:start], text
        at = end
    return "".join([*out, source[at:]])
