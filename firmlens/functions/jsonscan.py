"""The JSON in a text: brackets matched from every start in one pass over the text from its end."""

from __future__ import annotations

import re

_MARK = re.compile(r'[{}\[\]"\\]')
_FENCE = re.compile(r"```(?:json)?\s*(.*?)\s*```", re.DOTALL | re.IGNORECASE)


def first_balanced(text: str) -> str:
    """The first object or array of a text whose brackets close, '' without one.

    A start reads on outside of a string; quotes, and backslashes inside of strings, then decide what counts, and only
    brackets of its own kind. Starts differ in whether they take a place for the inside of a string, so for each place the
    next bracket is kept for both ways of reading. From the end back, each
    bracket knows the first one behind it that closes more than was opened: a closing one is that itself; behind an opening one
    it is found past its own partner. So each place is looked at once, however many starts there are.
    """
    marks = [(m.start(), m[0]) for m in _MARK.finditer(text)]
    best = (len(text), -1)
    for opening, closing in ("{}", "[]"):
        outside = inside = None  # the next bracket of this kind for both ways of reading, from the place in hand
        then: tuple[int, int | None] = (-1, None)  # a place, and what `inside` was behind it
        closes: dict[int, int | None] = {}  # of a bracket, the first one from it on that closes more than was opened
        after: dict[int, int | None] = {}  # of a closing bracket, the next bracket
        for at, mark in reversed(marks):
            # behind a backslash the next character only leads on; if it is a mark, `inside` is what held behind it
            skipped = then[1] if then[0] == at + 1 else inside
            then = (at, inside)
            if mark == '"':
                outside, inside = inside, outside
            elif mark == "\\":
                inside = skipped
            elif mark == closing:
                after[at], closes[at], outside = outside, at, at
            elif mark == opening:
                partner = closes[outside] if outside is not None else None
                if partner is not None:
                    best = min(best, (at, partner))
                    behind = after[partner]
                    partner = closes[behind] if behind is not None else None
                closes[at], outside = partner, at
    return text[best[0] : best[1] + 1].strip()


def answer_json(text: str) -> str:
    """The JSON of a model's answer: of the first code fence that holds a closed object or array, else of the whole text; ''
    without one."""
    text = text.strip()
    for block in _FENCE.findall(text):
        if found := first_balanced(block.strip()):
            return found
    return first_balanced(text)
