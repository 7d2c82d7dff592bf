"""Trigrams that every match of a regular expression must have."""

from __future__ import annotations

import re

#: Strings that one run of a pattern is spelled out to at most; longer lists ask for nothing.
_MOST_STRINGS = 64
#: Members of a character class that are spelled out, and copies of a repeated item.
_MOST_MEMBERS = 8

#: What a run of items can be, item by item, in lower case; None where the strings are too many.
Items = list[set[str] | None]

_REPEAT = re.compile(r"\{(\d+)(,(\d*))?\}")
_CODE = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|u([0-9A-Fa-f]{4}))")
_GROUP = re.compile(r"\(\?(?:[ism]*:|<[A-Za-z][A-Za-z0-9]*>|P<\w+>|>)|\((?!\?)")
_LOOK = re.compile(r"\(\?<?[=!]")
_FLAGS = re.compile(r"\(\?[ism]+\)")
_RANGE = re.compile(r"-(?!\])")
_CONTROLS = {"n": "\n", "t": "\t", "r": "\r", "f": "\f"}
_CLASSES = "dDwWsS"
_PLACES = "bBAzZ"


def _spelled(char: str) -> set[str] | None:
    """``char`` in lower case; None for capitals beyond ASCII, whose lower case depends on what is beside them."""
    return {char.lower()} if char.isascii() or char == char.lower() else None


class _Pattern:
    """A pattern, read from left to right. What it does not know raises ValueError."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def match(self, form: re.Pattern) -> re.Match | None:
        found = form.match(self.text, self.at)
        if found:
            self.at = found.end()
        return found

    def take(self, token: str) -> bool:
        found = self.text.startswith(token, self.at)
        self.at += len(token) * found
        return found

    def next(self) -> str:
        if self.at == len(self.text):
            raise ValueError("the pattern ends early")
        self.at += 1
        return self.text[self.at - 1]

    def whole(self) -> Items:
        items = self.options()
        if self.at < len(self.text):
            raise ValueError("a bracket too many")
        return items

    def options(self) -> Items:
        """Alternatives up to a closing bracket: the items of a single one, or one item for them all."""
        found = [self.items()]
        while self.take("|"):
            found.append(self.items())
        if len(found) == 1:
            return found[0]
        strings = [joined(items) for items in found]
        return [None if None in strings else set().union(*strings)]

    def items(self) -> Items:
        found: Items = []
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            found += self.repeated(self.single())
        return found

    def closed(self) -> Items:
        items = self.options()
        if not self.take(")"):
            raise ValueError("a bracket is not closed")
        return items

    def single(self) -> Items:
        if self.match(_FLAGS):
            return []
        if self.match(_LOOK):
            self.closed()
            return [{""}]
        if self.match(_GROUP):
            return self.closed()
        if self.take("["):
            return [self.members()]
        if self.take("\\"):
            return [self.escaped()]
        char = self.next()
        if char in "^$":
            return [{""}]
        if char in "(*+?{":
            raise ValueError(f"{char} is not known here")
        return [None if char == "." else _spelled(char)]

    def escaped(self) -> set[str] | None:
        """What follows a backslash; None for a class of characters."""
        self.at -= 1
        if code := self.match(_CODE):
            return _spelled(chr(int(code[1] or code[2], 16)))
        self.at += 1
        char = self.next()
        if char in _CLASSES:
            return None
        if char in _PLACES:
            return {""}
        if char in _CONTROLS:
            return {_CONTROLS[char]}
        if char.isalnum():
            raise ValueError(f"\\{char} is not known")
        return {char}

    def members(self) -> set[str] | None:
        """Characters of a class in square brackets, None if they are many or all but some."""
        others, found, many, first = self.take("^"), set(), False, True
        while first or not self.take("]"):
            first = False
            if self.text.startswith(("&&", "[", "]"), self.at):
                raise ValueError("classes within classes are not known")
            low = high = self.member()
            if low and self.match(_RANGE):
                high = self.member()
            if low is None or high is None or ord(high) - ord(low) >= _MOST_MEMBERS:
                many = True
                continue
            spelled = [_spelled(chr(code)) for code in range(ord(low), ord(high) + 1)]
            many = many or None in spelled
            found = found.union(*filter(None, spelled))
        return None if others or many or len(found) > _MOST_MEMBERS else found

    def member(self) -> str | None:
        if not self.take("\\"):
            return self.next()
        before, found = self.at - 1, self.escaped()
        if found == {""}:
            raise ValueError("a place within a class")
        if found is None:
            return None
        code = _CODE.match(self.text, before)
        return chr(int(code[1] or code[2], 16)) if code else next(iter(found))

    def repeated(self, items: Items) -> Items:
        """``items`` as often as the quantifier that follows asks for at least, and then perhaps more."""
        if self.take("?"):
            low, high = 0, 1
        elif self.take("*"):
            low, high = 0, None
        elif self.take("+"):
            low, high = 1, None
        elif times := self.match(_REPEAT):
            low = int(times[1])
            high = low if times[2] is None else int(times[3]) if times[3] else None
        else:
            return items
        if not self.take("?"):
            self.take("+")
        if (low, high) == (0, 1):
            strings = joined(items)
            return [None if strings is None else strings | {""}]
        copies = items * min(low, _MOST_MEMBERS)
        return copies if low == high <= _MOST_MEMBERS else [*copies, None]


def joined(parts: Items) -> set[str] | None:
    """The strings that items in a row can be, None where they are too many."""
    if None in parts:
        return None
    strings: set[str] = {""}
    for part in parts:
        strings = {x + y for x in strings for y in part}
        if len(strings) > _MOST_STRINGS:
            return None
    return strings


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Trigrams of lower-cased text that any match must have: at least one set must be there whole.

    Runs of items with few possible strings are spelled out; each run asks for the trigrams of one of
    its strings. The most selective run is kept. An empty list means that nothing is mandatory; a
    pattern with something this reader does not know (back references, nested classes, other flags)
    counts as such.
    """
    try:
        items = _Pattern(pattern).whole()
    except ValueError:
        return []
    runs: list[set[str]] = [{""}]
    for strings in items:
        longer = None if strings is None else joined([runs[-1], strings])
        if longer is None:
            runs.append({""} if strings is None else strings)
        else:
            runs[-1] = longer
    options = []
    for run in runs:
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
        if frozenset() not in sets:
            options.append(sorted((s for s in sets if not any(t < s for t in sets)), key=sorted))
    return max(options, key=lambda sets: min(map(len, sets)), default=[])
