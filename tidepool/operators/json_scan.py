"""JSON objects in text that is no JSON: a pushdown automaton fed line by line.

JSON strings hold no line ends, so every line begins outside a string and tokens never
span lines.  The automaton reads tokens from an opening brace on and keeps a stack of
the objects and arrays it is in.  Where a token does not fit, everything on the stack
is invalid at once: a nested object read from its own brace would have met the same
token in the same state.  What stays to be decided is noted on the way: nested objects
that were complete, and braces inside strings, which begin an object only if the quotes
before them were not what they seemed.  So a brace is read as structure once for each
way the quotes before it can pair up, and a log of open braces takes linear time.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

# A key with its colon, a string, a number or literal (with those that Python's own reader takes), or a sign; blanks before it.
_TOKEN = re.compile(
    r'''[ \t\r]*(?:(?P<key>"(?:[^"\\\x00-\x1f]|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*+"[ \t\r]*:)|(?P<string>"(?:[^"\\\x00-\x1f]|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*+")'''
    r'''|(?P<plain>-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null|NaN|-?Infinity)|(?P<sign>[{}\[\]:,]))''')
_BLANK = re.compile(r"[ \t\r]*")
_LINE = 32  # bits of a position that tell the column

# What may come next: a key, a key or the end, a colon, a value, a value or the end, a comma or the end.
_KEY, _KEY_END, _COLON, _VALUE, _VALUE_END, _NEXT = range(6)


class _Run:
    """The automaton from one opening brace on.  ``opened`` has the positions of open objects and arrays, ``kinds`` which they are."""

    def __init__(self, start: int):
        self.start, self.at, self.state = start, start, _VALUE
        self.opened, self.kinds = array("q"), bytearray()
        self.notes: list[tuple[int, int | None]] = []  # complete objects (start, end) and braces in strings (place, None), by place

    def line(self, number: int, text: str) -> bool | None:
        """Read the rest of a line: true at the end of the object, false where a token does not fit, none at the line's end."""
        base = number << _LINE
        column = max(self.at - base, 0)
        match = _TOKEN.match
        while True:
            token = match(text, column)
            if token is None:
                column = _BLANK.match(text, column).end()
                self.at = base + column
                return None if column == len(text) else False
            kind = token.lastgroup
            begin, column = token.start(kind), token.end()
            if not self._take(kind, token[kind], base + begin, base + column):
                self.at = base + begin
                return False
            if not self.kinds:
                self.at = base + column
                return True

    def _take(self, kind: str, text: str, begin: int, end: int) -> bool:
        state = self.state
        if kind == "key":
            if state not in (_KEY, _KEY_END):
                return False
            self.state = _VALUE
            self._suspect(text, begin)
        elif kind == "sign":
            return self._sign(text, begin, end)
        elif kind == "string" and state in (_KEY, _KEY_END):
            self.state = _COLON  # the colon stands on a later line
            self._suspect(text, begin)
        elif state in (_VALUE, _VALUE_END):
            self.state = _NEXT
            if kind == "string":
                self._suspect(text, begin)
        else:
            return False
        return True

    def _sign(self, sign: str, begin: int, end: int) -> bool:
        state = self.state
        if sign in "{[":
            if state not in (_VALUE, _VALUE_END):
                return False
            self.opened.append(begin)
            self.kinds.append(ord(sign))
            self.state = _KEY_END if sign == "{" else _VALUE_END
        elif sign == ":":
            if state != _COLON:
                return False
            self.state = _VALUE
        elif sign == ",":
            if state != _NEXT:
                return False
            self.state = _KEY if self.kinds[-1] == ord("{") else _VALUE
        else:
            if state != _NEXT and state != (_KEY_END if sign == "}" else _VALUE_END) or self.kinds[-1] != ord("{" if sign == "}" else "["):
                return False
            start = self.opened.pop()
            self.kinds.pop()
            if sign == "}":
                while self.notes and self.notes[-1][0] > start:
                    self.notes.pop()
                self.notes.append((start, end))
            self.state = _NEXT
        return True

    def _suspect(self, text: str, begin: int) -> None:
        at = text.find("{")
        while at >= 0:
            self.notes.append((begin + at, None))
            at = text.find("{", at + 1)


class ObjectScanner:
    """Finds the JSON objects of a text given line by line, from left to right, each held by no other.

    ``feed`` returns the texts of the objects that a line settles, ``end`` those that
    the end of the text does.  Lines are kept only while an object that began on them is
    not settled.
    """

    def __init__(self):
        self.lines: dict[int, str] = {}
        self.count = 0
        self.resume = 0  # from here on nothing is known
        self.pending: dict[int, int | None] = {}  # places before ``resume``: complete objects, or braces to be tried
        self.run: _Run | None = None

    def feed(self, line: str) -> list[str]:
        self.lines[self.count] = line
        self.count += 1
        return list(self._settle(False))

    def end(self) -> list[str]:
        return list(self._settle(True))

    def _text(self, start: int, end: int) -> str:
        first, last = start >> _LINE, (end - 1) >> _LINE
        parts = [self.lines[i] for i in range(first, last + 1)]
        parts[-1] = parts[-1][:end - (last << _LINE)]
        parts[0] = parts[0][start - (first << _LINE):]
        return "\n".join(parts)

    def _settle(self, ended: bool) -> Iterator[str]:
        while True:
            if self.run is None:
                start = min(self.pending, default=None)
                if start is None:
                    start = self._next_brace()
                    if start is None:
                        return
                    self.resume = start + 1
                elif (end := self.pending.pop(start)) is not None:
                    yield self._accept(start, end)
                    continue
                self.run = _Run(start)
            done = self._advance(self.run)
            if done is None and not ended:
                return
            run, self.run = self.run, None
            if done:
                yield self._accept(run.start, run.at)
            else:
                self._failed(run)

    def _advance(self, run: _Run) -> bool | None:
        number = run.at >> _LINE
        while number < self.count:
            done = run.line(number, self.lines[number])
            if done is not None:
                return done
            number += 1
            run.at = number << _LINE
        return None

    def _next_brace(self) -> int | None:
        number, column = self.resume >> _LINE, self.resume & ((1 << _LINE) - 1)
        while number < self.count:
            at = self.lines[number].find("{", column)
            if at >= 0:
                self._forget(number)
                return (number << _LINE) + at
            number, column = number + 1, 0
        self._forget(number)
        self.resume = number << _LINE
        return None

    def _forget(self, number: int) -> None:
        """Lines before the one of this number are settled."""
        for i in self.lines.keys() - range(number, self.count):
            del self.lines[i]

    def _accept(self, start: int, end: int) -> str:
        if any(p < end < e for p, e in self.pending.items() if e is not None):
            self.pending, self.resume = {}, end  # a complete object lost its beginning; what it held is looked at anew
        self.pending = {p: e for p, e in self.pending.items() if p >= end}
        self.resume = max(self.resume, end)
        return self._text(start, end)

    def _failed(self, run: _Run) -> None:
        """Of what both this run and an earlier one have read, a brace stays to be tried only if both had it in a string."""
        found = dict(run.notes)
        kept = {p: e for p, e in self.pending.items() if e is not None or p >= run.at or p in found}
        kept |= {p: e for p, e in found.items() if e is not None or p >= self.resume or p in self.pending}
        self.pending = {p: kept[p] for p in sorted(kept)}
        self.resume = max(self.resume, run.at)
