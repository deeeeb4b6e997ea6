"""Literals in script bundles: exported variables, the largest object or array, tolerant of comments, bare keys and all quotes."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F

_NAME = re.compile(r"[A-Za-z_$][\w$]*")
_NUMBER = re.compile(r"[-+]?(?:0[xX][0-9a-fA-F]+|(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)")
_NOT = re.compile("![01]")
_SKIP = re.compile(r"(?:\s+|//[^\n]*|/\*.*?\*/)*", re.DOTALL)
# Words and escapes of literals.
_WORDS = {"true": True, "false": False, "null": None, "undefined": None, "!0": True, "!1": False}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "v": "\v", "0": "\0", "\n": ""}


#: Literals nested deeper than this are none.
DEPTH = 500


class _Reader:
    """Reads one literal; containers that are open are on a stack, and those that were closed are remembered with their places, so that they are known even if what holds them turns out to be none."""

    def __init__(self, text: str, at: int = 0):
        self.text, self.at = text, at
        self.closed: list[tuple[int, int, dict | list]] = []

    def skip(self) -> str:
        self.at = _SKIP.match(self.text, self.at).end()
        return self.text[self.at : self.at + 1]

    def string(self) -> str:
        began, quote, out = self.at, self.text[self.at], []
        at = self.at + 1
        while (c := self.text[at : at + 1]) != quote:
            if not c:
                raise ValueError(f"no end of the string at {began}")
            at += 1
            if c == "\\":
                e = self.text[at : at + 1]
                at += 1
                n = {"x": 2, "u": 4}.get(e, 0)
                out.append(chr(int(self.text[at : at + n], 16)) if n else _ESCAPES.get(e, e))
                at += n
            else:
                out.append(c)
        self.at = at + 1
        return "".join(out)

    def plain(self):
        """A string, a number or one of the words."""
        if self.text[self.at : self.at + 1] in ('"', "'", "`"):
            return self.string()
        for pattern in (_NUMBER, _NOT, _NAME):
            if m := pattern.match(self.text, self.at):
                if pattern is not _NUMBER and m[0] not in _WORDS:
                    break
                self.at = m.end()
                if pattern is not _NUMBER:
                    return _WORDS[m[0]]
                n = m[0].lower()
                return int(n, 16) if "x" in n else float(n) if re.search(r"[.e]", n) else int(n)
        raise ValueError(f"no literal at {self.at}")

    def key(self) -> str:
        if self.text[self.at : self.at + 1] in ('"', "'", "`"):
            out = self.string()
        else:
            m = _NAME.match(self.text, self.at) or _NUMBER.match(self.text, self.at)
            if not m:
                raise ValueError(f"no key at {self.at}")
            out, self.at = m[0], m.end()
        if self.skip() != ":":
            raise ValueError(f"no value at {self.at}")
        self.at += 1
        return out

    def value(self):
        stack: list[tuple] = []  # container, its end, where it began, key of its next value
        while True:
            c = self.skip()
            if c in ("{", "[") and c:
                if len(stack) == DEPTH:
                    raise ValueError(f"too deep at {self.at}")
                began = self.at
                self.at += 1
                done, container, end = False, {} if c == "{" else [], "}" if c == "{" else "]"
                stack.append((container, end, began, None))
            else:
                done, v = True, self.plain()
            while True:
                if done:  # v is complete: put it where it belongs
                    if not stack:
                        return v
                    container, end, began, key = stack[-1]
                    if key is None:
                        container.append(v)
                    else:
                        container[key] = v
                    if self.skip() == ",":
                        self.at += 1
                    elif self.text[self.at : self.at + 1] != end:
                        raise ValueError(f"no end at {self.at}")
                container, end, began, _ = stack[-1]
                if self.skip() != end:
                    stack[-1] = (container, end, began, self.key() if end == "}" else None)
                    break
                self.at += 1
                stack.pop()
                self.closed.append((began, self.at, container))
                done, v = True, container


def literal(text: str, at: int = 0):
    """The literal at a place; raises ValueError or IndexError if there is none or it never ends."""
    return _Reader(text, at).value()


def exported(text: str, name: str):
    """The literal that is assigned to what a script exports under a name; None if there is none."""
    for block in re.finditer(r"export\s*\{([^}]*)\}", text):
        for item in block[1].split(","):
            parts = item.split()
            if parts and parts[-1] == name:
                for m in re.finditer(rf"(?<![\w$.]){re.escape(parts[0])}\s*=(?!=)\s*", text):
                    try:
                        return literal(text, m.end())
                    except (ValueError, IndexError):
                        continue
    return None


def largest(text: str, opening: str) -> tuple[int, dict | list | None]:
    """Length and value of the longest object or array literal in a text, the first of equally long ones; 0 and None if none is complete.

    Where a literal breaks off, those within it that are complete count, and the search goes on from there, so that each
    part of a text is read once or twice however broken it is.
    """
    best, found, at = 0, None, 0
    while (at := text.find(opening, at)) >= 0:
        r = _Reader(text, at)
        try:
            r.value()
            at = r.at
        except (ValueError, IndexError):
            at = max(at + 1, r.at)
        for began, end, v in sorted(r.closed, key=lambda x: x[0]):
            if text[began] == opening and end - began > best:
                best, found = end - began, v
    return best, found


def data(text: str | None, names: list[str], kind: type = dict):
    """The first export of a kind among names, else the largest literal of the kind; None without any."""
    for name in names:
        v = exported(text or "", name)
        if isinstance(v, kind):
            return v
    return largest(text or "", "{" if kind is dict else "[")[1]


def entries(names: list[str]):
    """A column function: script text to a map of key and JSON text of each entry; null where no object is found."""

    @F.pandas_udf("map<string,string>")
    def parsed(texts: pd.Series) -> pd.Series:
        def one(t):
            v = data(t, names)
            return None if v is None else {str(k): json.dumps(x, ensure_ascii=False) for k, x in v.items()}

        return texts.map(one)

    return parsed


def descriptions(names: list[str]):
    """A column function: script text to a map of car id and JSON text, from an object, or from an array whose items have an id."""

    @F.pandas_udf("map<string,string>")
    def parsed(texts: pd.Series) -> pd.Series:
        def one(t):
            v = next((x for n in names if (x := exported(t or "", n)) is not None), None)
            if v is None:
                v = max(largest(t or "", "{"), largest(t or "", "["), key=lambda x: x[0])[1]
            if isinstance(v, list):
                v = {str(i): x for x in v if isinstance(x, dict) and (i := x.get("id") or x.get("carId") or x.get("car_id"))}
            v = v if isinstance(v, dict) else {}
            return {str(k): json.dumps(x, ensure_ascii=False) for k, x in v.items()}

        return texts.map(one)

    return parsed


def ids(names: list[str]):
    """A column function: script text to an array of the listed ids' JSON texts; null without a list."""

    @F.pandas_udf("array<string>")
    def parsed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if (v := data(t, names, list)) is None else [x if isinstance(x, str) else json.dumps(x) for x in v])

    return parsed
