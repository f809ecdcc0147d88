"""Nearly JSON made JSON: a stack automaton over the characters that mends and lists what it mended.

The stack holds the open brackets; in each of them the automaton expects a key, a colon, a value, or what comes after a
value. What it meets instead says what is missing: a comma, a bracket, a quotation mark. The one guess is whether a
mark within a string ends it: it does if what follows could only follow a string there. A mark that doesn't is escaped,
so a string is never cut short.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What an edit can be.
EDITS = ("escape", "control", "quote", "comma", "colon", "value", "bracket", "comment", "drop", "end")
REPAIRED = T.StructType([
    T.StructField("json", T.StringType()),
    T.StructField("edits", T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("edit", T.StringType())]))),
])
_CLOSERS = {'"': '"', "“": "”", "'": "'"}
_WORDS = {"true": "true", "false": "false", "null": "null", "True": "true", "False": "false", "None": "null"}
_KEY = r"""(?:"(?:\\.|[^"\\\n]){0,200}"|“[^”\n]{0,200}”|'[^'\n]{0,200}'|[A-Za-z_]\w{0,200})\s*:"""
#: What follows the mark at the end of a key, of a value in an object, and of one in an array.
_GAP = r"(?:\s|//[^\n]*)*+"
_AFTER_KEY = re.compile(r"\s*:")
_CUT_KEY = r'"(?:\\.|[^"\\\n]){0,200}\\?(?:"\s*)?$'
_AFTER_VALUE = re.compile(rf"{_GAP}(?:\}}|$|,{_GAP}(?:\}}|$|{_KEY}|{_CUT_KEY})|{_KEY})")
_AFTER_ITEM = re.compile(rf"""{_GAP}(?:\]|$|\}}\s*(?:$|[,}}\]])|,{_GAP}(?:\]|$|["“'{{\[]|-?\d|(?:true|false|null)\b))|\s*\n\s*["“{{\[]""")
_BARE = re.compile(r"[^\s,:{}\[\]\"]+")
_SKIP = re.compile(r"\s+|//[^\n]*|/\*.*?(?:\*/|$)|```\w*", re.S)


@dataclass
class _Automaton:
    text: str
    at: int
    out: list[str] = field(default_factory=list)
    edits: list[tuple[int, str]] = field(default_factory=list)
    stack: list[str] = field(default_factory=list)
    expects: str = "value"

    def edit(self, what: str) -> None:
        self.edits.append((self.at, what))

    def run(self) -> str:
        while True:
            self.skip()
            if self.at >= len(self.text):
                break
            getattr(self, self.expects)(self.text[self.at])
            if not self.stack:
                return "".join(self.out)
        self.finish()
        return "".join(self.out)

    def skip(self) -> None:
        while m := _SKIP.match(self.text, self.at):
            if m[0].isspace():
                self.out.append(m[0])
            else:
                self.edit("comment")
            self.at = m.end()

    def put(self, c: str, expects: str) -> None:
        self.out.append(c)
        self.at += 1
        self.expects = expects

    def open(self, c: str) -> None:
        self.stack.append(c)
        self.put(c, "key" if c == "{" else "value")

    def close(self, c: str) -> None:
        """Close up to the bracket that ``c`` closes; if none is open, ``c`` goes."""
        own = "{" if c == "}" else "["
        if own not in self.stack:
            self.edit("drop")
            self.at += 1
            return
        self.tidy()
        while self.stack[-1] != own:
            self.edit("bracket")
            self.out.append("}" if self.stack.pop() == "{" else "]")
        self.stack.pop()
        self.put(c, "after")

    def tidy(self) -> None:
        """What is missing before a bracket closes: a comma without an item goes, a key without a value gets null."""
        if self.expects in ("key", "value") and self.last() == ",":
            self.edit("comma")
            k = max(i for i, x in enumerate(self.out) if x == ",")
            del self.out[k]
        elif self.expects == "colon":
            self.edit("value")
            self.out.append(": null")
        elif self.expects == "value" and self.stack[-1] == "{":
            self.edit("value")
            self.out.append("null")

    def last(self) -> str:
        return next((x for x in reversed(self.out) if not x.isspace()), "")

    def key(self, c: str) -> None:
        if c in _CLOSERS:
            self.string(c, "colon")
        elif c in "}]":
            self.close(c)
        elif m := _BARE.match(self.text, self.at):
            self.edit("quote")
            self.out.append(json.dumps(m[0], ensure_ascii=False))
            self.at, self.expects = m.end(), "colon"
        else:
            self.edit("drop")
            self.at += 1

    def colon(self, c: str) -> None:
        if c == ":":
            self.put(c, "value")
        elif c in "}]":
            self.close(c)
        else:
            self.edit("colon")
            self.out.append(":")
            self.expects = "value"

    def value(self, c: str) -> None:
        if c in "{[":
            self.open(c)
        elif c in _CLOSERS:
            self.string(c, "after")
        elif c in "}]":
            self.close(c)
        elif c == ",":
            if self.stack[-1] == "{":
                self.edit("value")
                self.out.append("null")
                self.expects = "after"
            else:
                self.edit("drop")
                self.at += 1
        elif c == ":":
            self.edit("drop")
            self.at += 1
        else:
            m = _BARE.match(self.text, self.at)
            word = _WORDS.get(m[0])
            if word is None:
                try:
                    json.loads(m[0])
                    word = m[0]
                except ValueError:
                    word = json.dumps(m[0], ensure_ascii=False)
            if word != m[0]:
                self.edit("quote" if word[0] == '"' else "value")
            self.out.append(word)
            self.at, self.expects = m.end(), "after"

    def after(self, c: str) -> None:
        if c == ",":
            self.put(c, "key" if self.stack[-1] == "{" else "value")
        elif c in "}]":
            self.close(c)
        elif c == ":":
            self.edit("drop")
            self.at += 1
        else:
            self.edit("comma")
            self.out.append(",")
            self.expects = "key" if self.stack[-1] == "{" else "value"

    def string(self, mark: str, then: str) -> None:
        """Copy a string; ``then`` is what is expected behind it."""
        ends = _AFTER_KEY if then == "colon" else _AFTER_VALUE if self.stack[-1] == "{" else _AFTER_ITEM
        closer = _CLOSERS[mark]
        if mark != '"':
            self.edit("quote")
        self.out.append('"')
        self.at += 1
        while self.at < len(self.text):
            c = self.text[self.at]
            if c == "\\" and self.at + 1 < len(self.text):
                pair = self.text[self.at : self.at + 2]
                good = pair[1] in '"\\/bfnrt' or re.match(r"\\u[0-9a-fA-F]{4}", self.text[self.at : self.at + 6])
                if not good:
                    self.edit("escape")
                self.out.append(pair if good else pair[1] if pair[1] == "'" else "\\\\" if pair[1] < " " else "\\\\" + pair[1])
                self.at += 1 if not good and pair[1] < " " else 2
                continue
            if c == closer and ends.match(self.text, self.at + 1):
                self.put('"', then)
                return
            if c == '"':
                self.edit("escape")
                self.out.append('\\"')
            elif c == "\\":
                self.edit("escape")
                self.out.append("\\\\")
            elif c < " ":
                self.edit("control")
                self.out.append(json.dumps(c)[1:-1])
            else:
                self.out.append(c)
            self.at += 1
        self.edit("end")
        self.out.append('"')
        self.expects = then

    def finish(self) -> None:
        if self.stack:
            self.tidy()
            self.edit("end")
        while self.stack:
            self.out.append("}" if self.stack.pop() == "{" else "]")


def repair_text(text: str | None) -> tuple[str | None, list[tuple[int, str]]]:
    """``(object, edits)``: the first object in a text as JSON, and what was mended at which place (from 0).

    Text before and behind the object is left out and is no edit. No object, or an empty one, is null.
    """
    begin = text.find("{") if text else -1
    if begin < 0:
        return None, []
    machine = _Automaton(text, begin)
    try:
        value, end = json.JSONDecoder().raw_decode(text, begin)
        done = text[begin:end]
    except (ValueError, RecursionError):
        value = done = None
    try:
        if value is None:
            value = json.loads(done := machine.run())
    except (ValueError, RecursionError):
        return None, []
    return (done, machine.edits) if isinstance(value, dict) and value else (None, [])


@F.pandas_udf(REPAIRED)
def _repaired(texts: pd.Series) -> pd.DataFrame:
    rows = [repair_text(x) for x in texts]
    return pd.DataFrame({"json": [j for j, _ in rows], "edits": [[{"at": a, "edit": e} for a, e in edits] for _, edits in rows]})


def repaired(text: Column) -> Column:
    """``struct(json, edits)``; see ``repair_text``."""
    return _repaired(text)


def repair(text: Column) -> Column:
    """The object alone."""
    return _repaired(text)["json"]
