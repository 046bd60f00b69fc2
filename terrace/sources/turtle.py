"""Turtle as triples, for ontologies: a file is one text, as prefixes hold for all that follows and statements span lines.

One task reads one file; a dump of many triples comes as N-Triples, which is read line by line. Files named after one
format often hold the other, so ``read_ontology`` looks at the first lines instead of the name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.text import LETTER_ESCAPES
from terrace.sources.ntriples import parse_triples, read_lines

HEAD_LINES = 20
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
SCHEMA = "s string, p string, o string, o_is_iri boolean, lang string, datatype string"

_TOKEN = re.compile(
    r"""(?P<space>[ \t\r\n]+|\#[^\r\n]*)
    |(?P<iri><(?:[^\x00-\x20<>"{}|^`\\]|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8})*>)
    |(?P<long>\"\"\"(?:\"{0,2}(?:[^"\\]|\\.))*\"\"\"|'''(?:'{0,2}(?:[^'\\]|\\.))*''')
    |(?P<short>"(?:[^"\\\r\n]|\\.)*"|'(?:[^'\\\r\n]|\\.)*')
    |(?P<prefix>@prefix\b|(?i:prefix)(?=[ \t\r\n]))
    |(?P<base>@base\b|(?i:base)(?=[ \t\r\n]))
    |(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
    |(?P<type>\^\^)
    |(?P<blank>_:\w(?:[\w\-]|\.(?=[\w\-]))*)
    |(?P<name>(?:[^\W\d_](?:[\w\-]|\.(?=[\w\-]))*)?:(?:[\w:%\-]|\\[^\w\s]|\.(?=[\w:%\-]))*)
    |(?P<double>[+-]?(?:\d+\.?\d*|\.\d+)[eE][+-]?\d+)
    |(?P<decimal>[+-]?\d*\.\d+)
    |(?P<integer>[+-]?\d+)
    |(?P<word>(?:a|true|false)(?![\w:]))
    |(?P<mark>[.;,\[\]()])""",
    re.VERBOSE | re.DOTALL,
)
_ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", re.DOTALL)


def _unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else LETTER_ESCAPES.get(m[3], m[0]), text)


class TurtleError(ValueError):
    """The text is not Turtle; the message gives the line."""


class _Reader:
    def __init__(self, text: str):
        self.text, self.tokens, at = text, [], 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TurtleError(f"line {text.count(chr(10), 0, at) + 1}: cannot read {text[at : at + 20]!r}")
            if m.lastgroup != "space":
                self.tokens.append((m.lastgroup, m.group(), at))
            at = m.end()
        self.at, self.base, self.prefixes, self.made = 0, "", {}, 0
        self.out: list[tuple] = []

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at][:2] if self.at < len(self.tokens) else ("end", "")

    def take(self, kind: str, value: str | None = None) -> str:
        got = self.peek()
        if got[0] != kind or (value is not None and got[1] != value):
            where = self.tokens[self.at][2] if self.at < len(self.tokens) else len(self.text)
            raise TurtleError(f"line {self.text.count(chr(10), 0, where) + 1}: {value or kind} expected, {got[1] or 'end'!r} found")
        self.at += 1
        return got[1]

    def fresh(self) -> str:
        self.made += 1
        return f"_:t{self.made}"

    def read(self) -> list[tuple]:
        while self.peek()[0] != "end":
            kind, value = self.peek()
            if kind in ("prefix", "base"):
                self.at += 1
                name = self.take("name") if kind == "prefix" else None
                iri = self.iri(self.take("iri"))
                if kind == "prefix":
                    self.prefixes[name[:-1]] = iri
                else:
                    self.base = iri
                if value.startswith("@"):
                    self.take("mark", ".")
                continue
            open_ = self.peek() == ("mark", "[")
            subject = self.node()
            if not (open_ and self.peek() == ("mark", ".")):
                self.properties(subject)
            self.take("mark", ".")
        return self.out

    def iri(self, token: str) -> str:
        inner = _unescaped(token[1:-1])
        return urljoin(self.base, inner) if self.base else inner

    def properties(self, subject: str) -> None:
        while True:
            if self.peek() == ("word", "a"):
                self.at += 1
                predicate = RDF + "type"
            else:
                predicate = self.named()
            while True:
                self.object(subject, predicate)
                if self.peek() != ("mark", ","):
                    break
                self.at += 1
            if self.peek() != ("mark", ";"):
                return
            while self.peek() == ("mark", ";"):
                self.at += 1
            if self.peek() in (("mark", "."), ("mark", "]")):
                return

    def named(self) -> str:
        kind, value = self.peek()
        if kind == "iri":
            self.at += 1
            return self.iri(value)
        value = self.take("name")
        prefix, _, local = value.partition(":")
        if prefix not in self.prefixes:
            raise TurtleError(f"unknown prefix {prefix!r}")
        return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)

    def node(self) -> str:
        """A subject, or an object that is no literal; what brackets hold comes out first."""
        kind, value = self.peek()
        if kind == "blank":
            self.at += 1
            return value
        if (kind, value) == ("mark", "["):
            self.at += 1
            me = self.fresh()
            if self.peek() != ("mark", "]"):
                self.properties(me)
            self.take("mark", "]")
            return me
        if (kind, value) == ("mark", "("):
            self.at += 1
            head = last = None
            while self.peek() != ("mark", ")"):
                me = self.fresh()
                if last is None:
                    head = me
                else:
                    self.out.append((last, RDF + "rest", me, False, None, None))
                self.object(me, RDF + "first")
                last = me
            self.at += 1
            if last is None:
                return RDF + "nil"
            self.out.append((last, RDF + "rest", RDF + "nil", True, None, None))
            return head
        return self.named()

    def object(self, subject: str, predicate: str) -> None:
        kind, value = self.peek()
        lang = datatype = None
        if kind in ("short", "long"):
            self.at += 1
            cut = 3 if kind == "long" else 1
            text = _unescaped(value[cut:-cut])
            if self.peek()[0] == "lang":
                lang = self.take("lang")[1:]
            elif self.peek()[0] == "type":
                self.at += 1
                datatype = self.named()
        elif kind in ("integer", "decimal", "double") or value in ("true", "false"):
            self.at += 1
            text, datatype = value, XSD + ("boolean" if kind == "word" else kind)
        else:
            text = self.node()
            self.out.append((subject, predicate, text, not text.startswith("_:"), None, None))
            return
        self.out.append((subject, predicate, text, False, lang, datatype))


def parse_turtle(text: str) -> list[tuple]:
    """(s, p, o, o_is_iri, lang, datatype) of each statement. Raises ``TurtleError``."""
    return _Reader(text).read()


def read_turtle(spark: SparkSession, path: str) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text in frame["value"]:
                yield pd.DataFrame(parse_turtle(text), columns=["s", "p", "o", "o_is_iri", "lang", "datatype"])

    return spark.read.text(path, wholetext=True).mapInPandas(run, SCHEMA)


def read_ontology(spark: SparkSession, path: str) -> DataFrame:
    """The triples of an ontology file, Turtle if its first lines hold a prefix or base, else N-Triples."""
    head = read_lines(spark, path).limit(HEAD_LINES)
    turtle = head.filter(F.col("value").rlike(r"@prefix|@base|^\s*PREFIX ")).limit(1).count()
    return read_turtle(spark, path) if turtle else parse_triples(read_lines(spark, path))
