"""Licences that texts state, by an Aho-Corasick automaton over words and a parser of licence expressions.

Words are runs of digits, a to z (A-Z lower-cased) and characters beyond ASCII. One automaton of words holds all notice phrases and all identifier tags; it
walks a text once and reports every place, overlapping ones too. After a tag the rest of the line is read as an expression: a shunting-yard
pass with the precedence with, and, or turns it into postfix form, which is evaluated: ``or`` offers a choice, ``and`` demands both, ``with`` loosens a licence by an
exception. An identifier's label is its name without version, ``-only``, ``-or-later`` or number of clauses.

Every label has a freedom from 0 to 1 (``FREEDOM``, ``OTHER`` for the rest). ``or`` is the freer side, ``and`` the stricter one, an exception moves
a licence half way to 1. A text's score is that of its strictest statement, and 0 without any: no licence, no permission.

Defined cases: null and empty texts have no words, no labels (empty strings), null places and score 0. A tag whose expression is malformed (an operator without operand, an
open bracket, nothing) adds no label and is counted. A bracket that closes more than the expression opened, or a name right behind a name, ends it: prose follows. Very long texts are
walked in parts. A null doc_id is kept, repeated rows are rows. An empty table gives an empty result. Other columns are not read. Rows never move between tasks.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import ship

# Phrases whose places are counted, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Further notices.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "zlib license": "zlib",
    "boost software license": "bsl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "affero general public license": "agpl",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc": "cc-by-nc",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "dedicated to the public domain": "public-domain",
}

# Words of the tags that an expression follows.
TAGS = ("spdx license identifier", "license expression", "package license declared")

# How freely texts under a licence may be used.
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "0bsd": 1.0, "mit": 0.95, "isc": 0.95, "bsd": 0.95, "zlib": 0.95, "bsl": 0.95,
    "apache": 0.9, "cc-by": 0.9, "mpl": 0.6, "epl": 0.6, "lgpl": 0.6, "cc-by-sa": 0.5, "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.1,
    "cc-by-nc-sa": 0.1, "cc-by-nc-nd": 0.1,
}
OTHER = 0.25

PRECEDENCE = {"or": 1, "and": 2, "with": 3}
PART = 1 << 20
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_TOKEN = re.compile(rb"[ \t]*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_LEAD = re.compile(rb"[ \t\"'`]*[:=]?[ \t\"'`]*")
_VERSION = re.compile(r"(-v?\d[\d.]*)?(-only|-or-later)?\+?$")


class Automaton:
    """Finds phrases in a sequence of words; states go on from one call to the next."""

    def __init__(self, phrases: Iterable[Sequence[bytes]]):
        steps, ends, self.lengths = [{}], [[]], []
        for number, phrase in enumerate(phrases):
            state = 0
            for word in phrase:
                if word not in steps[state]:
                    steps[state][word] = len(steps)
                    steps.append({})
                    ends.append([])
                state = steps[state][word]
            ends[state].append(number)
            self.lengths.append(len(phrase))
        # Breadth first: a state also has the steps and ends of the longest other state that its words end in.
        queue = deque((state, 0) for state in steps[0].values())
        while queue:
            state, shorter = queue.popleft()
            queue.extend((after, steps[shorter].get(word, 0)) for word, after in steps[state].items())
            steps[state] = steps[shorter] | steps[state]
            ends[state] = ends[state] + ends[shorter]
        self.steps, self.ends = steps, ends

    def find(self, parts: Iterable[list[bytes]]) -> Iterator[tuple[int, int]]:
        """Place of the first word, and number, of every phrase found; the last item is the number of words and -1."""
        steps, ends, state, base = self.steps, self.ends, 0, 0
        for words in parts:
            here = steps[state]
            for i, word in enumerate(words, base):
                state = here.get(word, 0)
                here = steps[state]
                if state and ends[state]:
                    for number in ends[state]:
                        yield i + 1 - self.lengths[number], number
            base += len(words)
        yield base, -1


def plain(text: bytes) -> bytes:
    """Same length: capitals lowered, everything between words blank."""
    return text.translate(_PLAIN)


def word_parts(text: bytes, size: int = PART) -> Iterator[list[bytes]]:
    """Words of a plain text, about ``size`` bytes at a time."""
    start = 0
    while start < len(text):
        stop = text.find(b" ", start + size)
        stop = len(text) if stop < 0 else stop
        yield text[start:stop].split()
        start = stop


def label_of(identifier: str) -> str:
    name = identifier.rsplit(":", 1)[-1].lower().rstrip(".")
    return re.sub(r"-\d-clause.*$", "", _VERSION.sub("", name)) or name


def postfix(tokens: Iterable[str]) -> list[str] | None:
    """Shunting-yard: operands and operators (lower case) in postfix order; None if malformed."""
    out, stack, operand = [], [], True
    for token in tokens:
        operator = token.lower()
        if operator in PRECEDENCE:
            if operand:
                return None
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[operator]:
                out.append(stack.pop())
            stack.append(operator)
            operand = True
        elif token == "(":
            if not operand:
                break
            stack.append(token)
        elif token == ")":
            if "(" not in stack:
                break
            if operand:
                return None
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        else:
            if not operand:
                break
            out.append(token)
            operand = False
    if operand or "(" in stack:
        return None
    return out + stack[::-1]


@dataclass
class Value:
    freedom: float
    labels: frozenset[str]
    text: str
    strength: int = 4  # precedence of the outermost operator


def evaluate(form: Sequence[str]) -> Value | None:
    """Freedom, labels and text of a postfix form; None where an exception is no plain name."""
    stack: list[Value] = []
    for token in form:
        if token not in PRECEDENCE:
            label = label_of(token)
            stack.append(Value(FREEDOM.get(label, OTHER), frozenset([label]), token.rstrip(".")))
            continue
        right, left = stack.pop(), stack.pop()
        strength = PRECEDENCE[token]
        sides = [f"({v.text})" if v.strength < strength else v.text for v in (left, right)]
        text = f" {token.upper()} ".join(sides)
        if token == "with":
            if right.strength < 4:
                return None
            stack.append(Value((left.freedom + 1) / 2, left.labels, text, strength))
        else:
            choose = max if token == "or" else min
            stack.append(Value(choose(left.freedom, right.freedom), left.labels | right.labels, text, strength))
    return stack[0]


def tokens_at(text: bytes, place: int) -> Iterator[str]:
    """Tokens of the line from ``place`` on, as long as they follow each other."""
    place = _LEAD.match(text, place).end()
    while found := _TOKEN.match(text, place):
        yield found[1].decode()
        place = found.end()


@dataclass
class Scan:
    """What a text states. places: first words of base phrases; notices: word, label; expressions: word and value, None if malformed."""

    n_words: int = 0
    places: list[int] = field(default_factory=list)
    base: set[str] = field(default_factory=set)
    notices: list[tuple[int, str]] = field(default_factory=list)
    expressions: list[tuple[int, Value | None]] = field(default_factory=list)


def _phrases() -> list[tuple[str, str]]:
    return [*((p, "base") for p in BASE), *((p, "notice") for p in NOTICES), *((p, "tag") for p in TAGS)]


def scan(text: str | None, automaton: Automaton) -> Scan:
    """``automaton`` is that of :func:`build`."""
    raw = (text or "").encode()
    words, out, tags = plain(raw), Scan(), {}
    known = _phrases()
    for place, number in automaton.find(word_parts(words)):
        if number < 0:
            out.n_words = place
            break
        phrase, kind = known[number]
        if kind == "base":
            out.places.append(place)
            out.base.add(BASE[phrase])
            out.notices.append((place, BASE[phrase]))
        elif kind == "notice":
            out.notices.append((place, NOTICES[phrase]))
        else:
            tags[place + automaton.lengths[number] - 1] = place
    if tags:
        for i, word in enumerate(re.finditer(rb"[^ ]+", words)):
            if i in tags:
                form = postfix(tokens_at(raw, word.end()))
                out.expressions.append((tags[i], evaluate(form) if form else None))
    return out


def build() -> Automaton:
    return Automaton([tuple(w.encode() for w in phrase.split()) for phrase, _ in _phrases()])


def summary(found: Scan) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, malformed."""
    values = [v for _, v in found.expressions if v]
    labels = found.base.union((label for _, label in found.notices), *(v.labels for v in values))
    freedoms = [FREEDOM.get(label, OTHER) for _, label in found.notices] + [v.freedom for v in values]
    return (
        found.n_words, len(found.places), min(found.places, default=None), max(found.places, default=None), ",".join(sorted(found.base)),
        ",".join(sorted(labels)), min(freedoms, default=0.0), [v.text for v in values], len(found.expressions) - len(values))


_SUMMARY = [
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
    ("labels", pa.string()), ("score", pa.float64()), ("expressions", pa.list_(pa.string())), ("malformed", pa.int64())]


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = build()
    for batch in batches:
        rows = [summary(scan(text.as_py(), automaton)) for text in batch["text"]]
        columns = zip(*rows, strict=True) if rows else [[]] * len(_SUMMARY)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(c, kind) for c, (_, kind) in zip(columns, _SUMMARY, strict=True))],
            ["doc_id", *(name for name, _ in _SUMMARY)])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, malformed of every row of doc_id and text."""
    ship(docs.sparkSession)
    return _texts(docs).mapInArrow(
        _scanned, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "expressions array<string>, malformed long")


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = build()
    layout = pa.schema([("doc_id", pa.int64()), ("word", pa.int64()), ("kind", pa.string()), ("statement", pa.string()), ("freedom", pa.float64())])
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            found = scan(text.as_py(), automaton)
            rows += [(doc_id, word, "notice", label, FREEDOM.get(label, OTHER)) for word, label in found.notices]
            rows += [(doc_id, word, "expression" if v else "malformed", v and v.text, v and v.freedom) for word, v in found.expressions]
        yield pa.RecordBatch.from_pylist([dict(zip(layout.names, row, strict=True)) for row in rows], schema=layout)


def statements(docs: DataFrame) -> DataFrame:
    """doc_id, word, kind (notice, expression, malformed), statement and freedom: one row per finding."""
    ship(docs.sparkSession)
    return _texts(docs).mapInArrow(_found, "doc_id long, word long, kind string, statement string, freedom double")
