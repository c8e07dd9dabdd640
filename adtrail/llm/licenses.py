"""Operator 7: licence scan with an Aho-Corasick automaton and an expression parser.

Two kinds of evidence are looked for in every whole text:

* notice phrases, as runs of words, by a word-level Aho-Corasick automaton: one
  step per word finds all places of all phrases;
* identifier tags (``spdx license identifier``, the words joined by any
  characters that are no words), found by the same automaton; the licence
  expression after each tag is read from the raw text and parsed by the
  shunting-yard method (``with`` binds before ``and``, ``and`` before ``or``).

An expression's value is its alternatives: each a set of licences that hold
together.  ``or`` puts alternatives side by side, ``and`` joins each of one side
with each of the other, ``with`` leaves its licence as it is; an alternative that
asks for more than another is left out.  Beyond ``MAX_ALTERNATIVES`` combinations
``alternatives`` is empty; ``labels`` names every licence in any case.  Unknown identifiers are passed over
and clear ``all_known``; prose after an expression ends it.  ``alternatives`` gives
the choices of a text's tags (``gpl+mit|apache``: both, or the third), so ``MIT OR
GPL-2.0`` (``gpl|mit``) and ``MIT AND GPL-2.0`` (``gpl+mit``) differ; tags of one
text hold together.

Words are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII
characters.  A phrase counts at every place, overlapping places too.

Score: ``1 - prod(1 - c)`` over the kinds of evidence found, with the
confidences ``TAG_CONFIDENCE`` (an expression known as a whole), ``PART_CONFIDENCE``
(expressions known in part), ``PHRASE_CONFIDENCE`` (each different phrase).

Defined results: null text = empty text: no words, no labels (empty strings),
null positions, score 0.  A malformed expression, or one without a known licence,
gives no labels.  A text of any length is read as a whole, in linear time; an
empty table gives an empty result.  Repeated rows give repeated results; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of the base scan: phrase -> label.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Phrases and labels of this scan's own.
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "creative commons": "cc",
    "under cc by": "cc",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "isc license": "isc",
    "eclipse public license": "epl",
    "public domain": "public-domain",
    "the unlicense": "unlicense",
    "all rights reserved": "proprietary",
    "boost software license": "boost",
    "zlib license": "zlib",
    "server side public license": "sspl",
    "business source license": "busl",
    "open font license": "ofl",
    "artistic license": "artistic",
    "python software foundation license": "psf",
    "european union public licence": "eupl",
    "common development and distribution license": "cddl",
    "free documentation license": "gfdl",
    "open database license": "odbl",
    "open software license": "osl",
    "academic free license": "afl",
}
TAG = "spdx license identifier"
# Identifier (lower case, up to its version) -> label, where they differ.
IDENTIFIERS = {
    "bsl": "boost", "cc0": "public-domain", "cc-pddc": "public-domain", "cc-by": "cc", "0bsd": "bsd", "odc-by": "odbl",
    "python": "psf", "x11": "mit", "mulanpsl": "mulan", "blueoak": "blue-oak", "wtfpl": "wtfpl", "ms-pl": "ms-pl", "ms-rl": "ms-rl",
}
# Identifiers that are their own labels.
IDENTIFIERS |= {name: name for name in (
    "mit", "apache", "gpl", "lgpl", "agpl", "bsd", "mpl", "isc", "epl", "unlicense", "cc-by-sa", "cc-by-nc", "cc-by-nd", "cc-by-nc-sa", "cc-by-nc-nd",
    "zlib", "sspl", "busl", "ofl", "artistic", "psf", "eupl", "cddl", "gfdl", "odbl", "osl", "afl", "ncsa", "postgresql", "openssl", "php", "ruby",
    "vim", "w3c", "unicode", "icu", "curl", "ecl", "upl", "zpl", "cpl", "ipl", "lppl", "libpng", "ntp", "hpnd", "json", "cecill", "bzip2", "ftl", "tcl")}
TAG_CONFIDENCE, PART_CONFIDENCE, PHRASE_CONFIDENCE = 0.95, 0.8, 0.7

# Everything that is no word byte becomes a space; A-Z become a-z.
_FOLD = bytes(32 if c < 48 or 58 <= c < 65 or 91 <= c < 97 or 123 <= c < 128 else c + 32 if 65 <= c < 91 else c for c in range(256))
# The tag as the automaton sees it: its words between bytes that are none.
_GAP = rb"[^0-9A-Za-z\x80-\xff]+"
_TAG_RAW = re.compile(rb"(?<![0-9A-Za-z\x80-\xff])" + _GAP.join(map(re.escape, TAG.encode().split()))
                      + rb"(?![0-9A-Za-z\x80-\xff])[ \t]*[:=]?[ \t]*([a-z0-9.+\-() \t]*)", re.I)
_TOKEN = re.compile(r"[()]|[a-z0-9.+\-]+")


class WordAutomaton:
    """Aho-Corasick over words: states are word prefixes of the phrases."""

    def __init__(self, phrases: list[str]):
        self.goto: list[dict[bytes, int]] = [{}]
        own: list[list[int]] = [[]]
        for number, phrase in enumerate(phrases):
            state = 0
            for word in phrase.encode().split():
                if word not in self.goto[state]:
                    self.goto[state][word] = len(self.goto)
                    self.goto.append({})
                    own.append([])
                state = self.goto[state][word]
            own[state].append(number)
        self.found = own
        self.lengths = [len(p.split()) for p in phrases]
        # Breadth first: a state falls back to its longest proper suffix; the
        # steps of that state are entered here too, so no fallback is left to follow.
        fall = [0] * len(self.goto)
        queue = list(self.goto[0].values())
        for state in queue:
            queue += self.goto[state].values()
            for word, child in self.goto[state].items():
                fall[child] = self.goto[fall[state]].get(word, 0)
            self.found[state] = self.found[state] + self.found[fall[state]]
            self.goto[state] = {w: c for w, c in self.goto[fall[state]].items() if w not in self.goto[state]} | self.goto[state]

    def places(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(phrase, first word) of every place, in order of the last word."""
        goto, found, start = self.goto, self.found, self.goto[0]
        out, steps = [], start
        for i, word in enumerate(words):
            state = steps.get(word)
            if state is None:
                steps = start
                continue
            steps = goto[state]
            for number in found[state]:
                out.append((number, i + 1 - self.lengths[number]))
        return out


MAX_ALTERNATIVES = 1024
_RANK = {"or": 1, "and": 2, "with": 3}


class Choice(NamedTuple):
    """A licence expression's value: its alternatives, each the licences that hold
    together (None: more than ``MAX_ALTERNATIVES``), all licences it names, and
    whether every identifier was known."""

    alternatives: frozenset[frozenset[str]] | None
    named: frozenset[str]
    all_known: bool

    def __str__(self) -> str:
        return "|".join(sorted("+".join(sorted(a)) for a in self.alternatives or ()))


def _least(alternatives: Iterable[frozenset[str]]) -> frozenset[frozenset[str]]:
    """Without the alternatives that ask for more than another one does."""
    kept: list[frozenset[str]] = []
    for a in sorted(set(alternatives), key=len):
        if not any(k <= a for k in kept):
            kept.append(a)
    return frozenset(kept)


def _combine(a: Choice, b: Choice, conjunction: bool) -> Choice:
    named, all_known = a.named | b.named, a.all_known and b.all_known
    if not (a.named and b.named):             # a side of which nothing is known adds nothing
        return Choice((a if a.named else b).alternatives, named, all_known)
    x, y = a.alternatives, b.alternatives
    if x is None or y is None or (len(x) * len(y) if conjunction else len(x) + len(y)) > MAX_ALTERNATIVES:
        return Choice(None, named, all_known)
    return Choice(_least((p | q for p in x for q in y) if conjunction else x | y), named, all_known)


def either(a: Choice, b: Choice) -> Choice:
    """The alternatives of both sides."""
    return _combine(a, b, False)


def both(a: Choice, b: Choice) -> Choice:
    """Each alternative of one side with each of the other."""
    return _combine(a, b, True)


_APPLY = {"or": either, "and": both, "with": lambda licence, exception: licence}


def evaluate(expression: str) -> Choice | None:
    """The value of a licence expression, or None if it is malformed."""
    values: list[Choice] = []
    operators: list[str] = []

    def apply() -> None:
        b, a = values.pop(), values.pop()
        values.append(_APPLY[operators.pop()](a, b))

    tokens = _TOKEN.findall(expression.lower())
    expect = True              # a licence or "(" must come next
    for at, token in enumerate(tokens):
        if expect != (token == "(" or token not in _RANK and token != ")"):
            if not expect:
                break          # a word or "(" after a whole operand: prose
            return None
        if token == "(":
            operators.append(token)
        elif token == ")":
            while operators and operators[-1] != "(":
                apply()
            if not operators:
                return None
            operators.pop()
        elif token in _RANK:
            if _prose(tokens[at + 1:at + 3]):
                break
            while operators and operators[-1] != "(" and _RANK[operators[-1]] >= _RANK[token]:
                apply()
            operators.append(token)
            expect = True
        else:
            values.append(_label(token))
            expect = False
    if expect or "(" in operators:
        return None
    while operators:
        apply()
    return values[0]


def _prose(following: list[str]) -> bool:
    """Is this the start of a sentence, not an operand: an unknown word with another word after it?"""
    if len(following) < 2 or any(w in _RANK or w in "()" for w in following):
        return False
    return not _label(following[0]).all_known


def _label(identifier: str) -> Choice:
    """The label of an identifier, its version and suffix aside."""
    parts = identifier.rstrip("+.").split("-")
    for n in range(len(parts), 0, -1):
        label = IDENTIFIERS.get("-".join(parts[:n]))
        if label:
            return Choice(frozenset([frozenset([label])]), frozenset([label]), True)
    return Choice(frozenset(), frozenset(), False)


PHRASES = [*BASE, *NOTICES, TAG]
_LABELS = [*BASE.values(), *NOTICES.values(), None]


def scan(text: bytes, automaton: WordAutomaton) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, expressions, score, alternatives, all_known)."""
    words = text.translate(_FOLD).split(b" ")
    words = [w for w in words if w]
    places = automaton.places(words)
    if not places:
        return len(words), 0, None, None, "", "", "", 0.0, "", None
    base = [(p, at) for p, at in places if p < len(BASE)]
    starts = [at for _, at in base]
    base_labels = {_LABELS[p] for p, _ in base}
    kinds = {p for p, _ in places}
    labels = {_LABELS[p] for p in kinds} - {None}
    doubt, read, value = 1.0, [], None
    for _ in kinds - {len(PHRASES) - 1}:
        doubt *= 1 - PHRASE_CONFIDENCE
    if len(PHRASES) - 1 in kinds:
        for m in _TAG_RAW.finditer(text):
            expression = m[1].decode().strip()
            found = evaluate(expression)
            if found is not None and found.named:
                value = found if value is None else both(value, found)
                read.append(" ".join(expression.split()))
        if value is not None:
            labels |= value.named
            doubt *= 1 - (TAG_CONFIDENCE if value.all_known else PART_CONFIDENCE)
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)),
            "; ".join(read), round(1 - doubt, 9), str(value or ""), None if value is None else value.all_known)


def scan_licenses(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document with its places, labels, expressions, score, choices of
    its expressions and whether all of them is known (null without any)."""
    one = docs.select(docs[key].alias("__key"), docs[text].cast("string").alias("__text"))
    kind = one.schema["__key"].dataType.simpleString()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "expressions", "score", "alternatives", "all_known"]
    types = [pa.int64()] * 4 + [pa.string()] * 3 + [pa.float64(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = WordAutomaton(PHRASES)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                rows = [scan(t or b"", automaton) for t in part.column(1).cast(pa.binary()).to_pylist()]
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], [key, *names])

    return one.mapInArrow(run, f"`{key}` {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                               "base_labels string, labels string, expressions string, score double, alternatives string, all_known boolean")
