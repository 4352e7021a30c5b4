"""Licence scan: phrases and tags found by Aho-Corasick, licence expressions
evaluated by a shunting-yard parser.

A text's words (runs of letters, digits and everything beyond ASCII, lower case)
are joined by single spaces; one automaton finds every notice phrase as
consecutive words and every identifier tag.  What follows a tag in the raw text
is parsed as a licence expression (``AND``, ``OR``, ``WITH``, brackets): operators
go through a stack by precedence, and the postfix form is evaluated to the
alternatives it allows, sets of licences joined by OR.  ``choices`` states them for
each tag; the labels are all licences named.

Defined results: null or empty text has no words and no labels; a damaged
expression gives the licences read up to the damage, words that are no identifier
none; repeated rows are scanned one by one; a null id is carried along; texts are
scanned whole, whatever their length; an empty table gives an empty table; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerledger.llm.common import workers_ready
from playerledger.llm.words_np import buffer_of

#: Phrases whose places are counted, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notice phrases and their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "2 clause bsd": "bsd-2-clause",
    "3 clause bsd": "bsd-3-clause",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "isc license": "isc",
    "the unlicense": "unlicense",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0 1 0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
    "licensed under": "notice",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
TAG = "spdx license identifier"
#: Bytes scanned at once, and the words of the longest phrase.
PIECE = 1 << 18
MOST_WORDS = max(len(p.split()) for p in [*BASE, *NOTICES, TAG])
#: The tag in raw text, and the line after it.
TAG_LINE = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
#: Identifiers without a digit or a hyphen.
PLAIN_NAMES = frozenset("mit isc zlib unlicense apache gpl lgpl agpl mpl bsd epl bsl cc0 wtfpl ncsa postgresql openssl python ruby curl x11 vim "
                        "libpng beerware json ntp sleepycat afl artistic cddl eupl ofl psf".split())
TOKEN = re.compile(r"[()]|[A-Za-z0-9.+-]+")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
#: Alternatives an expression is expanded to at most; a longer one is kept as one set of all its licences.
MOST_ALTERNATIVES = 64

_WORD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
              for c in range(256))


def named(word: str) -> bool:
    """Whether a word can be a licence's identifier: one of the plain names, or one with a digit or a hyphen inside."""
    return word in PLAIN_NAMES or re.fullmatch(r"(?=[^0-9-]*[0-9-])[a-z0-9][a-z0-9.+-]*", word) is not None


def postfix(expression: str, strict: bool = False) -> list[str]:
    """The tokens of a licence expression in postfix order (shunting yard).

    Stops at the first token that can't stand where it does; what stands before it then
    counts only as far as it names licences (``strict``).
    """
    out: list[str] = []
    stack: list[str] = []
    operand, broken = False, True
    for token in TOKEN.findall(expression):
        word = token.lower().rstrip(".")
        if word in PRECEDENCE:
            if not operand:
                break
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[word]:
                out.append(stack.pop())
            stack.append(word)
            operand = False
        elif token == "(":
            if operand:
                break
            stack.append(token)
        elif token == ")":
            if not operand or "(" not in stack:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        else:
            if operand or (strict and not named(word)):
                break
            out.append(word)
            operand = True
    else:
        broken = False
    if broken and not strict:
        return postfix(expression, True)
    if not operand and stack and stack[-1] != "(":
        stack.pop()  # an operator without its right side
    out += [t for t in reversed(stack) if t != "("]
    return out


def alternatives(expression: str) -> set[frozenset[str]]:
    """The sets of licences an expression lets one choose from."""
    values: list[set[frozenset[str]]] = []
    for token in postfix(expression):
        if token not in PRECEDENCE:
            values.append({frozenset([token])})
        elif len(values) > 1:
            right, left = values.pop(), values.pop()
            if token == "or":
                joined = left | right
            elif token == "and":
                joined = {a | b for a in left for b in right}
            else:
                joined = {frozenset(f"{x} with {y}" for x in a for y in b) for a in left for b in right}
            if len(joined) > MOST_ALTERNATIVES:
                joined = {frozenset().union(*joined)}
            values.append(joined)
    return values[-1] if values else set()


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick
    found = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def _pieces(text: bytes) -> Iterator[tuple[int, int, str]]:
    """(number of the first word, words known from the piece before, words joined by spaces).

    Long texts come in pieces, each led by the last words of the one before, so that
    a phrase across the cut is whole in one of them.
    """
    plain, at, number, known = text.translate(_WORD), 0, 0, []
    while at < len(plain):
        end = len(plain)
        if at + PIECE < end:
            end = plain.find(b" ", at + PIECE)
            end = len(plain) if end < 0 else end
        words = known + plain[at:end].split()
        if len(words) > len(known):
            yield number - len(known), len(known), (b" " + b" ".join(words) + b" ").decode()
        number += len(words) - len(known)
        known, at = words[-(MOST_WORDS - 1):], end
    yield number, 0, ""


def scan(text: bytes) -> tuple[int, int, int | None, int | None, str, str, float, str]:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, choices) of one text's UTF-8 bytes.

    ``choices``: for each different tag the sets of licences it lets one choose from, as
    ``mit;apache-2.0+bsd-3-clause``, tags parted by ``|``.
    """
    n_words, n_base, first, last, phrases, tags = 0, 0, None, None, set(), 0
    for number, known, joined in _pieces(text):
        n_words = number + joined.count(" ") - 1 if joined else number
        for end, phrase in automaton().iter(joined):
            # a word's number is the number of spaces before it, less the one in front
            if known and joined.count(" ", 0, end) <= known:
                continue  # whole in the piece before
            phrases.add(phrase)
            tags += phrase == TAG
            if phrase in BASE:
                place = number + joined.count(" ", 0, end - len(phrase) - 1)
                n_base += 1
                first, last = place if first is None else min(first, place), place if last is None else max(last, place)
    base = {BASE[p] for p in phrases if p in BASE}
    labels = base | {NOTICES[p] for p in phrases if p in NOTICES}
    choices = {frozenset(alternatives(line)) for line in TAG_LINE.findall(text.decode())} - {frozenset()} if tags else set()
    labels |= {name for sets in choices for choice in sets for name in choice}
    told = sorted(";".join(sorted("+".join(sorted(c)) for c in sets)) for sets in choices)
    tags = len(choices)
    # tags are sure, phrases nearly so, the wording of notices less
    sure = 1.0 if labels and tags else 0.9 if base else 0.5 if labels else 0.0
    return n_words, n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), sure, "|".join(told)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffer_of(batch.column(1))
        rows = [scan(data[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
        cols = list(zip(*rows)) if rows else [[]] * 8
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                         ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "choices"])


def licenses(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The licence findings of every row of ``docs``."""
    workers_ready(docs.sparkSession)
    cols = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return cols.mapInArrow(_scan, f"id {cols.schema['id'].dataType.simpleString()}, n_words long, n_base long, "
                                  "first_word long, last_word long, base_labels string, labels string, score double, choices string"
                           ).withColumnRenamed("id", id)
