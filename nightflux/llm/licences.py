"""Licence scans: an Aho-Corasick automaton over words, and licence expressions by a shunting yard."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightflux.llm.common import SPACED, batches

#: What a licence asks of those who use the text: nothing, naming, the same licence for changes, for all of it, or more.
FREE, NAMING, CHANGES, WHOLE, CLOSED = 0.0, 0.25, 0.5, 0.75, 1.0

#: The base phrases and labels.
BASE = {"cc by": ("cc-by", NAMING), "general public license": ("gpl", WHOLE), "all rights reserved": ("reserved", CLOSED)}

#: Notice phrases of this method's own.
NOTICES = {
    "affero general public license": ("agpl", WHOLE),
    "apache license": ("apache", NAMING),
    "apache license version 2 0": ("apache-2.0", NAMING),
    "bsd license": ("bsd", NAMING),
    "cc by nc": ("cc-by-nc", CLOSED),
    "cc by nc nd": ("cc-by-nc-nd", CLOSED),
    "cc by nc sa": ("cc-by-nc-sa", CLOSED),
    "cc by nd": ("cc-by-nd", CLOSED),
    "cc by sa": ("cc-by-sa", CHANGES),
    "cc0": ("cc0", FREE),
    "creative commons attribution": ("cc-by", NAMING),
    "creative commons attribution noncommercial": ("cc-by-nc", CLOSED),
    "creative commons attribution sharealike": ("cc-by-sa", CHANGES),
    "eclipse public license": ("epl", CHANGES),
    "general public license version 2": ("gpl-2.0", WHOLE),
    "general public license version 3": ("gpl-3.0", WHOLE),
    "isc license": ("isc", NAMING),
    "lesser general public license": ("lgpl", CHANGES),
    "mit license": ("mit", NAMING),
    "mozilla public license": ("mpl", CHANGES),
    "permission is hereby granted free of charge": ("mit", NAMING),
    "public domain": ("public-domain", FREE),
    "redistribution and use in source and binary forms": ("bsd", NAMING),
    "the unlicense": ("unlicense", FREE),
}

#: Words of the tag before a licence expression.
TAG = "spdx license identifier"

#: Identifiers of expressions, without "-only", "-or-later" and "+".
KNOWN = {
    "0bsd": FREE, "cc0-1.0": FREE, "unlicense": FREE,
    "apache-2.0": NAMING, "bsd-2-clause": NAMING, "bsd-3-clause": NAMING, "bsl-1.0": NAMING, "cc-by-3.0": NAMING, "cc-by-4.0": NAMING,
    "isc": NAMING, "mit": NAMING, "zlib": NAMING,
    "cc-by-sa-3.0": CHANGES, "cc-by-sa-4.0": CHANGES, "epl-2.0": CHANGES, "lgpl-2.1": CHANGES, "lgpl-3.0": CHANGES, "mpl-2.0": CHANGES,
    "agpl-3.0": WHOLE, "gpl-2.0": WHOLE, "gpl-3.0": WHOLE,
}
#: Exceptions under which a work may use the licensed one and keep its own licence.
EXCEPTIONS = {"autoconf-exception-3.0", "bison-exception-2.2", "classpath-exception-2.0", "font-exception-2.0", "gcc-exception-3.1", "linux-syscall-note", "llvm-exception"}

BINDS = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(rb"[ \t]*([()]|[a-z0-9][a-z0-9.+_-]*)")
COLON = re.compile(rb"[ \t]*:")
WORD_PLACE = re.compile(rb"[^ ]+")


def expression_at(data: bytes, at: int) -> list[str]:
    """Tokens of the licence expression that starts at a place of lower-case text, up to what does not go on with it."""
    tokens: list[str] = []
    operand, depth = True, 0
    while found := TOKEN.match(data, at):
        token, at = found.group(1).decode(), found.end()
        if operand:
            if token == ")" or token in BINDS:
                break
            depth += token == "("
            operand = token == "("
        elif token in BINDS:
            operand = True
        elif token == ")" and depth:
            depth -= 1
        else:
            break
        tokens.append(token)
        if len(token) > 1 and token.endswith(".") and not operand:  # the end of a sentence
            tokens[-1] = token.rstrip(".")
            break
    return tokens


def postfix(tokens: Iterable[str]) -> list[str]:
    """The shunting yard: operands before their operator; a mistaken expression is a ValueError."""
    out: list[str] = []
    held: list[str] = []
    operand, before = True, ""
    for token in tokens:
        if operand != (token == "(" or (token != ")" and token not in BINDS)):
            raise ValueError(token)
        if (before, token) in ((")", "with"), ("with", "(")):
            raise ValueError("an exception goes with one identifier")
        before = token
        if token == "(":
            held.append(token)
        elif token == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise ValueError("no bracket opens")
            held.pop()
        elif token in BINDS:
            while held and held[-1] != "(" and BINDS[held[-1]] >= BINDS[token]:
                out.append(held.pop())
            held.append(token)
            operand = True
        else:
            out.append(token)
            operand = False
    if operand or "(" in held:
        raise ValueError("the expression does not end")
    return out + held[::-1]


def weight_of(identifier: str) -> float:
    """What an identifier asks; one that is not known counts as closed."""
    return KNOWN.get(re.sub(r"(-only|-or-later|\+)$", "", identifier), CLOSED)


@dataclass
class Expression:
    """A licence expression: of alternatives the mildest counts, of what holds together the strictest."""

    tokens: list[str]
    valid: bool = True
    weight: float = CLOSED
    identifiers: list[str] = field(default_factory=list)


def evaluate(tokens: list[str]) -> Expression:
    """The weight and the identifiers of an expression; a mistaken one is closed."""
    out = Expression(tokens)
    try:
        order = postfix(tokens)
        held: list[tuple[str | None, float]] = []
        for token in order:
            if token not in BINDS:
                held.append((token, weight_of(token)))
                continue
            (right, second), (left, first) = held.pop(), held.pop()
            if token != "with":
                held.append((None, min(first, second) if token == "or" else max(first, second)))
            elif left is None or right is None:
                raise ValueError("an exception goes with one identifier")
            else:
                held.append((None, min(first, CHANGES) if right in EXCEPTIONS and first < CLOSED else first))
        out.weight = held[0][1]
        behind = {k + 1 for k, token in enumerate(tokens) if token == "with"}
        out.identifiers = [t for k, t in enumerate(tokens) if t not in BINDS and t not in "()" and k not in behind]
    except ValueError:
        out.valid = False
    return out


class Scanner:
    """Finds phrases and tagged expressions in whole texts."""

    def __init__(self, base: dict[str, tuple[str, float]], notices: dict[str, tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        phrases: dict[str, list] = {}
        for kind, named in (("base", base), ("notice", notices)):
            for phrase, (label, weight) in named.items():
                phrases.setdefault(phrase, []).append((kind, label, weight))
        phrases.setdefault(TAG, []).append(("tag", "", 0.0))
        for phrase, values in phrases.items():
            self.automaton.add_word(f" {phrase} ".encode().decode("latin-1"), (phrase.count(" ") + 1, values))
        self.automaton.make_automaton()

    def places(self, data: bytes | None) -> tuple[int, list[tuple[str, str, float, int, int]], list[tuple[int, Expression]]]:
        """Number of words; kind, label, weight, first word and number of words of each place; expressions by the first word of their tag."""
        spaced = (data or b"").translate(SPACED)
        words = spaced.split()
        line = b" ".join([b"", *words, b""]) if words else b""
        found, tags = [], []
        seen = at = 0
        for end, (length, values) in self.automaton.iter(line.decode("latin-1")):
            seen += line.count(b" ", at, end + 1)  # ends ascend, so each blank is counted once
            at = end + 1
            first = seen - 1 - length
            for kind, label, weight in values:
                if kind == "tag":
                    tags.append(first)
                else:
                    found.append((kind, label, weight, first, length))
        return len(words), found, self._expressions(data, spaced, tags) if tags else []

    @staticmethod
    def _expressions(data: bytes, spaced: bytes, tags: list[int]) -> list[tuple[int, Expression]]:
        ends = dict.fromkeys(first + TAG.count(" ") for first in tags)
        for k, word in enumerate(WORD_PLACE.finditer(spaced)):
            if k in ends:
                ends[k] = word.end()
        lower, out = data.lower(), []
        for first in tags:
            if colon := COLON.match(lower, ends[first + TAG.count(" ")]):
                out.append((first, evaluate(expression_at(lower, colon.end()))))
        return out


def strictest(found: list[tuple[str, str, float, int, int]], expressions: list[tuple[int, Expression]]) -> float:
    """The largest weight of the places and expressions; a place inside a longer one does not count."""
    score, reach = max((e.weight for _, e in expressions), default=0.0), -1
    for _, _, weight, first, length in sorted(found, key=lambda x: (x[3], -x[4])):
        if first + length > reach or (first + length == reach and first == start and length == size):
            score, reach, start, size = max(score, weight), first + length, first, length
    return score


PLACES = "array<struct<kind string, label string, first long, words long>>"
EXPRESSIONS = "array<struct<first long, text string, valid boolean, weight double, identifiers array<string>>>"


def scan(docs: DataFrame, base: dict[str, tuple[str, float]] = BASE, notices: dict[str, tuple[str, float]] = NOTICES) -> DataFrame:
    """Licence notices of every whole text: ``doc_id``, ``n_words``, ``places``, ``expressions``, ``score``.

    Takes ``doc_id`` and ``text``; other columns do not matter.  Words are runs of digits, letters a to z (capitals made small)
    and all that is not ASCII.  ``places`` has each phrase of ``base`` and ``notices``, also where they overlap, ``expressions``
    the licence expressions behind tags.  ``score`` is what the strictest notice asks, from 0 to 1, and 0 without one.
    Null and empty texts have no words; every row, repeated ids and null ids too, gives one row.  A text is read once, in time
    linear in its length.
    """
    places = pa.list_(pa.struct([("kind", pa.string()), ("label", pa.string()), ("first", pa.int64()), ("words", pa.int64())]))
    read = pa.list_(pa.struct([("first", pa.int64()), ("text", pa.string()), ("valid", pa.bool_()), ("weight", pa.float64()), ("identifiers", pa.list_(pa.string()))]))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        for batch in batches(stream):
            counts, all_places, all_read, scores = [], [], [], []
            for data in batch.column(1).cast(pa.binary()).to_pylist():
                n, found, expressions = scanner.places(data)
                counts.append(n)
                all_places.append([{"kind": k, "label": label, "first": first, "words": length} for k, label, _, first, length in found])
                all_read.append([{"first": first, "text": " ".join(e.tokens), "valid": e.valid, "weight": e.weight, "identifiers": e.identifiers} for first, e in expressions])
                scores.append(strictest(found, expressions))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(all_places, places), pa.array(all_read, read), pa.array(scores, pa.float64())],
                ["doc_id", "n_words", "places", "expressions", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, places {PLACES}, expressions {EXPRESSIONS}, score double")


def joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, first and last base place and label lists of ``scan``'s rows; an expression that is mistaken has the label ``unparsed``."""
    base = F.filter("places", lambda p: p["kind"] == "base")
    first = F.transform(base, lambda p: p["first"])
    tagged = F.flatten(F.transform("expressions", lambda e: F.when(e["valid"], e["identifiers"]).otherwise(F.array(F.lit("unparsed")))))
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        joined(F.transform(base, lambda p: p["label"])).alias("base_labels"),
        joined(F.concat(F.transform("places", lambda p: p["label"]), tagged)).alias("labels"), "score")
