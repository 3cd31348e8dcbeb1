"""Exact byte-pair counts of every prefix: which token ends a prefix follows from the prefixes before it."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightflux.llm.common import Remember, batches


class PrefixMerges:
    """Byte-pair encoding of all prefixes of a string in one pass.

    The encoding of a prefix ends in exactly one token t, and that token is the one for which
    (last token of the prefix without t, t) is itself what merging gives for their joined text.  An
    Aho-Corasick automaton names the tokens that end at each position, longest first,
    through its output links; the pair test is remembered.
    """

    def __init__(self, tokens: dict[str, int], rank: Callable[[str, str], float | None], pairs: int = 500_000):
        self.rank, self.number = rank, tokens
        self.automaton = ahocorasick.Automaton()
        for token in tokens:
            self.automaton.add_word(token, token)
        self.automaton.make_automaton()
        self.letters = {t for t in tokens if len(t) == 1}
        self.made = Remember(self._made)
        self.fits = Remember(self._fits, pairs)

    def _made(self, token: str) -> tuple[str, str, float] | None:
        """The two tokens and the rank of a token's last merge; empty strings for a single sign, None if merging never makes it."""
        parts, last = list(token), ("", "", float("-inf"))
        while len(parts) > 1:  # plain merging: lowest rank first, leftmost of equals
            best = min(((r, i) for i in range(len(parts) - 1) if (r := self.rank(parts[i], parts[i + 1])) is not None), default=None)
            if best is None:
                return None
            r, i = best
            last = (parts[i], parts[i + 1], r)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return last

    def _fits(self, pair: tuple[str, str]) -> bool:
        """Whether two neighbours stay two tokens.

        The merges that made them are undone, last one first.  In each state that this passes, a merge over
        the border must not have come before the one just undone; of equal ranks the left one comes first.
        """
        left, right = pair
        own = self.made[right]
        if not left or own is None:
            return own is not None
        other, limit, tied = self.made[left], float("inf"), False
        while True:
            over = self.rank(left, right)
            if over is not None and (over < limit or tied and over == limit):
                return False
            if other[2] > own[2]:
                left, limit, tied = other[1], other[2], False
                other = self.made[left]
            elif own[0]:
                right, limit, tied = own[0], own[2], True
                own = self.made[right]
            else:
                return True

    def prefixes(self, text: str) -> tuple[list[int], list[str | None]]:
        """Token count of each prefix and its last token; an unknown sign stands alone, its token is None."""
        n, fits = len(text), self.fits
        last: list[str | None] = [""] + [None] * n
        count = [0] * (n + 1)
        known = self.letters.issuperset(text)
        for end, token in self.automaton.iter(text):
            end += 1
            if last[end] is None:
                start = end - len(token)
                if not known and last[start] is None:
                    self._bridge(count, last, start)
                if fits[last[start] or "", token]:
                    last[end] = token
                    count[end] = count[start] + 1
        if not known:
            self._bridge(count, last, n)
        return count, last

    @staticmethod
    def _bridge(count: list[int], last: list[str | None], upto: int) -> None:
        """Counts of the places before ``upto`` that no token ends at."""
        start = upto
        while start and not count[start]:
            start -= 1
        for k in range(start + 1, upto + 1):
            if last[k] is None:
                count[k] = count[k - 1] + 1


#: White space as the Unicode property has it (fixed values).
SPACE = r"\t-\r \x85\xa0  -     　"
#: The split of the byte-level vocabulary (fixed pattern).
SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
RUN = regex.compile(rf"[{SPACE}]{{2,}}(?=[^{SPACE}])")
UNSAFE = regex.compile(rf"[{SPACE}] ")


def printable_bytes() -> dict[str, int]:
    """The byte behind each printable stand-in of a byte-level vocabulary: visible Latin-1 stands for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def steps(counts: list[int]) -> bytes:
    """Differences as signed bytes; a token has far fewer than 127 characters to give back."""
    return bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])


class TextCounter:
    """Token counts of every prefix of whole texts, for a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        stand = printable_bytes()
        raw = lambda t: "".join(chr(stand[c]) for c in t)
        tokens = {raw(t): i for t, i in spec["model"]["vocab"].items() if all(c in stand for c in t)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}
        self.special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.merges = PrefixMerges(tokens, lambda a, b: rank.get((a, b)))
        self.word = Remember(self._word, 200_000)
        self.unit = Remember(self._unit, 400_000)

    def _word(self, word: str) -> list[int]:
        """Counts at each character of one split part, from the first."""
        raw = word.encode()
        count = self.merges.prefixes(raw.decode("latin-1"))[0]
        if len(raw) == len(word):
            out = count[1:]
        else:
            ends = np.cumsum([len(c.encode()) for c in word])
            out = [count[e] for e in ends]
        if len(word) == 3 and word in ("'re", "'ve", "'ll"):
            out[1] = 2  # the cut contraction is an apostrophe and a letter
        return out

    def _unit(self, piece: str) -> bytes:
        """Deltas of a blank and what follows it up to the next one."""
        word = " " + piece
        return steps([0, *self._word(word)]) if piece.isalpha() else self._deltas(word)

    def _plain(self, text: str) -> list[int]:
        """Counts at 0 and each character of a text without special strings."""
        count, word = [0], self.word
        for part in SPLIT.findall(text):
            base = count[-1]
            count += [base + x for x in word[part]]
        for run in RUN.finditer(text):  # a text that ends with the run keeps it whole; its last character goes to the next word else
            count[run.end()] = count[run.start()] + word[run.group()][-1]
        return count

    def _deltas(self, text: str) -> bytes:
        out, base = [0], 0
        while True:
            found = [(k, -len(s), s) for s in self.special if (k := text.find(s)) >= 0]
            if not found:
                break
            at, _, special = min(found)
            upto = self._plain(text[: at + len(special) - 1])
            alone = self._plain(text[:at])[-1]
            out += [base + x for x in upto[1:]] + [base + alone + 1]
            base, text = out[-1], text[at + len(special) :]
        out += [base + x for x in self._plain(text)[1:]]
        return steps(out)

    def deltas(self, text: str | None) -> bytes:
        """For each character, by how much it changes the token count; their running sum is the count at each prefix."""
        if not text:
            return b""
        parts = text.split(" ")
        if not UNSAFE.search(text):  # every blank starts a split part
            unit = self.unit
            return self._deltas(parts[0]) + b"".join([unit[p] for p in parts[1:]])
        out, held = [], parts[0]
        for part in parts[1:]:
            if held == "" or held[-1].isspace() or held[-1] == " ":
                held += " " + part
            else:
                out.append(self._deltas(held))
                held = " " + part
        return b"".join([*out, self._deltas(held)])


_counters: dict[str, TextCounter] = {}


def counter(path: str) -> TextCounter:
    if path not in _counters:
        _counters[path] = TextCounter(path)
    return _counters[path]


def prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``prefix`` of each whole text.

    ``prefix`` holds one signed byte for each character (code point): the change of the token count that
    this character makes.  The running sum at k is the exact count of the text's first k characters,
    as the library gives it for that cut text; ``tokens_at`` and ``longest_fit`` read it.  Counts can fall from one
    prefix to the next.  Strings of added tokens count as one token, as the library's default has it.
    A null text counts as empty: 0 bytes, 0 tokens.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches(stream):
            texts = batch.column("text").to_pylist()
            found = [own.deltas(x) for x in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([len(x.encode()) if x else 0 for x in texts], pa.int64()),
                pa.array([int(np.frombuffer(x, np.int8).sum(dtype=np.int64)) for x in found], pa.int64()),
                pa.array(found, pa.binary()),
            ], ["doc_id", "n_bytes", "n_tokens", "prefix"])

    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, prefix binary")


def tokens_at(prefix: Column, k: Column) -> Column:
    """Token count of the first k characters (all, if there are fewer; null for null)."""

    @F.arrow_udf(T.LongType())
    def at(prefixes: pa.Array, ks: pa.Array) -> pa.Array:
        return pa.array([
            None if p is None or n is None else int(np.frombuffer(p, np.int8)[: max(0, n)].sum(dtype=np.int64))
            for p, n in zip(prefixes.to_pylist(), ks.to_pylist(), strict=True)], pa.int64())

    return at(prefix, k)


def longest_fit(prefix: Column, budget: int) -> Column:
    """Characters of the longest prefix that has at most ``budget`` tokens."""

    @F.arrow_udf(T.LongType())
    def fit(prefixes: pa.Array) -> pa.Array:
        out = []
        for p in prefixes.to_pylist():
            if p is None:
                out.append(None)
                continue
            ok = np.flatnonzero(np.cumsum(np.frombuffer(p, np.int8), dtype=np.int64) <= budget)
            out.append(int(ok[-1]) + 1 if len(ok) else 0)
        return pa.array(out, pa.int64())

    return fit(prefix)
