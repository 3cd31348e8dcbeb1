"""Toxicity: noisy-channel deobfuscation under a character language model, then a score of the restored text."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightflux.llm.common import Remember, batches, small_batches
from nightflux.session import cut

#: Letters that a sign may stand for (fixed values).
STANDS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
#: Signs that may be put between the letters of a word (fixed values).
SEPARATORS = ".-_*~^'`,:/\\ "
#: Costs in nats: a sign for a letter, a separator, a repeated letter left out.
SUBSTITUTED, SEPARATED, REPEATED = 1.0, 0.5, 1.0
#: The language model holds this many of the most frequent trigrams; any other costs what its context gives unseen letters.
GRAMS = 1 << 18
#: What a path over white space may cost: so much in all and for each letter, language model included.
SPARE, ROOM = 4.0, 7.0
EDGE = "\x02"
#: What may follow a place besides signs: a gap, and the place without paths that have no letter yet.
GAP, BEGUN = "gap", "begun"
#: Tokens whose facts, and places of the lattice that, a task remembers; both are soon found again.
MEMO, PLACES = 100_000, 60_000
#: Signs of a token that may be a part of a word's start.
SHORT = 3
OUTER = " \t\r\n.,;:!?\"'()[]{}<>«»„“”‘’…-–—_*/\\"
#: Lengths of the word starts that are features beside the whole word.
STARTS = (4, 5, 6, 7, 8)
#: Least log-odds and positive documents of a feature that counts as a sign of toxicity.
LEAST_ODDS, LEAST_SEEN = 2.0, 10
#: A sign with these log-odds counts as strong.
STRONG = 4.0


DOUBLE, TRIPLE, REPEATS = re.compile(r"(.)\1"), re.compile(r"(.)\1\1"), re.compile(r"(.)\1+")


def squeezed(word: str) -> str:
    """A word without repeated letters; every path of the channel over letters alone keeps it."""
    return REPEATS.sub(r"\1", word) if DOUBLE.search(word) else word


def bare(word: str) -> str:
    """The first three letters of a word without repeats; a path that only leaves out repeats keeps them."""
    if len(word) > 2 and word[0] != word[1] != word[2]:
        return word[:3]
    return REPEATS.sub(r"\1", word)[:3]


class Channel:
    """Viterbi decoding of one noisy word under a character trigram model."""

    def __init__(self, trigrams: dict[str, int]):
        context = Counter()
        for gram, n in trigrams.items():
            context[gram[:2]] += n
        self.letters = {g[2] for g in trigrams} - {EDGE}
        size = max(2, len(self.letters))
        self.cost = {g: -math.log((n + 0.1) / (context[g[:2]] + 0.1 * size)) for g, n in trigrams.items()}
        self.unseen = {c: -math.log(0.1 / (n + 0.1 * size)) for c, n in context.items()}
        self.unknown = math.log(size)

    def _step(self, before: str, letter: str) -> float:
        gram = before + letter
        cost = self.cost.get(gram)
        return cost if cost is not None else self.unseen.get(before, self.unknown)

    def restore(self, word: str) -> str:
        """The likeliest clean word behind a noisy one.

        The lattice has at each sign: the letter itself, the letters it may stand for, nothing if it is a
        separator, and nothing if it repeats the letter before.  Its states are the last two letters.
        """
        beam: dict[str, tuple[float, tuple | None]] = {EDGE * 2: (0.0, None)}
        for sign in word:
            after: dict[str, tuple[float, tuple | None]] = {}

            def offer(state: str, cost: float, path: tuple | None, after=after) -> None:
                known = after.get(state)
                if known is None or cost < known[0]:
                    after[state] = (cost, path)

            for state, (cost, path) in beam.items():
                if sign in SEPARATORS:
                    offer(state, cost + SEPARATED, path)
                choices = [(sign, 0.0)] if sign.isalpha() else [(c, SUBSTITUTED) for c in STANDS.get(sign, "")]
                for letter, noise in choices:
                    offer(state[1] + letter, cost + noise + self._step(state, letter), (letter, path))
                    if state[1] == letter:
                        offer(state, cost + noise + REPEATED, path)
                if not choices and sign not in SEPARATORS:
                    offer(state, cost + 2 * SUBSTITUTED, path)
            beam = after
        best = min(beam.items(), key=lambda x: (x[1][0] + self._step(x[0], EDGE), x[0]))
        out, path = [], best[1][1]
        while path:
            out.append(path[0])
            path = path[1]
        return "".join(reversed(out))


def readings(token: str, channel: Channel) -> tuple[str, ...]:
    """The words a token may be read as: itself in lower case, and what the channel restores if it looks noisy."""
    word = token.strip(OUTER).lower()
    if word.isalpha() and not TRIPLE.search(word):
        return tuple(dict.fromkeys((word, channel.restore(word)))) if DOUBLE.search(word) else (word,)
    noisy = outer_noise(token)
    # clean punctuation at the ends is no noise; ids and addresses restore to some word that no list knows
    return tuple(dict.fromkeys(x for x in (word, *map(channel.restore, dict.fromkeys((word, noisy)))) if x))


def outer_noise(token: str) -> str:
    """A token with those signs at its ends that may stand for a letter."""
    return token.strip(" \t\r\n,;:?\"'").lower()


def features(word: str) -> list[str]:
    return ["=" + word, *(word[:n] + "~" for n in STARTS if len(word) >= n)]


class Place:
    """What a path over tokens may stand for so far: beginnings of known words with their costs; places after it are found once."""

    __slots__ = "states", "met", "allowed", "after"

    def __init__(self, states: dict[str, float], scorer: Scorer):
        self.states, self.allowed = states, None
        self.met = tuple(s for s in states if s in scorer.starts)
        self.after: dict[str, Place] = {}


def _grams(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter = Counter()

    def flush() -> pa.RecordBatch:
        known = [w for w in words if w.isalpha()]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) + 2
        times = np.repeat(np.fromiter((words[w] for w in known), np.int64, len(known)), sizes)
        words.clear()
        signs = np.frombuffer((EDGE + EDGE).join(["", *known, ""]).encode("utf-32-le"), np.uint32).astype(np.int64)
        # 21 bits a sign; a gram that ends with both edges belongs to two words
        keys = signs[:-2] << 42 | signs[1:-1] << 21 | signs[2:]
        inside = (signs[1:-1] != ord(EDGE)) | (signs[2:] != ord(EDGE))
        grams = pa.table({"gram": keys[inside], "n": times[inside]}).group_by("gram", use_threads=False).aggregate([("n", "sum")])
        named = ["".join(map(chr, (g >> 42, g >> 21 & 0x1FFFFF, g & 0x1FFFFF))) for g in grams["gram"].to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(named, pa.string()), pa.array(grams["n_sum"].to_numpy(), pa.int64())], ["gram", "n"])

    for batch in batches(stream):
        for text in batch.column("text").to_pylist():
            if text:
                words.update(text.lower().split())
        if len(words) > 200_000:
            yield flush()
    yield flush()


def trigram_counts(docs: DataFrame) -> dict[str, int]:
    """Counts over the words of all texts of the GRAMS most frequent trigrams."""
    small_batches(docs.sparkSession)
    grams = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r.gram: r.n for r in grams.orderBy(F.desc("n"), "gram").limit(GRAMS).collect()}


def _counts(model: Channel):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Remember(lambda token: [f for w in readings(token, model) for f in features(w)])
        seen = Counter(), Counter()
        for batch in batches(stream):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                seen[toxic].update({f for token in set((text or "").split()) for f in memo[token]})
        names = list(seen[0] | seen[1])
        for start in range(0, len(names), 50_000):
            part = names[start : start + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), *(pa.array([s[f] for f in part], pa.int64()) for s in seen)], ["feature", "clean", "toxic"])

    return run


def _side_by_side(scorer: Scorer):
    """The divided words of labelled rows, each once a row."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer.start()
        for batch in batches(stream):
            out = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = (text or "").split()
                out += [(*x, toxic) for x in set(scorer.spaced(words, [scorer.facts[w] for w in words]))]
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.float64(), pa.int32()), strict=True)], ["joined", "word", "odds", "toxic"])
        scorer.forget()

    return run


class Scorer:
    """Finds the signs of toxicity in a text and scores it; a list of signs with their log-odds and four weights."""

    def __init__(self, channel: Channel, signs: dict[str, float]):
        self.channel, self.signs, self.weights, self.joined = channel, signs, np.zeros(4), {}
        self.whole = {f[1:]: w for f, w in signs.items() if f[0] == "="}
        self.starts = {f[:-1]: w for f, w in signs.items() if f[0] != "="}
        #: The letters that may follow each beginning of a known word.
        self.next: dict[str, set[str]] = {}
        for w in (*self.whole, *self.starts):
            for n in range(len(w)):
                self.next.setdefault(w[:n], set()).add(w[n])

    def start(self) -> None:
        known = *self.whole, *self.starts
        self.bare = {bare(w) for w in known}
        self.fours = {w[:4] for w in known}
        self.fives = {w[:5] for w in known}
        self.thin = set(map(squeezed, known))
        self.lengths = sorted(set(map(len, map(squeezed, self.starts))))
        #: Known words and their beginnings without repeats.
        self.thin_begin = self.thin | set(map(squeezed, self.next))
        self.memo = Remember(self._odds, MEMO)
        self.facts = Remember(self._facts, MEMO)
        self.alone: dict[str, frozenset[str]] = {}
        self.nothing: dict[frozenset[str] | None, tuple] = {}
        self.plain = Remember(self._plain, MEMO)
        self.pairs = {c + d for c in self.next.get("", ()) for d in (c, *self.next.get(c, ()))}
        self._clear()

    def _clear(self) -> None:
        """Lets all places go, and the facts that name some."""
        self.places, self.root, self.dead = 0, Place({"": 0.0}, self), Place({}, self)
        self.facts.forget()

    def _plain(self, beginning: str) -> tuple | None:
        """The facts of words that begin so, where no known word does."""
        start = beginning.lower()
        if not (len(start) == 3 and start.isascii() and start.isalpha() and start[0] != start[1] != start[2]) or start in self.bare:
            return None
        head = self._heads(start)
        return self._nothing(head) if head.isdisjoint(self.next.get("", ())) or start[:2] not in self.pairs else None

    def _odds(self, token: str) -> float:
        """The strongest sign that a token's readings are; most words begin like none and need no decoding."""
        word = token.strip(OUTER).lower()
        if word.isalpha() and not TRIPLE.search(word):
            if bare(word) not in self.bare:
                return 0.0
            thin = squeezed(word)
            if thin == word:
                if word[:4] not in self.fours:
                    return 0.0
            elif thin not in self.thin and not any(thin[:n] in self.thin for n in self.lengths):
                return 0.0
        elif not (self._reaches(word) or self._reaches(outer_noise(token))):
            return max((self.signs.get(f, 0.0) for f in features(word)), default=0.0)
        return max((self.signs.get(f, 0.0) for w in readings(token, self.channel) for f in features(w)), default=0.0)

    def _reaches(self, word: str) -> bool:
        """Whether any path of the channel's lattice, whatever it costs, may give a known word or start; the others need no decoding."""
        now = {""}
        for sign in word:
            letters = sign if sign.isalpha() else STANDS.get(sign, "")
            after = set(now) if sign in SEPARATORS or not letters else set()
            for s in now:
                known = self.next.get(s, ())
                after.update(s + c for c in letters if c in known)
                if s[-1:] and s[-1] in letters:
                    after.add(s)
            now = after
            if not now:
                return False
            if any(s in self.whole or s in self.starts for s in now):
                return True
        return False

    def _facts(self, token: str) -> tuple[float, Place | None, frozenset[str] | None]:
        """A token's log-odds, the place that it leads to if it has none and may begin a known word, and its heads.

        Most tokens begin no word of the list and are settled by a few looks."""
        start = token[:5].lower()
        if len(start) == 5 and start not in self.fives and start[:4] not in self.starts and start[0] != start[1] != start[2] != start[3] != start[4] and start.isalpha() and "ς" not in start:
            # whatever follows, all readings begin so, and no sign does; a sigma's small form hangs on what follows
            return self._nothing(self._heads(start))
        plain = self.plain[token[:3]]
        if plain:
            word = token.strip(OUTER).lower()
            if word.isalpha() and not TRIPLE.search(word):
                return plain
        odds, heads = self._odds(token), self._heads(token)
        pair = token[:2].lower()
        if odds:
            return odds, None, heads
        if heads is not None and heads.isdisjoint(self.next.get("", ())) or pair.isalpha() and len(pair) == 2 and pair not in self.pairs:
            return self._nothing(heads)
        if token[0].isalpha():  # then what follows the letters only ends paths or adds to them
            word = token.rstrip(OUTER).lower()
            if word.isalpha() and squeezed(word) not in self.thin_begin:
                return self._nothing(heads)
        place = self._walk(self.root, token, set())
        if "" in place.states:  # signs that may be left out begin no word
            place = place.after.get(BEGUN) or self._keep(place, BEGUN, {s: c for s, c in place.states.items() if s})
        if not place.states:
            return self._nothing(heads)
        self._open(place)
        return 0.0, place, heads

    def _nothing(self, heads: frozenset[str] | None) -> tuple:
        """The facts of a token that is no sign and begins none; one tuple for all with such heads."""
        return self.nothing.get(heads) or self.nothing.setdefault(heads, (0.0, None, heads))

    def _open(self, place: Place) -> frozenset[str]:
        """The letters that a token after this place may begin with."""
        if place.allowed is None:
            place.allowed = frozenset().union(*(self.next.get(s, ()) for s in place.states), (s[-1] for s in place.states))
        return place.allowed

    def forget(self) -> None:
        for memo in (self.memo, self.plain):
            memo.forget()
        self._clear()

    def _heads(self, token: str) -> frozenset[str] | None:
        """The letters that a token's first letter may be; None if it may be left out as a whole."""
        first = token[:1].lower()
        if first.isalpha() and len(first) == 1:
            return self.alone.get(first) or self.alone.setdefault(first, frozenset(first))
        found: set[str] = set()
        for sign in token.lower():
            letters = sign if sign.isalpha() else STANDS.get(sign, "")
            found.update(letters)
            if not (sign in SEPARATORS or sign in OUTER or not (letters or sign.isalnum())):
                return frozenset(found)
        return None

    def _step(self, place: Place, sign: str) -> Place:
        """The place after one more sign.

        The lattice and the costs are the channel's and its language model's, with outer punctuation left out too.  A path that
        begins no known word ends, and so does one that costs more than SPARE and ROOM a letter, so a run of equal tokens ends soon.
        """
        letters = [(sign, 0.0)] if sign.isalpha() else [(c, SUBSTITUTED) for c in STANDS.get(sign, "")]
        skipped = sign in SEPARATORS or sign in OUTER or not (letters or sign.isalnum())
        after: dict[str, float] = {}

        def offer(state: str, cost: float) -> None:
            if cost <= SPARE + ROOM * len(state) and cost < after.get(state, math.inf):
                after[state] = cost

        for s, cost in place.states.items():
            if skipped:
                offer(s, cost + SEPARATED)
            for letter, noise in letters:
                if letter in self.next.get(s, ()):
                    offer(s + letter, cost + noise + self.channel._step((EDGE + EDGE + s)[-2:], letter))
                if s[-1:] == letter:
                    offer(s, cost + noise + REPEATED)
        return self._keep(place, sign, after)

    def _keep(self, place: Place, sign: str, states: dict[str, float]) -> Place:
        """The place with these states, remembered after ``place`` until PLACES are."""
        if self.places >= PLACES:
            self._clear()
        self.places += 1
        place.after[sign] = new = Place(states, self) if states else self.dead
        return new

    def _walk(self, place: Place, token: str, met: set[str]) -> Place:
        """The place that ``token`` leads to; the known starts that it meets on the way are added to ``met``."""
        for sign in token.lower():
            place = place.after.get(sign) or self._step(place, sign)
            if not place.states:
                break
            if place.met:
                met.update(place.met)
        return place

    def spaced(self, words: list[str], facts: list[tuple]) -> Iterator[tuple[str, str, float]]:
        """Known words that white space divides: the tokens, the word, its log-odds.

        Each begins and ends with a token and holds letters of two at least.  A whole word may be divided anyhow; a word's
        start counts in short tokens only, for an ordinary word after another one easily gives a start.  Tokens that the labelled rows hold side
        by side (two ordinary words) have log-odds of their own.  A gap costs a separator, so the tokens that a path takes in are
        bounded by its letters and a text takes time in proportion to its length.
        """
        end = 0
        # most second tokens begin with no letter that could follow
        for k in [k for k, (f, g) in enumerate(zip(facts, facts[1:], strict=False)) if f[1] and (g[2] is None or not g[2].isdisjoint(f[1].allowed))]:
            place = facts[k][1]
            if k < end:
                continue
            best, end, at = None, k + 1, k
            while place.states and (at := at + 1) < len(words):
                head = facts[at][2]
                if head is not None and head.isdisjoint(self._open(place)):
                    break
                before, met = place.states.keys(), set()
                place = place.after.get(GAP) or self._keep(place, GAP, {s: c + SEPARATED for s, c in place.states.items()})
                place = self._walk(place, words[at], met)
                here = place.states.keys()
                for s in (here | met) - before:
                    if s not in self.starts and s not in self.whole:
                        continue
                    parts = [w.strip(OUTER).lower() for w in words[k : at + 1]]
                    x = max(self.whole.get(s, 0.0) if s in here else 0.0, self.starts.get(s, 0.0) if max(map(len, parts)) <= SHORT else 0.0)
                    if not x:
                        continue
                    joined = " ".join(parts)
                    x = self.joined.get((joined, s), x)
                    if x >= LEAST_ODDS and (best is None or (x, s) > best[:2]):
                        best, end = (x, s, joined), at + 1
            if best:
                yield best[2], best[1], best[0]

    def measures(self, text: str | None) -> list[float]:
        """1, the logarithm of the distinct signs' summed excess, the strongest sign, the logarithm of strong signs per 100 words."""
        words = text.split() if text else []
        facts = list(map(self.facts.__getitem__, words))
        signs = [(k, f[0]) for k, f in enumerate(facts) if f[0]]
        found = {words[k].strip(OUTER).lower(): x for k, x in signs}
        strong = sum(x >= STRONG for _, x in signs)
        for _, w, x in self.spaced(words, facts) if self.signs else ():
            found[w] = x
            strong += x >= STRONG
        excess = sum(x - LEAST_ODDS for x in found.values())
        return [1.0, math.log1p(excess), max(found.values(), default=0.0), math.log1p(100 * strong / max(1, len(words)))]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 4000) -> Scorer:
    """A scorer from labelled rows (``doc_id``, ``toxic``); at most ``sample`` rows of each class are learnt from.

    The character counts come from all of ``docs``.  The sample takes the rows with the smallest hash of their id, so
    it does not depend on partitions.  Rows whose label is not 0 or 1 or whose text is null teach nothing.
    Without rows of both classes every score is that of a text without signs: 0.
    """
    channel = Channel(trigram_counts(docs))
    labels = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = {r.toxic: r.n for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return Scorer(channel, {})
    chosen = [labels.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    chosen = cut(chosen[0].union(chosen[1]))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    rows = cut(texts.join(chosen, "doc_id").select("doc_id", "text", "toxic"))
    n = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return Scorer(channel, {})
    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (n[0] + 1.0))
    found = rows.repartition("doc_id").select("text", "toxic").mapInArrow(_counts(channel), "feature string, clean long, toxic long")
    found = found.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    least = min(LEAST_SEEN, max(2, n[1] // 20))
    found = found.withColumn("odds", odds).where((F.col("toxic") >= least) & (F.col("odds") >= LEAST_ODDS))
    signs = {r.feature: r.odds for r in found.select("feature", "odds").collect()}  # fewer than the sample's words
    scorer = Scorer(channel, signs)
    side = rows.select("text", "toxic").mapInArrow(_side_by_side(scorer), "joined string, word string, odds double, toxic int")
    for r in side.groupBy("joined", "word", "odds").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).collect():  # few
        # the word's own log-odds count as half a clean document
        scorer.joined[r.joined, r.word] = math.log((r.toxic / (n[1] + 1.0) + 0.5 * math.exp(r.odds) / (n[0] + 1.0)) / ((r.n - r.toxic + 0.5) / (n[0] + 1.0)))
    rows = measured(rows, scorer).select("toxic", "measures").collect()  # at most 2 * sample rows of a few numbers
    x, y = np.array([r.measures for r in rows]), np.array([float(r.toxic) for r in rows])
    share = np.where(y == 1, total[1] / (y == 1).sum(), total[0] / (y == 0).sum())
    share *= len(y) / share.sum()
    for _ in range(25):  # Newton steps of a ridge logistic regression, classes weighted as in all labels
        p = scorer.score(x)
        slope = x.T @ (share * (p - y)) + 0.1 * scorer.weights
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        scorer.weights = scorer.weights - np.linalg.solve(bend, slope)
    return scorer


def measured(rows: DataFrame, scorer: Scorer) -> DataFrame:
    """Adds ``measures`` to rows with ``text``."""
    small_batches(rows.sparkSession)
    names = rows.columns

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer.start()
        for batch in batches(stream):
            found = [scorer.measures(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, pa.list_(pa.float64()))], [*names, "measures"])
        scorer.forget()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, measures array<double>")


def score(docs: DataFrame, scorer: Scorer, keep: bool = False) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every whole text, with ``keep`` all columns and ``score``.

    A null or empty text has no signs and the lowest score.
    """
    small_batches(docs.sparkSession)
    names = docs.columns if keep else ["doc_id"]
    kept = docs.select(*names)
    # a text that is kept anyway is sent to the workers once
    text = "text" if [f.dataType.simpleString() for f in kept.schema.fields if f.name == "text"] == ["string"] else "_text"

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer.start()
        for batch in batches(stream):
            x = np.array([scorer.measures(t) for t in batch.column(text).to_pylist()]).reshape(-1, 4)
            out = scorer.score(x) if scorer.signs else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out)], [*names, "score"])
        scorer.forget()

    docs = kept if text == "text" else docs.select(*names, F.col("text").cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return docs.mapInArrow(run, f"{schema}, score double")
