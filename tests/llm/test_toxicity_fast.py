"""Fast paths of the toxicity operator against the plain ones."""

import random
from collections import Counter

import pyarrow as pa

from nightflux.llm import toxicity as T

TEXTS = [None, "", "a", "The cat sat, the CAT ran: aab abb Übermaß 𝔸𝔹 x1 it's a\x02b idiot iiidiot", "a a a bb \x02 the"] * 3


def test_gram_counts_equal_a_plain_walk():
    want = Counter()
    for text in TEXTS:
        for word in (text or "").lower().split():
            if word.isalpha():
                padded = T.EDGE * 2 + word + T.EDGE
                want.update(padded[k : k + 3] for k in range(len(word) + 1))
    stream = pa.table({"text": pa.array(TEXTS, pa.string())}).to_batches(max_chunksize=4)
    got = Counter()
    for batch in T._grams(iter(stream)):
        got.update(dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)))
    assert got == want


def test_plain_words_are_settled_by_their_beginning(monkeypatch):
    counts = Counter()
    for w in ("idiot", "scum", "cat", "dog", "house", "moron") * 5:
        counts.update((T.EDGE * 2 + w + T.EDGE)[k : k + 3] for k in range(len(w) + 1))
    scorer = T.Scorer(T.Channel(counts), {"=idiot": 5.0, "=scum": 4.0, "moro~": 3.0, "=aab": 2.5})
    scorer.start()
    rng = random.Random(5)
    tokens = ["house", "House,", "hhouse", "Moooron", "idiot.", "i.d.i.o.t", "1diot", "abcc", "aAa", "xyz-w", "(cat)", "ÉTÉS", "scuM!", "ab", "AAb"]
    tokens += ["".join(rng.choice("abcdhimnorstuIM0.,-'é") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    walked = Counter()
    odds = T.Scorer._odds
    monkeypatch.setattr(T.Scorer, "_odds", lambda self, t: (walked.update([t]), odds(self, t))[1])
    fast = [scorer._facts(t) for t in tokens]
    settled = [t for t in tokens if not walked[t]]
    assert "house" in settled and "House," in settled and "idiot." not in settled
    scorer.plain = dict.fromkeys({t[:3] for t in tokens})
    assert fast == [scorer._facts(t) for t in tokens] and any(x[0] for x in fast)


SIGNS = {"=idiot": 5.0, "=scum": 4.0, "moro~": 3.0, "=aab": 2.5, "=scumbag": 6.0, "idioti~": 4.5, "=ümlaut": 3.5, "=oddσ": 2.5}


def small_scorer() -> T.Scorer:
    counts = Counter()
    for w in ("idiot", "scum", "cat", "dog", "house", "moron", "ümlaut") * 5:
        counts.update((T.EDGE * 2 + w + T.EDGE)[k : k + 3] for k in range(len(w) + 1))
    scorer = T.Scorer(T.Channel(counts), SIGNS)
    scorer.start()
    return scorer


def noisy_tokens() -> list[str]:
    rng = random.Random(7)
    known = [f.strip("=~") for f in SIGNS]
    tokens = ["idioting", "idiolect", "scumble,", "(idiot)", "moroccan", "iddiots", "ΟΔΔΣ", "ODDΣ", "oddΣa", "!!!", "i", "id", "scu-", "mooorooon", "!diot"]
    tokens += ["".join(rng.choice("abcdiomnrstuüIM0!(.,-'") for _ in range(rng.randint(1, 9))) for _ in range(1500)]
    for _ in range(1500):
        word = list(rng.choice(known))
        for _ in range(rng.randint(0, 3)):
            word.insert(rng.randint(0, len(word)), rng.choice("iot.-0!sx("))
        tokens.append("".join(word))
    return tokens


def plain_walk(scorer: T.Scorer, token: str) -> dict[str, float]:
    now = {"": 0.0}
    for sign in token.lower():
        letters = [(sign, 0.0)] if sign.isalpha() else [(c, T.SUBSTITUTED) for c in T.STANDS.get(sign, "")]
        paths = []
        for s, cost in now.items():
            if sign in T.SEPARATORS or sign in T.OUTER or not (letters or sign.isalnum()):
                paths.append((s, cost + T.SEPARATED))
            for letter, noise in letters:
                if letter in scorer.next.get(s, ()):
                    paths.append((s + letter, cost + noise + scorer.channel._step((T.EDGE * 2 + s)[-2:], letter)))
                if s[-1:] == letter:
                    paths.append((s, cost + noise + T.REPEATED))
        now = {}
        for s, cost in paths:
            if cost <= T.SPARE + T.ROOM * len(s):
                now[s] = min(cost, now.get(s, cost))
    return {s: c for s, c in now.items() if s}


def test_facts_equal_all_readings_and_a_plain_walk():
    scorer, some = small_scorer(), Counter()
    for token in noisy_tokens():
        odds, place, heads = scorer.facts[token]
        assert odds == max((SIGNS.get(f, 0.0) for w in T.readings(token, scorer.channel) for f in T.features(w)), default=0.0), token
        states = place.states if place else {}
        some.update(["odds"] * bool(odds) + ["place"] * bool(states))
        if not odds and (heads is None or heads & scorer.next[""]) and not (token[:2].isalpha() and len(token) > 1 and token[:2].lower() not in scorer.pairs):
            assert states == plain_walk(scorer, token), token
    assert some["odds"] > 50 and some["place"] > 50


def test_words_that_share_only_a_beginning_with_a_sign_need_no_decoding(monkeypatch):
    scorer, called = small_scorer(), []
    odds = T.Scorer._odds
    monkeypatch.setattr(T.Scorer, "_odds", lambda self, t: (called.append(t), odds(self, t))[1])
    assert [scorer.facts[w][0] for w in ("idiom", "idiolect", "sculptor", "scuba-diving", "morale***", "idiot")] == [0.0] * 5 + [5.0]
    assert called == ["idiot"]


def test_what_a_task_remembers_is_small(monkeypatch):
    scorer = small_scorer()
    for k in range(220_000):
        scorer.facts[f"house{k}"]
    assert len(scorer.facts) + len(scorer.facts.old) <= 200_000
    tokens = noisy_tokens()
    texts = [" ".join(tokens[k : k + 40]) for k in range(0, len(tokens), 40)] + ["i d i o t s c u m", "id iot scum bag, s  c  u  m"]
    wide = [small_scorer().measures(x) for x in texts]
    monkeypatch.setattr(T, "PLACES", 40)
    narrow = small_scorer()
    assert [narrow.measures(x) for x in texts] == wide
    assert narrow.places <= 41
