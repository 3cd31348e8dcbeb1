"""Vector codes, licence scans and ranked search against brute force, on small tables."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightflux.llm import codes, licences, ranked
from nightflux.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<double>, label int, i string, of long, v int"


def brute_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1])
    width = -(-size // parts)
    whole = [[math.floor(x * scale) for x in r[1]] + [0] * (parts * width - size) if len(r[1]) == size else None for r in kept]
    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] if w else None for w in whole]
    books = [[c[p] for c in cut if c][:entries] for p in range(parts)]

    def near(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        fresh = []
        for p in range(parts):
            own = [near(c[p], p)[1] for c in cut if c]
            members = [[c[p] for c, k in zip((c for c in cut if c), own, strict=True) if k == e] for e in range(len(books[p]))]
            fresh.append([[sum(x) // len(m) for x in zip(*m, strict=True)] if m else books[p][e] for e, m in enumerate(members)])
        books = fresh
    found = [[near(c[p], p) for p in range(parts)] if c else None for c in cut]
    out = [(r[0], r[2], "".join(f"{k:02x}" for _, k in f) if f else None, sum(d for d, _ in f) if f else None) for r, f in zip(kept, found, strict=True)]
    labels = {}
    for _, label, _, error in out:
        labels[label] = (labels.get(label) or 0) + error if error is not None else labels.get(label)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((repr((*o, labels[o[1]], digest)) for o in out))


def coded(spark, rows, **more):
    df = spark.createDataFrame([(*r, "clash", 5, 6) for r in rows], VECTORS)
    return sorted(repr(tuple(r)) for r in codes.compress(df, **more).collect())


def test_vector_codes(spark):
    rng = np.random.default_rng(3)
    rows = [(k, (rng.normal(size=10) * 0.2).tolist(), int(rng.integers(3))) for k in range(90)]
    rows += [(7, rows[7][1], 1), (200, rows[3][1], None), (201, [0.0] * 10, None), (None, [1.5] * 10, 2), (202, [1.0, 2.0], 2), (203, [], 2)]
    rows += [(204, None, 1), (205, [None] * 10, 1), (206, [float("nan")] * 10, 1), (207, [float("-inf")] * 10, 1)]
    for entries, rounds in ((16, 4), (256, 2)):
        assert coded(spark, rows, entries=entries, rounds=rounds) == brute_codes(rows, entries=entries, rounds=rounds)


def test_vector_codes_of_large_components(spark):
    rng = random.Random(4)
    for power in (25, 60, 150):
        rows = [(k, [rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randrange(power) for _ in range(8)], k % 2) for k in range(30)]
        want = brute_codes(rows, entries=5)
        got = coded(spark, rows, entries=5)
        fits = [r for r in want if eval(r)[3] < 2**63 and eval(r)[4] < 2**63]
        assert [eval(r)[2::3] for r in got] == [eval(r)[2::3] for r in want]
        assert set(fits) <= set(got)


def test_vector_codes_without_rows(spark):
    assert coded(spark, []) == [] and coded(spark, [(1, None, 2), (2, [], 3)]) == []
    bare = spark.createDataFrame([(1, [0.5, 0.25, 0.0, -1.0])], "vec_id long, embedding array<float>")
    (row,) = codes.compress(bare).collect()
    assert (row.code, row.error, row.label, row.label_error) == ("00000000", 0, None, 0)
    with pytest.raises(ValueError):
        codes.compress(bare, entries=257)


def test_codes_come_back(spark):
    rows = [(k, [k / 8, -k / 8, 1.0, 2.0, 0.5], 0) for k in range(6)]
    df = spark.createDataFrame([(*r, "", 0, 0) for r in rows], VECTORS)
    books = codes.fit(df)
    back = {r.vec_id: r.embedding for r in codes.decode(codes.encode(df, books), books).collect()}
    assert back == {k: v for k, v, _ in rows}


def test_walsh_distances_and_sequency():
    rng = np.random.default_rng(5)
    for width in (1, 2, 3, 8, 13):
        a, b = rng.integers(-2000, 2000, (40, width)), rng.integers(-2000, 2000, (30, width))
        number, distance = codes.Codebook(b).nearest(a)
        whole = ((a[:, None] - b[None]) ** 2).sum(2)
        assert (number == whole.argmin(1)).all() and (distance == whole.min(1)).all()
        one = np.eye(1 << max(0, width - 1).bit_length(), dtype=np.int64)
        changes = (np.diff(np.sign(codes.walsh(one)), axis=0) != 0).sum(0)
        assert changes.tolist() == list(range(len(one)))


WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_scan(text, phrases):
    words = re.findall(WORDS, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = [(label, k) for phrase, (label, _) in phrases.items() for k in range(len(words)) if words[k : k + phrase.count(" ") + 1] == phrase.split()]
    return len(words), places


def test_licence_places(spark):
    rng = random.Random(6)
    vocabulary = sorted({w for p in (*licences.BASE, *licences.NOTICES) for w in p.split()}) + ["é", "straße", "ÀB"]
    texts = [rng.choice([" ", "-", "\n", ". "]).join(rng.choices(vocabulary, k=rng.randrange(60))) for _ in range(300)]
    phrases = list(licences.BASE) + list(licences.NOTICES)
    texts += ["".join(rng.choice(phrases).upper() + rng.choice([" ", ", ", " x ", "é"]) for _ in range(9)) for _ in range(200)]
    texts += [None, "", " ", "CC BY", "cc-by cc by", "cc cc by by", "Éall rights reserved", "all  rights\x00reserved.", "cc by " * 20000]
    rows = [(k, t, "c", 1, 2.0) for k, t in enumerate(texts)] + [(None, "all rights reserved", "c", 1, 2.0), (4, "MIT license", "c", 1, 2.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string, n_words int, score double")
    got = sorted(repr(tuple(r)[:7]) for r in licences.digest(licences.scan(df)).collect())
    want = []
    for number, text, *_ in rows:
        n, base = brute_scan(text, licences.BASE)
        _, more = brute_scan(text, licences.NOTICES)
        at = [k for _, k in base]
        want.append(repr((number, n, len(base), min(at, default=None), max(at, default=None), ",".join(sorted({x for x, _ in base})), ",".join(sorted({x for x, _ in base + more})))))
    assert got == sorted(want)
    assert licences.digest(licences.scan(df.limit(0))).count() == 0


def test_licence_scores(spark):
    texts = ["", "nothing", "MIT License", "under the GNU Lesser General Public License", "CC BY-SA", "CC BY and all rights reserved", "CC0", "GNU General Public License, version 3",
             "# SPDX-License-Identifier: MIT OR GPL-2.0-only\n", "SPDX-License-Identifier: GPL-2.0+ WITH Classpath-exception-2.0.", "SPDX license identifier is MIT", "spdx-license-identifier: (MIT AND"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r.labels, r.score) for r in licences.digest(licences.scan(df)).orderBy("doc_id").collect()]
    assert got == [("", 0.0), ("", 0.0), ("mit", 0.25), ("gpl,lgpl", 0.5), ("cc-by,cc-by-sa", 0.5), ("cc-by,reserved", 1.0), ("cc0", 0.0), ("gpl,gpl-3.0", 0.75),
                   ("gpl-2.0-only,mit", 0.25), ("gpl-2.0+", 0.5), ("", 0.0), ("unparsed", 1.0)]


def brute_weight(tokens):
    """Recursive descent beside the shunting yard."""
    def either(at):
        value, at = both(at)
        while at < len(tokens) and tokens[at] == "or":
            other, at = both(at + 1)
            value = min(value, other)
        return value, at

    def both(at):
        value, at = one(at)
        while at < len(tokens) and tokens[at] == "and":
            other, at = one(at + 1)
            value = max(value, other)
        return value, at

    def one(at):
        if tokens[at] == "(":
            value, at = either(at + 1)
            assert tokens[at] == ")"
            return value, at + 1
        assert tokens[at] not in ("and", "or", "with", ")")
        value = licences.weight_of(tokens[at])
        if tokens[at + 1 : at + 2] == ["with"]:
            assert tokens[at + 2] not in ("and", "or", "with", "(", ")")
            return (min(value, 0.5) if tokens[at + 2] in licences.EXCEPTIONS and value < 1 else value), at + 3
        return value, at + 1

    try:
        value, at = either(0)
    except (AssertionError, IndexError):
        return None
    return value if at == len(tokens) else None


def test_licence_expressions():
    kinds = ["mit", "gpl-2.0-only", "cc0-1.0", "unheard-of", "and", "or", "with", "(", ")", "llvm-exception"]
    valid = 0
    for n in range(1, 6):
        for tokens in itertools.product(kinds, repeat=n):
            found, want = licences.evaluate(list(tokens)), brute_weight(list(tokens))
            assert (found.weight if found.valid else None) == want, tokens
            valid += found.valid
    assert valid > 500
    text = b"spdx-license-identifier: ((mit or gpl-3.0) and lgpl-2.1) and then more"
    assert licences.expression_at(text, 25) == ["(", "(", "mit", "or", "gpl-3.0", ")", "and", "lgpl-2.1", ")", "and", "then"]
    assert licences.evaluate("( " * 50000 + "mit" + " )" * 50000).valid is False
    assert licences.evaluate(["("] * 50000 + ["mit"] + [")"] * 50000).weight == 0.25


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def brute_ranks(docs, items, k=20):
    split = lambda t: re.findall(TERM, re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    texts = [(d, split(t)) for d, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in texts), sum(len(t) for _, t in texts)
    df = {}
    for _, t in texts:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        found = []
        for d, t in texts:
            score = 0
            for x in split(text):
                if tf := t.count(x):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    score += w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + 25 * len(t) * n_docs // n_terms)))
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(map(repr, out))


@pytest.mark.parametrize("settings", [{}, {"TERMS": 40, "ITEMS": 5, "BUCKET": 16, "FIRST": 30, "FOCUS": 3}, {"FIRST": 1, "BUCKET": 50, "FOCUS": 1}])
def test_ranked_search(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(ranked, name, value)
    rng = random.Random(7)
    pool = [f"w{k}" for k in range(80)] + ["É", "straße", "Ab"]
    weights = [1 / (k + 1) for k in range(len(pool))]
    text = lambda n: rng.choice([" ", "_", ".\n"]).join(rng.choices(pool, weights, k=n))
    same = text(12)
    docs = [(k, text(rng.randrange(1, 60))) for k in range(250)] + [(300 + k, same) for k in range(150)]
    docs += [(500, None), (501, ""), (502, " ,"), (None, text(9)), (3, docs[3][1]), (3, text(5)), (503, text(8000)), (504, "W1 w1 w1")]
    items = [(k, text(rng.randrange(1, 25))) for k in range(20)] + [(50, same), (51, None), (52, ""), (53, "unheard"), (None, "w5 w70"), (54, "w9 " * 300), (0, "zz")]
    df = spark.createDataFrame([(*d, 1, "x", 0) for d in docs], "doc_id long, text string, n int, ids string, m int").repartition(5)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")
    kept = {}
    for i, t in items:
        kept[i] = min(filter(lambda x: x is not None, (kept.get(i), t)), default=None)
    assert sorted(repr(tuple(r)) for r in ranked.search(df, asked).collect()) == brute_ranks(docs, kept.items())


def test_ranked_search_without_rows(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.search(docs.limit(0), items).collect() == [] == ranked.search(docs, items.limit(0)).collect()
    assert ranked.search(docs.withColumn("text", F.lit(None).cast("string")), items).collect() == []
    assert [tuple(r) for r in ranked.search(docs, items).collect()] == brute_rows()


def brute_rows():
    return [eval(r) for r in brute_ranks([(1, "a b")], [(1, "a")])]


def test_registered_queries_on_odd_tables(spark, tmp_path):
    docs = [(1, "CC BY a b", "en", "s", 3), (None, None, None, None, None), (2, "", "en", "s", 0), (2, "a a", None, None, 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a"), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(k, [k / 7, 1.0, -1.0, 0.5], None if k % 2 else 1) for k in range(5)] + [(9, None, 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op11_vector_codes"](spark, str(tmp_path)).count() == 5
    assert QUERIES["op12_licences"](spark, str(tmp_path)).where("base_labels = 'cc-by'").count() == 1
    got = [tuple(r) for r in QUERIES["op13_ranked_search"](spark, str(tmp_path)).orderBy("rank").collect()]
    assert sorted(map(repr, got)) == brute_ranks([d[:2] for d in docs], [(1, "a"), (None, None)])


def test_near_duplicates_in_parts(spark, monkeypatch):
    """A large group a little below and around the limit: stars do not settle it, parts of buckets meet."""
    from nightflux.llm import minhash

    rng = random.Random(11)
    base = [f"w{k}" for k in range(90)]
    rows = []
    for k in range(150):
        text = list(base)
        for at in rng.sample(range(90), rng.choice([2, 3, 4])):
            text[at] = f"z{rng.randrange(10**6)}"
        rows.append((k, " ".join(text)))
    rows += [(1000 + k, " ".join([*base[:60], f"y{k // 3}", *base[:20], f"y{k % 3}"])) for k in range(30)]
    sets = [{tuple(t.split()[j : j + 4]) for j in range(len(t.split()) - 3)} for _, t in rows]
    low = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            old, new = max(low[i], low[j]), min(low[i], low[j])
            low = [new if x == old else x for x in low]
    want = {rows[i][0]: rows[x][0] for i, x in enumerate(low)}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for part in (512, 20):
        monkeypatch.setattr(minhash, "PART", part)
        assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df, width=4).collect()} == want
    assert 1 < len(set(want.values())) < len(rows)


def test_toxicity_walks_in_proportion_to_the_text():
    import time
    from collections import Counter

    from nightflux.llm.toxicity import EDGE, Channel, Scorer, features

    grams = Counter()
    for word in ["idiot", "stupid", "scum", "island", "the", "bitter"] * 50:
        padded = EDGE * 2 + word + EDGE
        grams.update(padded[k : k + 3] for k in range(len(word) + 1))
    scorer = Scorer(Channel(grams), {f: 5.0 for w in ("idiot", "stupid", "scum", "illness") for f in features(w)})
    scorer.start()
    for text in ("i " * 50000, "| " * 50000, "- " * 50000, "s c u " * 20000):
        start = time.perf_counter()
        scorer.measures(text)
        assert time.perf_counter() - start < 5
    assert scorer.memo["idioot"] == scorer.memo["iidiot"] == 5.0 and scorer.memo["islland"] == 0.0


def test_channel_against_every_path():
    """Viterbi decoding against all readings of short noisy words."""
    from collections import Counter

    from nightflux.llm.toxicity import EDGE, REPEATED, SEPARATED, SEPARATORS, STANDS, SUBSTITUTED, Channel

    grams = Counter()
    for word in ["aisle", "idle", "lid", "ail", "dial", "ill"] * 9 + ["add", "lad"]:
        padded = EDGE * 2 + word + EDGE
        grams.update(padded[k : k + 3] for k in range(len(word) + 1))
    channel = Channel(grams)

    def paths(word):
        found = [("", 0.0)]
        for sign in word:
            after = []
            for text, cost in found:
                state = (EDGE * 2 + text)[-2:]
                if sign in SEPARATORS:
                    after.append((text, cost + SEPARATED))
                choices = [(sign, 0.0)] if sign.isalpha() else [(c, SUBSTITUTED) for c in STANDS.get(sign, "")]
                for letter, noise in choices:
                    after.append((text + letter, cost + noise + channel._step(state, letter)))
                    if text[-1:] == letter:
                        after.append((text, cost + noise + REPEATED))
                if not choices and sign not in SEPARATORS:
                    after.append((text, cost + 2 * SUBSTITUTED))
            found = after
        return {t: min(c + channel._step((EDGE * 2 + t)[-2:], EDGE) for x, c in found if x == t) for t, _ in found}

    rng = random.Random(8)
    for _ in range(300):
        word = "".join(rng.choices("aiddl1|4.-0#", k=rng.randrange(1, 7)))
        costs = paths(word)
        assert costs[channel.restore(word)] == pytest.approx(min(costs.values()))


def test_top_k_of_large_components(spark):
    from nightflux.llm import kdtree

    rng = random.Random(12)
    rows = [(k, [rng.choice([-1.0, 1.0]) * rng.random() * 10 ** rng.randrange(0, power) for _ in range(4)]) for k, power in enumerate([2] * 40 + [8] * 40 + [12] * 10)]
    whole = {k: [math.floor(64 * x) for x in v] for k, v in rows}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in kdtree.top_k(df, df.where("vec_id % 20 = 0"), k=5, scale=64.0).collect())
    want = []
    for q in range(0, 90, 20):
        cut_off = lambda x: max(-(2**63), min(2**63 - 1, x))
        best = sorted((-cut_off(sum(a * b for a, b in zip(whole[q], whole[k], strict=True))), k) for k in whole if k != q)[:5]
        want += [(q, n, k, -s) for n, (s, k) in enumerate(best, 1)]
    assert got == want
