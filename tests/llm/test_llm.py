"""The training-data operators against brute force, the libraries and exact round trips, on small tables."""

import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nightflux.llm import chat, kdtree, packing, pivots, warc
from nightflux.llm.bpe import TextCounter, longest_fit, prefix_counts, tokens_at
from nightflux.llm.graph import components
from nightflux.llm.minhash import near_duplicates
from nightflux.llm.mixing import blocks, exponent, mix
from nightflux.llm.pieces import Pieces, UnigramPieces, decode, encode
from nightflux.llm.queries import word_ids
from nightflux.llm.toxicity import Channel, fit, score
from nightflux.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, node int"
ODD = ["", " ", "  ", "a", " a  b ", "a\n\nb", "don't we'll 'r 're", "a<|endoftext|>b  <|endoftext|>", "日本 🎉 é", "x" * 3000, "trail  ", "!!!! ??", "<s> <0x0A>"]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, "clash", 7) for i, t, s in rows], DOCS)


def words(rng, n, pool=60):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {x: x for e in edges for x in e if x is not None}
    for _ in range(100):
        for a, b in edges:
            if a is not None:
                low[a] = low[b] = min(low[a], low[b])
    assert got == {k: v for k, v in low.items() if k in got}


def brute_classes(rows, width, percent):
    sets = []
    for _, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    group = list(range(len(rows)))
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    low = {}
    for (i, *_), g in zip(rows, group):
        low[g] = min(low.get(g, i), i)
    return {i: (len(s), low[g]) for (i, *_), s, g in zip(rows, sets, group)}


def test_near_duplicates(spark):
    rng = random.Random(2)
    rows, n = [], 0
    for _ in range(12):
        base = words(rng, rng.choice([3, 5, 9, 40, 150]), 500).split()
        for _ in range(rng.randrange(1, 8)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(999)}"
            base = copy if rng.random() < 0.5 else base  # chains
            rows.append((n, " ".join(copy), "s"))
            n += 1
    rows += [(n, "", "s"), (n + 1, None, "s"), (n + 2, " \t", "s"), (n + 3, "One two", "s"), (n + 4, "one  TWO", "s")]
    want = brute_classes(rows, 4, 80)
    got = near_duplicates(docs(spark, rows), width=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_hot_and_odd(spark):
    rows = [(k, "one and the same text for all of them", "s") for k in range(300)] + [(7, "one and the same text for all of them", "s"), (None, "one and the same text for all of them", "s"), (None, "another text that has no id at all", "s")]
    got = near_duplicates(docs(spark, rows)).collect()
    assert len(got) == 303 and sum(r.kept for r in got) == 2
    assert near_duplicates(docs(spark, [])).collect() == []


def test_toxicity(spark):
    rng = random.Random(3)
    bad = ["idiot", "stupid", "moron"]
    rows, labels = [], []
    for k in range(240):
        text = words(rng, 40).replace("w", "wo")
        if k % 4 == 0:
            text += " you " + rng.choice(bad) + " and " + rng.choice(bad) + " so " + rng.choice(bad)
        rows.append((k, text, "s"))
        labels.append((k, int(k % 4 == 0)))
    extra = [(1000, words(rng, 30) + " st4pid 1d10t m0ron m.o.r.o.n", "s"), (1001, words(rng, 30) + " i d i o t  s t u p i d  m o r o n", "s"), (1002, "", "s"), (1003, None, "s"), (1004, "a" * 5000, "s")]
    table = docs(spark, rows + extra)
    scorer = fit(table, spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in score(table, scorer).collect()}
    assert all((got[k] >= 0.5) == bool(y) for k, y in labels)
    assert got[1000] >= 0.5 and got[1001] >= 0.5 and max(got[1002], got[1003], got[1004]) < 0.5
    none = fit(table, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in score(table, none).collect()} == {0.0}
    assert score(docs(spark, []), scorer).count() == 0


def test_toxicity_of_spaced_words(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(240):
        text = words(rng, 40).replace("w", "wo")
        rows.append((k, text + (f" you {rng.choice(['idiot', 'scum'])} and so on" if k % 4 == 0 else ""), "s"))
        labels.append((k, int(k % 4 == 0)))
    told = ["i d i o t.", "(i d i o t)", "i  d  i  o  t", "i\td\ti\to\tt", "i\nd\ni\no\nt", "id iot", "s c u m", "sc um!", "1 d 1 0 t", "i - d - i - o - t", "i. d. i. o. t.", "i d i o t s", "! d ! o t", "\u00a0s\u00a0c\u00a0u\u00a0m"]
    plain = ["is cum", "i d", "s c u", "a b c d e f", "1 2 3 4 5 6", "i did not"]
    rows += [(1000 + k, f"{words(rng, 15)} {t} {words(rng, 15)}", "s") for k, t in enumerate(told + plain)]
    table = docs(spark, rows)
    scorer = fit(table, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.score >= 0.5 for r in score(table, scorer).collect()}
    assert [t for k, t in enumerate(told + plain) if got[1000 + k]] == told


def test_channel_restores():
    model = Channel({"\x02\x02i": 50, "\x02id": 50, "idi": 50, "dio": 50, "iot": 50, "ot\x02": 50})
    assert model.restore("1d10t") == model.restore("i.d.i.o.t") == model.restore("iiidiooot") == "idiot"
    assert model.restore("") == ""


def test_exponent_and_budget(spark):
    totals = spark.createDataFrame([("a", 1000), ("b", 100), (None, 10), ("e", 0)], "source string, tokens long")
    a = exponent(totals, max_repeats=3.0)
    assert a == pytest.approx(1 - np.log(3) / np.log(100), abs=1e-8)
    share = np.array([1000, 100, 10]) / 1110
    h = exponent(totals, entropy=0.6)
    q = share**h / (share**h).sum()
    assert -(q * np.log(q)).sum() == pytest.approx(0.6, abs=1e-6)
    assert exponent(totals.where("false"), max_repeats=2.0) == 1.0


def test_mixing_against_a_plain_walk(spark):
    rng = random.Random(4)
    rows = [(k, words(rng, rng.randrange(1, 30)), "hot" if k % 3 else f"s{k % 5}") for k in range(200)] + [(900, None, None), (901, "one two", None), (902, "", "empty")]
    got, quota = blocks(docs(spark, rows), 2.0, None, None, 1)
    got = got.collect()
    size = {i: len((t or "").split()) for i, t, _ in rows}
    for q in quota.collect():
        own = [i for i, _, s in rows if s == q.source]
        for block in range(q.whole + 1):
            order = sorted(own, key=lambda i: hashlib.md5(f"1:{block}:{i}".encode()).hexdigest())
            want, used = [], 0
            for i in order:
                used += size[i]
                if block < q.whole or (q.rest and used <= q.rest):
                    want.append(i)
                elif block == q.whole:
                    break
            assert sorted(r.doc_id for r in got if r.source == q.source and r.block == block) == sorted(want)
    assert mix(docs(spark, []), max_repeats=2.0).count() == 0


def brute_links(rows, least):
    x = {}
    for i, v in rows:
        if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and np.any(v):
            x[i] = np.array(v, float) / np.linalg.norm(v)
    links = {i: 0 for i, _ in rows}
    low = {i: i for i, _ in rows}
    pairs = [(a, b) for a, b in combinations(sorted(x), 2) if len(x[a]) == len(x[b]) and x[a] @ x[b] >= least]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    for _ in rows:
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    return links, low


def test_near_vectors(spark):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(60):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 6))):
            rows.append((len(rows), (base + rng.normal(size=16) * 0.12).tolist()))
    rows += [(500 + k, rows[0][1]) for k in range(40)] + [(600, None), (601, [0.0] * 16), (602, [float("nan")] * 16), (603, [None] * 16), (604, [1.0, 2.0]), (605, [])]
    links, low = brute_links(rows, 0.9)
    got = pivots.near_vectors(spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, node string")).collect()
    found = sum(r.n_links for r in got)
    assert found >= 0.98 * sum(links.values()) and all(r.n_links <= links[r.vec_id] for r in got)
    assert sum(r.component_id == low[r.vec_id] for r in got) >= 0.98 * len(rows) and len(got) == len(rows)
    assert pivots.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("cosine", [0.93, 0.8])
def test_near_vectors_of_a_hot_third(spark, cosine):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:1000] = np.sqrt(1 - cosine) * x[:1000] + np.sqrt(cosine) * x[2999]
    x[1000:1100] = x[1100:1200] + rng.normal(size=(100, 64)) * 0.04
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.9).sum(1) - 1
    got = {r.vec_id: r for r in pivots.near_vectors(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")).collect()}
    found = np.array([got[k].n_links for k in range(3000)])
    assert (found <= want).all() and found[:1000].sum() >= 0.999 * want[:1000].sum() and found[1000:].sum() >= 0.98 * want[1000:].sum()
    if cosine > 0.9:
        assert {got[k].component_id for k in range(1000)} == {0}


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(k, rng.normal(size=8).round(2).tolist()) for k in range(700)] + [(700 + k, [0.5] * 8) for k in range(60)]
    rows += [(None, [1.0] * 8), (2000, None), (2001, [float("inf")] * 8), (2020, [1.0, 2.0]), (2040, [2.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = kdtree.top_k(table, table.where("vec_id % 20 = 0")).collect()
    usable = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in rows if i is not None and v is not None and np.isfinite(v).all()]
    for q, p in usable:
        if q % 20 == 0:
            want = sorted((-int(p @ x), i) for i, x in usable if i != q and len(x) == len(p))[:20]
            assert sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q) == [(k + 1, i, -s) for k, (s, i) in enumerate(want)]


def test_tree_prunes_and_stays_exact():
    rng = np.random.default_rng(7)
    points = rng.integers(-50, 50, (3000, 3))
    tree = kdtree.Tree(np.arange(3000), points)
    for q, ids, scores in tree.search(rng.integers(-9, 9, (20, 3)), [-1] * 20, 5, [None] * 20):
        assert len(ids) == 5 and scores == sorted(scores, reverse=True)


@pytest.mark.parametrize("seed", range(3))
def test_words_round_trip(seed):
    rng = np.random.default_rng(seed)
    for n in (0, 1, 3, 240, 4096, 4097, 20_000):
        bits = rng.choice([0, 1, 7, 16, 30, 31, 59, 61, 64], n)
        ids = np.array([int(rng.integers(1, 2**62)) * 4 + 3 >> (64 - int(b)) if b else 0 for b in bits], np.uint64)
        for x in (ids, np.zeros(n, np.uint64), np.minimum(ids, np.uint64(49407))):
            words_, offsets = packing.encode(x)
            assert (packing.decode(words_, offsets, n) == x).all()


def test_id_files(spark):
    rows = [(k, t, "s") for k, t in zip([5, 3, None, 9, 1, 1, *range(20, 60)], [*ODD, *ODD, *ODD, *ODD])]
    folder = scratch_path(spark, "ids")
    manifest = packing.write(docs(spark, rows), folder, word_ids, docs_a_file=7)
    got = packing.checksums(manifest, folder).collect()
    whole = {(r.doc_id, r.start): r.ids for r in packing.read(manifest, folder).collect()}
    assert whole.keys() == {(r.doc_id, r.start) for r in got}
    assert all(r.ids_crc32 == zlib.crc32(np.array(whole[r.doc_id, r.start], "<u4").tobytes()) for r in got)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [] for i, *_ in rows}
    for i, t, _ in rows:
        ids[i].append([*library.encode(t or "", add_special_tokens=False).ids, 1])
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted((len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for v in ids.values() for x in v)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    known = [r.doc_id for r in sorted(got, key=lambda r: r.start) if r.doc_id is not None]
    assert known == sorted(known)


def test_prefix_counts_are_the_library_s(spark):
    own, library = TextCounter(public_tokenizers.path("byte_bpe_50k.json")), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(8)
    texts = ODD + ["".join(rng.choice(" '\n\tasdlremvteé<|>-_!0日🎉") for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    for t in texts:
        want = [len(x.ids) for x in library.encode_batch([t[: k + 1] for k in range(min(len(t), 50))], add_special_tokens=False)]
        assert np.frombuffer(own.deltas(t), np.int8).cumsum()[:50].tolist() == want, t
    table = prefix_counts(docs(spark, [(1, "one two three", "s"), (2, None, "s")]), public_tokenizers.path("byte_bpe_50k.json"))
    got = {r[0]: tuple(r)[1:] for r in table.select("doc_id", "n_bytes", "n_tokens", tokens_at(F.col("prefix"), F.lit(7)), longest_fit(F.col("prefix"), 2)).collect()}
    assert got == {1: (13, 3, 2, 7), 2: (0, 0, 0, 0)}


def test_pieces_are_the_library_s(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    own, library = Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(9)
    texts = ODD + ["".join(rng.choice(" \n\tasdlremvteé<>-0日🎉▁") for _ in range(rng.randrange(1, 40))) for _ in range(500)]
    for t in texts:
        assert own.encode(t).tolist() == library.encode(t), t
        assert "▁" in t or own.decode(own.encode(t)) == t
    back = decode(encode(docs(spark, [(k, t, "s") for k, t in enumerate([*ODD, None])]), path), path).collect()
    assert {r.doc_id: r.text for r in back} == dict(enumerate([*ODD, ""]))


def test_unigram_search_is_the_best():
    rng = random.Random(10)
    scores = {p: (k, -rng.random() * 5) for k, p in enumerate(["a", "b", "ab", "ba", "aab", "bb", "abab"])}
    own = UnigramPieces(scores)

    def best(t):
        return max([scores[p][1] + best(t[len(p) :]) for p in scores if t.startswith(p)] + ([own.unknown + best(t[1:])] if t[0] not in "ab" else [])) if t else 0.0

    for _ in range(60):
        t = "".join(rng.choice("aabbc") for _ in range(rng.randrange(1, 9)))
        value = {k: s for k, s in scores.values()}
        assert sum(value.get(k, own.unknown) for _, k in own.segments(t)) == pytest.approx(best(t))


def test_warc(spark):
    long = "<p>" + "é" * 200
    rows = [(3, "http://a", long), (1, None, long), (2, "u", "short"), (4, "u", "short"), (5, "u v\n", None), (6, "u", "a\r\n\r\nWARC/1.1\r\n" * 9), (None, "u", long)]
    raw, done = scratch_path(spark, "w"), scratch_path(spark, "w")
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    got = {r.page_id: r for r in warc.read(warc.normalise(warc.write_monolithic(warc.with_revisits(pages), raw), raw, done), done).collect()}
    for i, _, html in rows:
        data = (html or "").encode()
        again = html == long and i != 1
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == (len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 1 if again else None)
        assert again or got[i].payload == data


@pytest.mark.parametrize("role,text", [("user", "\\### Assistant: </turn> ok"), ("assistant", ""), ("a: b", ": \\"), ("User", "x"), ("=", "y"), ("İ", "z"), ("", "</turn>\n### "), ("tool\\", ":\n")])
def test_template_is_reversible(role, text):
    turn, start, end = chat.render(role, text)
    assert chat.parse(turn) == (role, text) and chat.unescape(turn[start:end]) == (text if role == "assistant" else "")
    assert turn.count(" </turn>") == 1


def test_chat_folds(spark):
    log = [(1, 0, "start", "user", None), (1, 1, "delta", None, "he"), (1, 2, "delta", None, "y"), (1, 3, "start", "assistant", None), (1, 4, "delta", None, "bad"), (1, 5, "regenerate", None, None),
           (1, 6, "delta", None, "go"), (1, 7, "edit", None, "good"), (1, 8, "delta", None, "!"), (2, 0, "delta", None, "lost"), (2, 1, "start", None, None), (None, 0, "start", "user", "x"), (3, 1, "what", None, None)]
    turns = chat.formatted(spark.createDataFrame([(*r, 1) for r in log], "conv_id long, seq int, kind string, role string, text string, place int"), ["seq"])
    got = {(r.conv_id, r.place): chat.parse(r.turn) for r in turns.collect()}
    assert got == {(1, 0): ("user", "hey"), (1, 1): ("assistant", "good!"), (2, 0): ("", ""), (None, 0): ("user", "")}
    row = next(r for r in chat.digests(turns).collect() if r.conv_id == 1)
    assert (row.n_turns, row.loss_chars) == (2, 5) and row.turns_sha256 == hashlib.sha256(b"user\nhey\nassistant\ngood!\n").hexdigest()
