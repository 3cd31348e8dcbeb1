"""The registered queries: each applies its operator to its whole table and derives the contract's columns."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightflux.llm import chat, codes, kdtree, licences, packing, pivots, ranked, twins, warc
from nightflux.llm.bpe import longest_fit, prefix_counts
from nightflux.llm.common import Remember, held_out, load
from nightflux.llm.minhash import near_duplicates
from nightflux.llm.mixing import mix, word_count
from nightflux.llm.pieces import decode, encode
from nightflux.llm.toxicity import fit, score
from nightflux.session import cut, scratch_path

#: No source is read more often than this by the mixture; tokens of a training window.
MAX_REPEATS, LIMIT = 2.0, 512

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = dict(twins.SQL)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"), width=4)


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    scorer = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, scorer).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix(load(spark, sf_dir, "documents"), max_repeats=MAX_REPEATS)
    return rows.select("doc_id", "source", word_count(F.col("text")).alias("n_words"), "block", "order_key")


@query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = load(spark, sf_dir, "documents")
    back = decode(encode(docs, path), path)
    return back.select("doc_id", "n_pieces", "ids", F.length("text").cast("long").alias("n_chars_back"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query
def op9_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prefix_counts(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), longest_fit(F.col("prefix"), LIMIT).alias("chars_within_limit"))


@query
def op4_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(load(spark, sf_dir, "embeddings"), least=0.9)


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, done = scratch_path(spark, "warc-whole"), scratch_path(spark, "warc-members")
    whole = warc.write_monolithic(warc.with_revisits(load(spark, sf_dir, "pages")), raw)
    return warc.read(warc.normalise(whole, raw, done), done).drop("payload")


@query
def op7_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings")
    return kdtree.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20, scale=64.0)


@query
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    log = chat.events_of(given.unionByName(more))
    turns = cut(chat.formatted(log, ["turn", "role", "key", "row", "step"]))
    return chat.digests(turns)


class WordIds:
    """Ids of whole texts from the library, with an end id; white space splits words, so a word's ids are remembered.

    Only the distinct words of a batch are looked up, and those it brings anew go to the library together.
    """

    #: Letters below U+0130, then perhaps a comma or full stop.
    PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+[,.]?").fullmatch

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.end = Tokenizer.from_file(path), np.uint16(end)
        self.word = Remember(lambda w: self._ids([w])[0], 500_000)
        self.last = np.zeros(self.library.get_vocab_size(), bool)
        self.last[[i for t, i in self.library.get_vocab().items() if t.endswith("</w>")]] = True

    def _ids(self, words: list[str]) -> list[bytes]:
        return [np.array(x.ids, np.uint16).tobytes() for x in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Remembers the ids of new words.  Plain ones go to the library as one text: a token that ends a word

        ends its letters, and another one its comma or full stop.  The others go there one by one.
        """
        plain = [w for w in new if self.PLAIN(w)]
        if plain:
            data = self._ids([" ".join(plain)])[0]
            ends = np.flatnonzero(self.last[np.frombuffer(data, np.uint16)]) + 1
            parts = np.array([2 if w[-1] in ",." else 1 for w in plain])
            cuts = (2 * ends[np.cumsum(parts) - 1]).tolist()
            self.word.fill(plain, [data[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)])
        if len(plain) < len(new):
            other = [w for w in new if not self.PLAIN(w)]
            self.word.fill(other, self._ids(other))

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        words = pc.split_pattern(pc.replace_substring(pa.array([t or "" for t in texts], pa.string()), "\n", " "), " ")
        coded, word = words.values.dictionary_encode(), self.word
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in word and w not in word.old]
        for k in range(0, len(new), 5000):
            self._learn(new[k : k + 5000])
        known = [word[w] for w in distinct]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 2
        first = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        ends = np.cumsum(sizes[at])
        places = np.repeat(first[at] - ends + sizes[at], sizes[at]) + np.arange(ends[-1] if len(ends) else 0)
        ids = np.frombuffer(b"".join(known), np.uint16)[places]
        bounds = np.concatenate(([0], ends))[words.offsets.to_numpy()].tolist()
        return [np.append(ids[a:b], self.end) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


_word_ids: list[WordIds] = []


def word_ids() -> WordIds:
    if not _word_ids:
        _word_ids.append(WordIds(public_tokenizers.path("word_bpe_49k.json"), 1))
    return _word_ids[0]


@query
def op10_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "ids")
    manifest = packing.write(load(spark, sf_dir, "documents"), folder, word_ids)
    return packing.checksums(manifest, folder)


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(load(spark, sf_dir, "embeddings"))


@query
def op12_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digest(licences.scan(load(spark, sf_dir, "documents")))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
