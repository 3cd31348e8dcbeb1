"""A training corpus in four stages, each on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nightflux.llm.common import held_out, load
from nightflux.llm.minhash import near_duplicates
from nightflux.llm.mixing import mix
from nightflux.llm.pieces import encode
from nightflux.llm.toxicity import fit, score
from nightflux.session import scratch_path

#: No source is read more often than this.
MAX_REPEATS = 1.5


def _packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns that an operator needs; all others in one struct, where their names clash with none of its own."""
    others = [docs[c] for c in docs.columns if c not in needed]
    return docs.select(*needed, *([F.struct(*others).alias("_others")] if others else []))


def _unpacked(rows: DataFrame, columns: list[str], *needed: str) -> DataFrame:
    """The columns as they were before ``_packed``."""
    return rows.select(*(F.col(c) if c in needed else F.col("_others")[c].alias(c) for c in columns))


def _with(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is in ``decided``."""
    decided = decided.select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(decided, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer does not reject (score below 0.5); the labels of the held-out fifth are never learnt from.

    A null or empty text scores lowest and stays; rows that repeat stay as often as they came; other columns may have any names.
    """
    labels = load(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    needed = "doc_id", "text"
    scored = score(_packed(docs, *needed), fit(docs.select(*needed), labels), keep=True)
    return _unpacked(scored.where("score < 0.5"), docs.columns, *needed)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8), that with the smallest id.

    Documents without words stand alone.  Rows that repeat an id and a text count as one document.
    """
    needed = "doc_id", "text"
    kept, rows = near_duplicates(docs.select(*needed)).where("kept"), _packed(docs, *needed)
    text = F.coalesce(F.xxhash64("text"), F.lit(0))
    place = F.row_number().over(W.partitionBy("doc_id", text).orderBy(F.lit(0)))
    return _unpacked(_with(rows, kept).withColumn("_row", place).where("_row = 1"), docs.columns, *needed)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and again those that the mixture's weights repeat; no document is lost.

    A null source is a source; a null text has no words; other columns may have any names.
    """
    needed = "doc_id", "source", "text"
    return _unpacked(mix(_packed(docs, *needed), max_repeats=MAX_REPEATS), docs.columns, *needed)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text: ``doc_id``, ``ids``, ``n_pieces``."""
    return encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("near_dedup", near_dedup), ("mixing", mixing), ("sentencepiece", pieces)]

#: Learning, hashing and piece search are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
