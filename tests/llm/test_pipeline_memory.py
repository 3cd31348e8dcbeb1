"""What tasks of the pipeline's stages keep in memory."""

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nightflux.llm.common import BATCH_ROWS
from nightflux.llm.minhash import Shingler, near_duplicates
from nightflux.llm.pieces import PAIRS, Pieces, encode
from nightflux.llm.toxicity import Channel, Scorer, score


def test_word_hashes_that_a_task_remembers_are_few():
    shingle = Shingler(5)
    words = [f"w{k}" for k in range(220_000)]
    whole = shingle(" ".join(words))
    assert len(shingle.hash) + len(shingle.hash.old) <= 200_000
    assert (whole == shingle(" ".join(words))).all() and len(whole) == len(words) - 4


def test_a_kept_text_is_sent_to_the_workers_once(spark):
    scorer = Scorer(Channel({}), {"=idiot": 5.0})
    scorer.weights[:] = -5.0, 2.0, 2.0, 1.0
    docs = spark.createDataFrame([(1, "an idiot", "x"), (2, "a cat", None), (3, None, "y"), (3, "", "y")], "doc_id long, text string, source string")
    whole = score(docs, scorer, keep=True)
    assert whole.columns == [*docs.columns, "score"]
    assert "_text" not in whole._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.doc_id, r.text, r.source): r.score for r in whole.collect()}
    assert set(got) == {tuple(r) for r in docs.collect()}
    assert sorted(r.score for r in score(docs, scorer).collect()) == sorted(got.values())
    assert got[1, "an idiot", "x"] > 0.5 > got[2, "a cat", None] == got[3, None, "y"] == got[3, "", "y"]
    binary = score(docs.withColumn("text", F.col("text").cast("binary")), scorer, keep=True)
    assert sorted(r.score for r in binary.collect()) == sorted(got.values())


LIMIT = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _largest_batch(docs):
    def run(stream):
        for batch in stream:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["rows"])

    return docs.mapInArrow(run, "rows long").agg(F.max("rows")).first()[0]


@pytest.mark.parametrize("step", [
    lambda docs: encode(docs, public_tokenizers.path("piece_bpe_32k.model")),
    lambda docs: score(docs, Scorer(Channel({}), {}), keep=True),
    lambda docs: near_duplicates(docs.limit(2))])
def test_python_gets_few_whole_texts_at_a_time(spark, step):
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("text"), "id").alias("text"))
    try:
        spark.conf.set(LIMIT, "10000")
        assert _largest_batch(docs) == 3000
        step(docs)
        assert _largest_batch(docs) <= BATCH_ROWS
        spark.conf.set(LIMIT, "7")
        step(docs)
        assert _largest_batch(docs) == 7  # the user's lower limit stays
        # a group of more rows than a batch comes whole
        whole = docs.groupBy(F.lit(1).alias("one")).applyInArrow(lambda t: pa.table({"n": [t.num_rows]}), "n long")
        assert [r.n for r in whole.collect()] == [3000]
    finally:
        spark.conf.unset(LIMIT)


def test_pairs_of_pieces_that_a_worker_remembers_are_few():
    own = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert own.kind.fits.limit == PAIRS <= 150_000
