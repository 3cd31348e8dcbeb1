"""Stages of the pipeline on documents whose other columns bear the operators' own names."""

import corpus_pipeline
from nightflux.llm.common import load
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
NAMES = ["score", "_text", "_id", "_row", "block", "order_key", "_block", "_key", "_source", "_whole", "_last", "kept"]


def test_other_columns_may_have_any_names(spark):
    docs = load(spark, SF, "documents")
    more = docs.withColumns({c: F.concat(F.lit(f"{c} "), "doc_id") for c in NAMES})
    for stage in (corpus_pipeline.toxicity, corpus_pipeline.near_dedup, corpus_pipeline.mixing):
        plain, full = stage(spark, docs, SF), stage(spark, more, SF)
        assert plain.columns == docs.columns and full.columns == more.columns
        got = full.collect()
        assert all(row[c] == f"{c} {row.doc_id}" for row in got for c in NAMES)
        assert sorted((r.doc_id, r.text) for r in got) == sorted((r.doc_id, r.text) for r in plain.collect())
