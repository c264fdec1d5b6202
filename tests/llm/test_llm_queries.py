"""Registered corpus queries against their SQL, and the pipeline stage by stage."""

import os
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from slotwise.llm import mixing, piece_bpe
from slotwise.llm.queries import ORACLES, QUERIES


def test_registered():
    names = {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES}
    assert names == set(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "minhash", "mixing", "sentencepiece"]


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for view in ("documents", "labels", "pages"):
        con.execute(f"create view {view} as select * from '{os.path.join(sf_dir, view + '.parquet')}'")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, sf_dir).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    tidy = lambda df: df[columns].sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(tidy(got), tidy(want), check_dtype=False, check_exact=True)


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before, texts = docs.columns, docs.count(), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir).cache()
        assert kept.columns == columns
        if name != "mixing":
            assert kept.join(docs, "doc_id", "left_anti").isEmpty()
        if name == "exact_dedup":
            assert kept.select("text").distinct().count() == kept.count() == docs.select("text").distinct().count()
        if name == "mixing":
            sums = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("w")).filter("w > 0")
            own = kept.groupBy("source").agg(F.sum(mixing.size_of(F.col("text"))).alias("w"))
            assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, own.collect()))
        docs = kept
        texts.append(kept.count())
    assert before >= texts[0] >= texts[1] >= texts[2] > 0.5 * before
    out = corpus_pipeline.run(spark, sf_dir)
    vocabulary = piece_bpe.default_vocabulary()
    want = piece_bpe.digests(docs, vocabulary).select("doc_id", "n_tokens", "decoded_sha256")
    assert out.select("doc_id", "n_tokens", "decoded_sha256").exceptAll(want).isEmpty() and out.count() == want.count()
