"""The registered queries against their SQL, and the pipeline's stages, on whole tables."""

import pytest
from compare import assert_same
from pyspark.sql import functions as F

import corpus_pipeline
from mailstream.llm.common import written
from mailstream.llm.oracle import ORACLE_SQL
from mailstream.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_same_as_sql(spark, name):
    assert_same(QUERIES[name](spark, SMALL), ORACLE_SQL[name], SMALL)


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) < set(QUERIES)


def test_language_on_held_out_documents(spark):
    found = QUERIES["op7_language"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    row = found.where("held_out").join(docs, "doc_id").agg(
        F.count("*").alias("n"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")
    ).first()
    assert row["right"] >= 0.95 * row["n"] > 0


def test_stages_of_the_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame(
        [(None, "words in a text without a number", "en", "src0", 1), (90001, None, None, None, None),
         (90002, "", "en", "src0", 0), (90003, "12 34 !!", "en", None, 8), (90004, "the house and the water", None, None, 23),
         (90004, "the house and the water", None, None, 23)],
        docs.schema,
    )
    docs = docs.unionByName(extra)
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = written(docs, "test")
        counts.append(docs.count())
        if name == "language":
            assert docs.where("doc_id between 90001 and 90003").count() == 0
        if name == "near_duplicates":
            assert docs.where("doc_id = 90004").count() == 1
            assert docs.where("doc_id is null").count() == 1
        if name == "repeated_spans":
            assert docs.where("text = '' or n_chars != length(text)").count() == 0
    assert counts[0] - 3 >= counts[1] > counts[2] >= counts[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.count() == counts[-1]
    assert last.where("n_tokens != size(ids)").count() == 0


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0
