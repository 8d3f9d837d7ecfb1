"""The pipeline's stages on a small table, each held against its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import brute_components, brute_repetition

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        out.append(docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(stages):
    assert all(df.columns == corpus_pipeline.COLUMNS for df in stages[:-1])
    assert len(corpus_pipeline.STAGES) == 5


def test_classifier_keeps_good_and_drops_bad_documents(spark):
    sf = "/root/testdata/sf0.01"  # the smallest tables have too few bad documents to learn from
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, sf).select("doc_id").distinct()
    for quality, least, most in ((1, 0.97, 1.0), (0, 0.0, 0.5)):
        some = docs.select("doc_id").join(labels.where(F.col("quality") == quality).select("doc_id").distinct(), "doc_id", "left_semi").distinct()
        assert least <= some.join(kept, "doc_id", "left_semi").count() / some.count() <= most


def test_rules(stages):
    assert not any(brute_repetition(r.text)[5] for r in stages[1].collect())


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert ids(stages[2]) == sorted(key for key, _, low in brute_components(rows) if key == low)


def test_mix_and_packing(stages):
    before, mixed = set(ids(stages[2])), ids(stages[3])
    assert set(mixed) <= before and max(mixed.count(i) for i in set(mixed)) <= 2
    packed = stages[4].toPandas()
    assert packed.piece.eq(0).sum() == len(mixed)
    assert packed.groupby("sequence_id").length.sum().max() <= corpus_pipeline.SEQUENCE_LENGTH


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
