import numpy as np
import pytest
from pyspark.sql import functions as F

from dealcast.llm import toxicity


@pytest.fixture(scope="module")
def more(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").where("length(text) < 6000")
    return d, spark.read.parquet("/root/testdata/sf0.1/labels.parquet")


def with_copies(spark, docs, labels, text):
    """Half as many labelled rows again, all of one toxic text."""
    known = docs.join(labels, "doc_id")
    one = known.where("toxic = 1 and length(text) > 300").orderBy("doc_id").first()
    ids = spark.range(10_000_000, 10_000_000 + known.count() // 2).withColumnRenamed("id", "doc_id")
    return (docs.unionByName(ids.select("doc_id", text(F.lit(one.text)).alias("text"))),
            labels.select("doc_id", F.col("toxic").cast("int")).unionByName(ids.select("doc_id", F.lit(1).alias("toxic"))))


@pytest.mark.parametrize("text, least", [(lambda t: t, 0.85), (lambda t: F.concat(t, F.lit(" "), F.col("doc_id").cast("string")), 0.5)], ids=["copies", "near copies"])
def test_a_third_of_the_labelled_rows_is_one_toxic_text(spark, more, text, least):
    docs, labels = with_copies(spark, *more, text)
    got = toxicity.toxicity(docs, labels).join(labels.withColumnRenamed("toxic", "label"), "doc_id").where("held_out").collect()
    copies = [r for r in got if r.doc_id >= 10_000_000]
    others = [r for r in got if r.doc_id < 10_000_000]
    assert len(copies) > 100 and all(r.toxic for r in copies)
    assert np.mean([r.toxic for r in others if not r.label]) <= 0.02
    assert np.mean([r.toxic for r in others if r.label]) >= least


def test_sample_has_each_text_once(spark):
    docs = spark.createDataFrame([(i, "one text") for i in range(100)] + [(200, "x"), (201, None), (202, ""), (203, "x"), (203, "y"), (None, "z")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(100)] + [(i, 0) for i in range(200, 204)] + [(None, 1), (999, 1)], "doc_id long, toxic int")
    free = {r.doc_id for r in docs.where(~toxicity.C.held_out("doc_id")).collect()}
    got = toxicity.labelled_texts(docs, labels, "toxic", 1000).join(docs.withColumn("text_hash", toxicity.text_hash("text")), ["doc_id", "text_hash"]).collect()
    texts = [r.text or "" for r in got]
    assert {r.doc_id for r in got} <= free and len(texts) == len(set(texts)) and "one text" in texts and "z" not in texts
    assert [(r.doc_id, r.label) for r in got if r.text == "one text"] == [(min(free), 1)]


def test_what_is_kept_is_what_the_models_would_choose_of_all_features(spark, more):
    """The chain from the features kept in Spark equals the one from all of them."""
    import pickle
    docs, labels = more
    rows = toxicity._sampled(docs, toxicity.labelled_texts(docs, labels, "toxic", 400), "doc_id", "text").orderBy("doc_id").collect()
    features = [np.frombuffer(r.features, np.int32) for r in rows]
    whole = toxicity.train(features, np.array([r.label for r in rows]), np.array([r.fold for r in rows]), np.arange(1 << toxicity.BITS))
    for a, b in zip(pickle.loads(whole), pickle.loads(toxicity.fit_toxicity(docs, labels, sample=400)), strict=True):
        assert a[0].tolist() == b[0].tolist() and np.allclose(a[1], b[1], atol=1e-3) and np.allclose(a[3], b[3], atol=1e-3)
