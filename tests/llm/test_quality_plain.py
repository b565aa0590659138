import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from dealcast.llm import learning, quality


def plain_score(text, vectors, layer, bias):
    """The softmax of the mean of the features' vectors, feature by feature."""
    doc, bucket, _ = quality.text_features(pa.array([text], pa.string()))
    mean = np.zeros(quality.DIM)
    for b in bucket.tolist():
        mean += vectors[b].astype(float) / len(bucket)
    z = mean @ layer.astype(float) + bias.astype(float)
    p = np.exp(z - z.max())
    return p[1] / p.sum()


def test_scores_equal_the_softmax_of_the_trained_vectors(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = learning.labelled_texts(docs, labels, "quality", 100).select("doc_id", "label").collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sorted(rows)
    features = [quality.featurize(pa.array([texts[r.doc_id]]))[0] for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i].doc_id, features[i].tobytes()))
    fitted = [features[i] for i in order], np.array([rows[i].label for i in order])
    model = quality.train(*fitted)
    assert quality.fit_quality(docs, labels, sample=100) == model
    trained = quality.descend(*fitted)
    more = spark.createDataFrame([(-1, None), (-2, ""), (-3, "a a a a"), (-4, "é" * 999)], "doc_id long, text string")
    own = docs.select("doc_id", "text").limit(80).unionByName(more)
    for r in quality.score(own, model).join(own, "doc_id").collect():
        assert abs(r.score - plain_score(r.text, *trained)) < 1e-4


def test_copies_of_a_text_are_one_row(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    n = docs.count()
    copies = spark.range(10_000, 10_000 + n).select(F.col("id").alias("doc_id"), F.lit("one bad text again").alias("text"))
    marked = copies.select("doc_id", F.lit(0).alias("quality"), F.lit(0).alias("toxic"))
    rows = learning.labelled_texts(docs.unionByName(copies), labels.select("doc_id", "quality", "toxic").unionByName(marked), "quality", 10_000).collect()
    assert sum(r.doc_id >= 10_000 for r in rows) == 1 and len({r.text_hash for r in rows}) == len(rows) > 50
    alone = quality.quality(docs, labels).where("held_out").select("doc_id", F.col("predicted").alias("before"))
    both = quality.quality(docs.unionByName(copies), labels.select("doc_id", "quality", "toxic").unionByName(marked))
    changed = both.join(alone, "doc_id").where("before <> predicted").count()
    assert changed <= 0.05 * alone.count()
