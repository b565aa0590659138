import numpy as np
import pytest

from dealcast.llm import language, quality, toxicity

EDGES = [(1, None), (2, ""), (None, "some plain words here"), (3, "x"), (3, "x"), (4, "word " * 30_000), (5, "!!! ### 123")]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(*x, 0.1, 0.2, "en", "f") for x in EDGES],
                                 "doc_id long, text string, score double, p_toxic double, lang string, features string")


@pytest.fixture(scope="module")
def more(spark):
    """A table with enough labelled rows to learn from."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return d, spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_quality_on_held_out_rows(more):
    docs, labels = more
    got = quality.quality(docs, labels).join(labels.select("doc_id", "quality"), "doc_id", "left").collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.quality is not None]
    assert len(held) > 40 and np.mean([r.predicted == r.quality for r in held]) >= 0.95
    good = [r.score for r in held if r.quality == 1]
    bad = [r.score for r in held if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) >= 0.98


def test_toxicity_on_held_out_rows(more):
    docs, labels = more
    got = toxicity.toxicity(docs, labels).join(labels.selectExpr("doc_id", "toxic as label"), "doc_id", "left").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out and r.label is not None]
    assert np.mean([r.toxic == bool(r.label) for r in held]) >= 0.94
    assert not [r for r in held if r.toxic and not r.label]
    assert all(0 <= getattr(r, f"p_{c}") <= 1 for r in got for c in toxicity.names())


def test_later_models_see_out_of_fold_probabilities(more):
    """The chain's later models have a weight for each earlier category."""
    import pickle
    docs, labels = more
    chain = pickle.loads(toxicity.fit_toxicity(docs, labels))
    assert [len(extra) for _, _, _, extra in chain] == [0, 1, 2]
    assert np.abs(chain[-1][3]).max() > 0


def test_language_on_held_out_rows(more):
    docs, _ = more
    got = language.language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.97
    sure = [r for r in held if r.accepted]
    assert len(sure) > 0.8 * len(held) and np.mean([r.lang_pred == r.lang for r in sure]) >= 0.98


def test_edge_cases(spark, edges, more):
    docs, labels = more
    model = quality.fit_quality(docs, labels)
    got = quality.score(edges, model)
    assert got.count() == len(EDGES)
    by = {r.doc_id: r.score for r in got.collect()}
    assert by[1] == by[2] and all(0 <= s <= 1 for s in by.values())
    tox = toxicity.score(edges.select("doc_id", "text"), toxicity.fit_toxicity(docs, labels))
    assert tox.count() == len(EDGES) and not [r for r in tox.collect() if r.p_toxic >= toxicity.CUT]
    lang = {r.doc_id: r for r in language.predict(edges, language.learn(docs)).collect()}
    assert lang[1].lang_pred == lang[2].lang_pred == lang[5].lang_pred == "und" and lang[1].score == 0 and not lang[1].accepted


def test_nothing_to_learn_from_and_empty_tables(spark, edges, labels):
    none = labels.limit(0)
    assert {r.score for r in quality.quality(edges, none).collect()} == {0.5}
    assert {r.p_toxic for r in toxicity.toxicity(edges, none).collect()} == {0.0}
    no_lang = edges.withColumn("lang", edges.lang.substr(1, 0)).where("text is null")
    assert [r.lang_pred for r in language.language(no_lang).collect()] == ["und"]
    empty = edges.limit(0)
    assert quality.quality(empty, labels).count() == toxicity.toxicity(empty, labels).count() == language.language(empty).count() == 0


def test_labels_with_nulls_and_repeats(spark, edges):
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 1), (3, 1, 0), (3, 1, 0), (4, 0, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.quality(edges, labels).count() == toxicity.toxicity(edges, labels).count() == len(EDGES)


def test_scores_do_not_use_labels_language_source_or_id(spark, more):
    docs, labels = more
    model = quality.fit_quality(docs, labels)
    some = docs.limit(50)
    other = some.selectExpr("doc_id + 1000000 as doc_id", "text", "'xx' as lang", "'none' as source")
    changed = {r.doc_id - 1_000_000: r.score for r in quality.score(other, model).collect()}
    assert {r.doc_id: r.score for r in quality.score(some, model).collect()} == changed
