"""The pipeline's stages against plain versions, on a table with null ids,
repeated ids and rows, ties, empty texts and columns that clash."""

import zlib

import brute
import numpy as np
import pytest
from conftest import rows

import corpus_pipeline
from dealcast.llm import quality, stages, toxicity
from dealcast.llm.tokens import default_vocabulary, tokenizer

SCHEMA = "toxic string, doc_id long, text string, kept int"


def row(doc_id, text):
    return (f"t{len(text or '')}", doc_id, text, len(text or ""))


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """A folder with documents, labels and benchmark, and the documents' rows."""
    sf, root = "/root/testdata/sf0.01", str(tmp_path_factory.mktemp("corpus"))
    some = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 2500").orderBy("doc_id").collect()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    marks = {r.doc_id: r for r in labels.collect()}
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    out = [row(r.doc_id, r.text) for r in some]
    toxic = next(r for r in some if r.doc_id in marks and marks[r.doc_id].toxic)
    good = [r for r in some if r.doc_id in marks and marks[r.doc_id].quality and not marks[r.doc_id].toxic and len(r.text) > 600][:4]
    passage = max((r.text for r in items.collect() if r.text), key=len)
    out += [row(None, toxic.text), row(None, toxic.text), row(70_001, toxic.text), row(70_001, good[0].text)]
    out += [row(None, good[1].text), row(None, good[1].text), row(70_002, good[2].text), row(70_002, good[2].text), row(70_003, good[3].text + " more")]
    out += [row(70_004, good[2].text + " " + passage), row(None, passage), row(70_005, None), row(70_006, ""), row(None, None), row(None, "alone")]
    spark.createDataFrame(out, SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")
    labels.write.parquet(f"{root}/labels.parquet")
    items.write.parquet(f"{root}/benchmark.parquet")
    return root, out


def name(r):
    """Rows that share an id are one document, and so are rows without one that share a text."""
    return ("text", r[2]) if r[1] is None else ("id", r[1])


def left(docs, gone):
    gone = {name(r) for r, out in zip(docs, gone, strict=True) if out}
    return [r for r in docs if name(r) not in gone]


def by_score(spark, docs, score):
    """``score``'s last column of each row, in order."""
    numbered = spark.createDataFrame([(i, r[2]) for i, r in enumerate(docs)], "doc_id long, text string")
    found = dict(score(numbered).collect())
    return [found[i] for i in range(len(docs))]


def plain_toxicity(spark, docs, root):
    model = toxicity.fit_toxicity(spark.createDataFrame(docs, SCHEMA), spark.read.parquet(f"{root}/labels.parquet"))
    return left(docs, [p >= toxicity.CUT for p in by_score(spark, docs, lambda d: toxicity.score(d, model).select("doc_id", "p_toxic"))])


def plain_quality(spark, docs, root):
    model = quality.fit_quality(spark.createDataFrame(docs, SCHEMA), spark.read.parquet(f"{root}/labels.parquet"))
    return left(docs, [p < 0.3 for p in by_score(spark, docs, lambda d: quality.score(d, model).select("doc_id", "score"))])


def plain_near_duplicates(spark, docs, root):
    texts = sorted({r[2] or "" for r in docs if r[1] is None})
    ids = [(1 << 62) + texts.index(r[2] or "") if r[1] is None else r[1] for r in docs]
    found = brute.near_duplicates([(i, r[2]) for i, r in zip(ids, docs)], 5)
    hashes = [h for _, h in sorted(spark.createDataFrame([(i, r[2]) for i, r in enumerate(docs)], "n long, text string").selectExpr("n", "xxhash64(text)").collect())]
    best = {}
    for i, r, h, (*_, kept) in zip(ids, docs, hashes, found, strict=True):
        if kept and (i not in best or h < best[i][0]):
            best[i] = (h, r)
    return [r for _, r in best.values()]


def plain_decontamination(spark, docs, root):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    return left(docs, [r[-1] for r in brute.contamination([(r[1], r[2]) for r in docs], items)])


def check_packed(docs, placed):
    model, want = tokenizer(default_vocabulary()).model, []
    for r in docs:
        ids = np.array(model.encode(r[2] or "", add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 2048):
            want.append((r[1], k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes())))
    got = placed.collect()
    assert sorted(want, key=str) == sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str)
    filled = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048


PLAIN = {"toxicity": plain_toxicity, "quality": plain_quality, "near_duplicates": plain_near_duplicates, "decontamination": plain_decontamination}


@pytest.mark.parametrize("stage", PLAIN)
def test_stage(spark, data, stage):
    root, docs = data
    got = getattr(stages, stage)(spark, spark.createDataFrame(docs, SCHEMA), root)
    want = PLAIN[stage](spark, docs, root)
    assert got.columns == ["toxic", "doc_id", "text", "kept"]
    assert rows(got) == sorted(want, key=str) and 0 < len(want) < len(docs)


def test_packing_stage(spark, data):
    root, docs = data
    check_packed(docs, stages.packing(spark, spark.createDataFrame(docs, SCHEMA), root))


def test_run(spark, data):
    root, docs = data
    for stage in PLAIN.values():
        docs = stage(spark, docs, root)
    check_packed(docs, corpus_pipeline.run(spark, root))


def test_empty_tables(spark, data):
    none = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, none, data[0])
        assert got.count() == 0 and (name == "packing" or got.columns == none.columns)


def test_a_stage_called_alone_keeps_its_scratch_and_run_drops_it(spark, data):
    """Rows of one stage can still be read after another has run."""
    from dealcast.session import scratch_tables
    root, docs = data
    table = spark.read.parquet(f"{root}/documents.parquet")
    first = stages.decontamination(spark, table, root)
    stages.packing(spark, table, root)
    assert first.count() <= len(docs)
    before = set(scratch_tables())
    corpus_pipeline.run(spark, root).count()
    assert set(scratch_tables()) == before
