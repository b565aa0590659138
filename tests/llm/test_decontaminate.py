from brute import contamination
from conftest import SF, rows

from dealcast.llm import decontaminate as op

DOCS = "doc_id long, text string, window string, row int, n_words int"
ITEMS = "item_id long, text string, shingle string, window int"


def test_edge_cases_match_brute_force(spark):
    long = " ".join(f"w{i % 97}" for i in range(30_000))
    passage = " ".join(f"w{i % 97}" for i in range(40, 60))
    docs = [(1, None), (2, ""), (None, "a b c"), (3, "a b c a b"), (3, "a b c a b"), (4, "A, B! c"), (5, "é ü é ü é"), (6, "É b"), (7, long), (8, passage + " tail")]
    items = [(1, "a b"), (1, "a b"), (None, "c"), (7, None), (8, ""), (9, "b"), (10, "É ü é"), (11, "é ü é ü"), (12, passage), (13, passage), (10, "c a")]
    d = spark.createDataFrame([(*x, "x", 1, 2) for x in docs], DOCS)
    b = spark.createDataFrame([(*x, "x", 1) for x in items], ITEMS)
    assert rows(op.digest(op.decontaminate(d, b))) == sorted(contamination(docs, items), key=str)
    assert op.decontaminate(d.limit(0), b).count() == 0
    none = op.digest(op.decontaminate(d, b.limit(0))).collect()
    assert len(none) == len(docs) and not any(r.contaminated or r.n_items for r in none)


def test_window_lengths_and_spans(spark):
    d = spark.createDataFrame([(1, "x a b c d e y"), (2, "a b c d x e"), (3, "c d e f")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    got = rows(op.digest(op.decontaminate(d, b, window=4)))
    assert got == sorted(contamination([tuple(r) for r in d.collect()], [(1, "a b c d e f")], 4), key=str)
    read, spans, _ = op.find_windows(d, b, window=4)
    found = spans.join(read, "row").select("doc_id", "start", "len")
    assert rows(found) == [(1, 1, 4), (1, 2, 4), (2, 0, 4), (3, 0, 4)]


def test_whole_small_table(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = contamination([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows(op.digest(op.decontaminate(docs, items))) == sorted(want, key=str)
