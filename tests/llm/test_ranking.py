import math
import re
from collections import Counter

import numpy as np
import pytest
from conftest import rows

from dealcast.llm import ranking as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    """Every score, by loops."""
    tf = [(d, Counter(words(t))) for d, t in docs]
    tf = [(d, c) for d, c in tf if c]
    n_docs, n_words = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    own = {}
    for item, text in set(items):
        own.setdefault(item, Counter()).update(words(text))
    out = []
    for item, terms in own.items():
        scores = []
        for d, c in tf:
            m = 100 - 75 + 75 * sum(c.values()) * n_docs // n_words
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t, q in terms.items() if t in c)
            if s > 0:
                scores.append((-s, d is not None, d or 0))
        out += [(item, r, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


DOCS = [(1, "alpha beta gamma"), (1, "alpha beta gamma"), (2, None), (3, ""), (4, "... --"), (None, "Alpha ALPHA é beta"), (5, "delta " * 3000 + "alpha"),
        (6, "ÉTÉ été Été"), (7, "a1_b2 c"), (-8, "beta"), *[(100 + i, "beta gamma") for i in range(30)]]
ITEMS = [(1, "alpha, beta beta"), (1, "alpha, beta beta"), (2, None), (3, "nothing here matches"), (None, "gamma"), (4, "b2 a1 été"), (4, "delta"), (5, "beta " * 500)]


def frames(spark, docs, items):
    return (spark.createDataFrame([(*r, 7, 8, "x") for r in docs], "doc_id long, text string, n int, rank int, terms string"),
            spark.createDataFrame([(*r, 7, "x") for r in items], "item_id long, text string, item int, term string"))


@pytest.mark.parametrize("item_rows", [R.ITEM_ROWS, 3])
def test_edge_cases(spark, item_rows):
    d, i = frames(spark, DOCS, ITEMS)
    assert rows(R.ranked(d, i, item_rows=item_rows)) == plain(DOCS, ITEMS)
    assert rows(R.ranked(d, i, k=2)) == plain(DOCS, ITEMS, 2)


def test_empty_tables(spark):
    d, i = frames(spark, DOCS, ITEMS)
    assert R.ranked(d.limit(0), i).count() == 0 and R.ranked(d, i.limit(0)).count() == 0
    assert R.ranked(d.where("doc_id in (2, 3, 4)"), i).count() == 0


def test_a_whole_table(spark, docs, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    have = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    got = R.ranked(docs, items)
    assert rows(got) == plain(*have)
    ids = items.withColumn("item_id", items.item_id.cast("string"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(R.ranked(docs, ids).dtypes)["item_id"] == "string"


def made(rng, n, size, groups, low, high):
    """Sparse vectors; rows of a group share their coordinates."""
    group = rng.integers(0, groups, n)
    each = [np.unique(g * (size // groups) + rng.integers(0, size // groups, int(rng.integers(low, high)))) for g in group]
    first = np.cumsum([0] + [len(x) for x in each])
    return first, np.concatenate(each), np.minimum(rng.zipf(1.4, first[-1]), 10 ** 6)


@pytest.mark.parametrize("kind", [np.float64, np.int64])
def test_trees_prune_and_lose_nothing(kind):
    rng = np.random.default_rng(2)
    item = made(rng, 60, 400, 8, 3, 20)
    search = R.Search(R.Items(*item, kind), 5, np.ones(400, np.int64))
    want = [[] for _ in range(60)]
    for b in range(4):
        doc = made(rng, 700, 400, 8, 1, 30)
        ids, null = rng.integers(0, 300, 700), rng.random(700) < 0.01
        search.block(ids, null, *doc)
        dense = [np.zeros((n, 400), np.int64) for n in (60, 700)]
        for x, (first, terms, values) in zip(dense, (item, doc)):
            x[np.repeat(np.arange(len(x)), np.diff(first)), terms] = values
        scores = dense[0] @ dense[1].T
        for i in range(60):
            want[i] += [(-int(s), not z, int(d)) for s, z, d in zip(scores[i], null, ids) if s > 0]
    for at, i in enumerate(search.items.order):
        assert search.found[at] == sorted(want[i])[:5]
    assert search.scored < 0.25 * search.shown


def test_every_node_bounds_what_lies_below():
    rng = np.random.default_rng(3)
    items = R.Items(*made(rng, 50, 100, 4, 1, 15), np.float64)

    def look(node):
        for terms, values in items.vectors[node.low:node.high]:
            assert (node.best[np.searchsorted(node.terms, terms)] >= values).all()
        assert not node.parts or (node.parts[0].low, node.parts[-1].high) == (node.low, node.high)
        for p in node.parts:
            look(p)
    look(items.root)
    assert sorted(items.order) == list(range(50))
