import random

import pytest
from brute import near_duplicates as brute
from conftest import rows

from dealcast.llm import neardup
from dealcast.llm.components import components


def test_needed_overlap():
    assert neardup.needed_overlap(48, 80) == 21
    assert neardup.needed_overlap(10, 100) == 10


@pytest.mark.parametrize("size", [2, 5])
def test_edge_cases_match_brute_force(spark, size):
    long = " ".join(f"w{i % 5003}" for i in range(20_000))
    docs = [(1, None), (2, ""), (None, "a b c"), (3, "a b c a b"), (3, "a b c a b"), (4, "A b C"), (5, "c"), (6, "C"), (7, "a b c"), (8, "x y"),
            (7, "x y"), (9, "a  b\tc"), (10, "É a b"), (11, "é a b"), (12, long), (13, long + " end"), (14, "end " + long), (15, "  z")]
    d = spark.createDataFrame([(*x, 1, 2, "v") for x in docs], "doc_id long, text string, n int, rep int, value string")
    assert rows(neardup.near_duplicates(d, size=size)) == sorted(brute(docs, size), key=str)
    assert neardup.near_duplicates(d.limit(0)).count() == 0


def test_chains_and_groups_near_the_threshold(spark):
    """Groups whose members are similar to some members only, so that pivots
    don't find all, and common words that every document has."""
    rng = random.Random(3)
    docs = []
    for g in range(6):
        words = [f"g{g}w{i}" for i in range(rng.randint(40, 160))]
        for c in range(25):
            for _ in range(max(1, len(words) // 40)):
                words[rng.randrange(len(words))] = f"g{g}c{c}x{rng.randrange(10**6)}"
            docs.append((len(docs), "every text begins so " + " ".join(words)))
    rng.shuffle(docs)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(neardup.near_duplicates(d, size=2)) == sorted(brute(docs, 2), key=str)


def test_whole_small_table(spark, docs):
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 5)
    assert rows(neardup.near_duplicates(docs)) == sorted(want, key=str)


def test_large_groups_of_near_copies_go_through_buckets(spark, monkeypatch):
    """Long lists whose members are only partly similar, in many blocks."""
    monkeypatch.setattr(neardup, "SHORT", 4)
    monkeypatch.setattr(neardup, "SIDE", 8)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(160):
        words = list(base)
        for at in rng.sample(range(60), rng.choice([1, 3, 4, 5, 9])):
            words[at] = f"x{rng.randrange(10**9)}"
        docs.append((i, " ".join(words)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(brute(docs, 2), key=str)
    assert rows(neardup.near_duplicates(d, size=2)) == want
    monkeypatch.setattr(neardup, "EFFORT", 0)
    assert rows(neardup.near_duplicates(d, size=2)) == want


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 40).selectExpr("id - 1 a", "id b").union(spark.range(51, 60).selectExpr("cast(50 as long) a", "id b"))
    want = {i: 0 if i < 40 else 50 for i in [*range(40), *range(50, 60)]}
    assert dict(rows(components(links))) == dict(rows(components(links, rows_a_task=7))) == want
    assert components(links.limit(0)).count() == 0


def test_rows_sent_grow_with_the_blocks_that_hold_a_stray(spark):
    """A bucket of 50 blocks with one minor member: its block meets all others,
    and those don't meet each other; every minor member meets every other one."""
    from dealcast.llm.neardup import bucket_groups
    n, side = 6400, 128
    big = spark.range(n).selectExpr("1L as bucket", "id as rep", "1L as comp", "false as minor")
    stray = spark.createDataFrame([(1, 10**6, 7, True), (2, 2 * 10**6, 2, False), (2, 2 * 10**6 + 1, 3, True), (3, 3 * 10**6, 3, False)], big.schema)
    got = bucket_groups(big.unionByName(stray), side).collect()
    assert len(got) <= n + 3 * side * (n // side + 1) and len(got) < 4 * n
    groups = {}
    for r in got:
        groups.setdefault(r.g, set()).add((r.rep, r.side))
    met = set().union(*({x for x, _ in g} for g in groups.values() if 10**6 in {x for x, _ in g}))
    assert met == set(range(n)) | {10**6}
    members = [{x for x, _ in g} for g in groups.values()]
    assert {2 * 10**6, 2 * 10**6 + 1} in members and not any(3 * 10**6 in m for m in members)
    for g in groups.values():  # one block with itself, or two with their sides
        assert {s for _, s in g} in ({2}, {0, 1}) and len(g) < 3 * side


def test_many_strays_meet_each_other(spark):
    from dealcast.llm.neardup import bucket_groups
    rows = spark.range(900).selectExpr("5L as bucket", "id as rep", "id % 7 as comp", "id % 7 <> 0 as minor")
    groups = {}
    for r in bucket_groups(rows, 64).collect():
        groups.setdefault(r.g, []).append((r.rep, r.side, r.minor))
    met = set()
    for g in groups.values():
        for a, x, minor in g:
            if minor:
                met.update((a, b) for b, y, _ in g if x == 2 or x != y)
    assert all((a, b) in met for a in range(900) if a % 7 for b in range(900) if a != b)
