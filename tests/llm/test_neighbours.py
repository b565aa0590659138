import numpy as np
from conftest import rows

from dealcast.llm import neighbours


def exact(ids, x, every, top):
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = unit @ unit[i]
        s[i] = -9
        best = np.lexsort((ids, -s))[:top]
        out[int(ids[i])] = [(int(ids[b]), float(s[b])) for b in best if b != i]
    return out


def test_recall_against_brute_force(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours.nearest(d).collect()
    pdf = d.orderBy("vec_id").toPandas()
    want = exact(pdf.vec_id.to_numpy(), np.array(pdf.embedding.tolist(), np.float64), 50, 5)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    assert set(found) == set(want)
    hits = sum(len({v for v, _ in want[q]} & {v for v, _ in found[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    for q, pairs in found.items():
        assert pairs == sorted(pairs, key=lambda p: (-p[1], p[0]))


def test_few_rows_are_found_exactly_with_ties_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (50, [1.0, 0.1]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [1.0, None]), (None, [1.0, 0.0]),
            (7, [0.0, -1.0]), (8, [1.0]), (50, [1.0, 0.1]), (9, [1e300, 0.0]), (10, [1e-300, 1e-300]), (100, [inf, 1.0]), (11, []), (150, [])]
    d = spark.createDataFrame([(*x, 3, 0.5) for x in data], "vec_id long, embedding array<double>, rank int, score double")
    got = rows(neighbours.nearest(d).select("query_id", "rank", "vec_id"))
    assert [g for g in got if g[0] == 0] == [(0, 1, 1), (0, 2, 9), (0, 3, 50), (0, 4, 50), (0, 5, 10)]
    assert len([g for g in got if g[0] == 50]) == 10 and {g[0] for g in got} == {0, 50}
    assert neighbours.nearest(d.limit(0)).count() == 0
    assert neighbours.nearest(d.where("vec_id = 0")).count() == 0


def test_many_copies_in_small_blocks(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([np.repeat(rng.normal(size=(1, 8)), 300, 0), rng.normal(size=(200, 8))])
    d = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = rows(neighbours.nearest(d, block=32).where("query_id = 50").select("rank", "vec_id"))
    assert got == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4)]
