import numpy as np
import pytest
from test_neighbours import exact

from dealcast.llm import neighbours


@pytest.mark.parametrize("draw", [0, 1, 2])
def test_recall_with_a_third_of_the_rows_copies_of_one(spark, draw):
    """Over the queries that aren't copies; a copy may be any multiple."""
    d = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").toPandas()
    ids, x = d.vec_id.to_numpy(), np.array(d.embedding.tolist(), np.float64)
    rng = np.random.default_rng(draw)
    copy = rng.random(len(x)) < 1 / 3
    x[copy] = x[rng.integers(len(x))] * (1.0 if draw < 2 else rng.uniform(0.1, 9, (copy.sum(), 1)))
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest(table).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    want = {q: {v for v, _ in best} for q, best in exact(ids, x, 50, 5).items()}
    alone = [q for q in want if not copy[np.flatnonzero(ids == q)[0]]]
    recall = {q: len(found.get(q, set()) & want[q]) / 5 for q in alone}
    print("recall", np.mean(list(recall.values())), "2 or fewer of 5:", np.mean([r <= 0.4 for r in recall.values()]))
    assert len(alone) > 20 and np.mean(list(recall.values())) >= 0.9


def test_pivots_are_distinct_directions(spark):
    vectors = [(i, [1.0 + i % 7, 2.0 + 2 * (i % 7), 0.0]) for i in range(90)] + [(100, [0.0, 1.0, 0.0]), (101, [-0.0, 3.0, -0.0]), (102, [1.0, 0.0, 1e300])]
    got = neighbours._pivots(spark.createDataFrame(vectors, "vec_id long, v array<double>"), 256).collect()
    assert sorted(r.vec_id for r in got) == [0, 100, 102]
    assert len(neighbours._pivots(spark.createDataFrame(vectors, "vec_id long, v array<double>"), 2).collect()) == 2
