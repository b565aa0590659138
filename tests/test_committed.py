"""Each batch once: replays, failures between the two steps, races."""

import os

import pytest
from pyspark.sql import functions as F

from dealcast.sources.committed import CommittedTable
from dealcast.streaming import monitoring as MO


@pytest.fixture
def results(spark, tmp_path):
    return CommittedTable(spark, str(tmp_path / "results"), spark.range(0).selectExpr("id", "'' as day").schema)


def batch(spark, low, high):
    return spark.range(low, high).selectExpr("id", "concat('d', id % 3) as day")


def test_a_repeated_batch_adds_nothing(spark, results):
    assert results.commit(batch(spark, 0, 6), "a-0") and results.commit(batch(spark, 0, 6), "a-0") is None
    assert results.commit(batch(spark, 6, 9), "a-1")
    assert sorted(r.id for r in results.read().collect()) == list(range(9))
    assert {r.commit_key for r in results.committed().collect()} == {"a-0", "a-1"}


def test_an_empty_table_and_an_empty_batch(spark, results):
    assert results.read().count() == results.committed().count() == results.drop_attempts() == 0
    assert results.commit(batch(spark, 0, 0), "none") and results.commit(batch(spark, 0, 5), "none") is None
    assert results.read().count() == 0
    assert results.commit(batch(spark, 0, 0), F.col("day")) is None


def test_rows_by_their_own_key(spark, results):
    """Only keys that aren't there yet are taken; rows without one are not."""
    results.commit(batch(spark, 0, 9).where("day <> 'd2'"), F.col("day"))
    results.commit(batch(spark, 0, 30), F.col("day"))
    assert results.commit(batch(spark, 0, 30), F.col("day")) is None
    results.commit(batch(spark, 0, 3), F.lit(None).cast("string"))
    got = results.read().groupBy("day").count().collect()
    assert {r.day: r["count"] for r in got} == {"d0": 3, "d1": 3, "d2": 10}


def test_a_failure_between_the_steps_leaves_nothing_to_see(spark, results, monkeypatch):
    results.commit(batch(spark, 0, 3), "k0")
    with monkeypatch.context() as m:
        m.setattr(CommittedTable, "_enter", lambda self, keys: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            results.commit(batch(spark, 3, 6), "k1")
    assert results.read().count() == 3
    results.commit(batch(spark, 3, 6), "k1")
    assert sorted(r.id for r in results.read().collect()) == list(range(6))
    assert results.drop_attempts() == 1 and results.drop_attempts() == 0 and results.read().count() == 6


def test_of_two_racing_writers_one_counts(spark, results):
    """Both wrote and entered the same key: the reader takes one attempt whole."""
    other = CommittedTable(spark, results.path, results.schema)
    results.commit(batch(spark, 0, 4), "k")
    attempt = "0" * 32
    batch(spark, 0, 4).withColumn("commit_key", F.lit("k")).write.parquet(f"{other.path}/rows/attempt={attempt}")
    other._enter(spark.createDataFrame([("k", attempt)], "commit_key string, attempt string"))
    assert results.read().count() == 4 and other.committed().first().attempt == attempt


def test_a_stream_replays_its_batch_once(spark, sf, tmp_path, monkeypatch):
    """The gate fails after it has written a batch and before it commits it; the
    restarted query replays the batch, and a replay after the commit adds nothing."""
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    with monkeypatch.context() as m:
        m.setattr(CommittedTable, "_enter", lambda self, keys: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            MO.start_quality_gate(spark, sf, out, ck).awaitTermination()
    assert MO.gate_results(spark, out).count() == 0
    MO.start_quality_gate(spark, sf, out, ck).awaitTermination()
    once = MO.gate_results(spark, out)
    rows = sorted(map(str, once.collect()))
    assert len(rows) == 7 and {r.batch_id for r in once.collect()} == {0}
    for name in os.listdir(f"{ck}/commits"):  # the epoch counts as not done: it is replayed
        if not name.startswith("_"):
            os.remove(f"{ck}/commits/{name}")
    MO.start_quality_gate(spark, sf, out, ck).awaitTermination()
    assert sorted(map(str, MO.gate_results(spark, out).collect())) == rows
