"""The features layer's plans at scale: no maps of a key's figures, codes from the written rows, fits over few partitions."""

from pyspark.sql import functions as F

from dealcast.operators import models as M
from dealcast.operators.encode import label_encode, targets
from dealcast.operators.joins import attach_key_stats
from dealcast.plans import features as P
from test_drift_shuffles import nodes
from test_feature_shuffles import BY, accounts, opps, plain_plans, teams  # noqa: F401


def test_what_a_key_has_by_period_is_joined_as_rows(opps, teams, accounts, plain_plans):  # noqa: F811
    f = P.create_features(opps, teams, accounts, BY, ["account"], win_counts=True)
    assert nodes(f, "ObjectHashAggregate") == 0  # lists and maps of a key's periods


def test_null_periods_and_missing_keys_meet_their_figures(spark):
    fact = spark.createDataFrame([("a", None, 1), ("a", "p", 2), (None, "p", 3), ("b", "p", 4), ("c", "q", 5)], "k string, p string, i int")
    table = fact.where("k IS NOT NULL AND k <> 'c'").select("p", "k", (F.col("i") * 10).alias("n"))
    dim = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z"), (None, "w")], "k string, d string")
    got = attach_key_stats(fact, dim, table, "k", ["p"])
    assert got.columns == ["k", "p", "i", "d", "n"]
    assert sorted(map(tuple, got.select("i", "d", "n").collect()), key=str) == sorted(
        [(1, "x", 10), (1, "y", 10), (2, "x", 20), (2, "y", 20), (3, None, None), (4, None, 40), (5, None, None)], key=str)


def test_codes_come_from_the_written_rows(spark, plain_plans):  # noqa: F811
    rows = spark.createDataFrame([("g", f"a{i % 3}", ["Won", "Lost"][i % 2]) for i in range(10)], "g string, a string, deal_stage string")
    wide = rows.join(rows.groupBy("a").agg(F.count("*").alias("n")), "a")  # costs a join wherever it is read
    got = targets(label_encode(wide, ["a"], ["g"], source=rows), by=["g"], source=rows)
    assert nodes(got, "Join") == 3  # its own, the label's and the target's codes
    assert {(r.a, r.a_encoded, r.deal_stage, r.target_multiclass) for r in got.collect()} == {
        (f"a{i}", i, s, k) for i in range(3) for k, s in enumerate(("Lost", "Won"))}


def test_fits_read_few_partitions_while_rows_are_few(spark, monkeypatch):
    n = spark.sparkContext.defaultParallelism
    df = spark.range(1000).repartition(3 * n)
    assert [M.fit_partitions(df, rows) for rows in (1000, 999, 500, 1)] == [1, 2, 2, n]
    assert M.fit_partitions(df.where("id < 0")) == 1

    class Estimator:
        def copy(self):
            return self

    monkeypatch.setattr(M, "fit_fold", lambda estimator, rows, k, key, folds: (rows.rdd.getNumPartitions(), k))
    assert M.fit_all({"x": Estimator()}, df, partitions=2)["x"].folds == [(2, k) for k in range(3)]
