"""The features layer: rows are shuffled by few keys, and what it gives is what plain joins give."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from dealcast.functions import scalar as S
from dealcast.operators import models as M
from dealcast.operators.encode import label_codes, join_codes
from dealcast.operators.joins import attach_group_stats, join_accounts, join_sales_teams
from dealcast.operators.quality import quality_suite
from dealcast.plans import binding
from dealcast.plans.features import create_features
from dealcast.plans.snapshots import build_snapshots

BY = ["snapshot_period"]


@pytest.fixture(scope="module")
def opps(spark):
    stages = ["Won", "Lost", "Engaging", "Prospecting"]
    rows = [(f"o{i}", None if i % 17 == 0 else f"a{i % 7}", f"p{i % 3}", None if i % 13 == 0 else f"c{i * i % 11}", stages[i * 7 % 4],
             dt.date(2024, 1 + i % 5, 3), dt.date(2024, 2 + i % 5, 9) if i % 4 < 2 else None, float(i) if i % 5 else None, i, f"2024-0{1 + i % 3}") for i in range(200)]
    return spark.createDataFrame(rows, "opportunity_id string, sales_agent string, product string, account string, deal_stage string, engage_date date, "
                                       "close_date date, close_value double, opportunity_key long, snapshot_period string")


@pytest.fixture(scope="module")
def teams(spark):  # a2 comes twice, a5 and a6 are missing, and a row has no name
    return spark.createDataFrame([("a0", "m", "r"), ("a1", "m", "s"), ("a2", "m", "r"), ("a2", "n", "s"), ("a3", None, "r"), ("a4", "k", "r"), (None, "x", "y")],
                                 "sales_agent string, manager string, regional_office string")


@pytest.fixture(scope="module")
def accounts(spark):  # c1 comes three times
    return spark.createDataFrame([(c, f"s{i % 2}", float(i), i) for i, c in enumerate(["c0", "c1", "c1", "c1", "c3", "c4", "c5", None])],
                                 "account string, sector string, revenue double, employees long")


def exchanges(df):
    """Output columns and keys of the plan's shuffles."""
    def walk(p):
        if p.nodeName() == "Exchange":
            out = p.output()
            yield [out.apply(i).name() for i in range(out.size())], p.outputPartitioning().toString()
        for i in range(p.children().size()):
            yield from walk(p.children().apply(i))
    return list(walk(df._jdf.queryExecution().executedPlan()))


@pytest.fixture
def plain_plans(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large dimensions
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_features_equal_plain_joins_with_repeated_and_missing_names(spark, opps, teams, accounts):
    closed = F.col("is_closed") == 1
    want = join_sales_teams(opps.withColumns(S.stage_flags("deal_stage")), teams)
    for key, count, rate in (("sales_agent", "agent_opportunity_count", "agent_win_rate"), ("product", "product_popularity", "product_win_rate")):
        want = attach_group_stats(want, [*BY, key], {count: F.count("*"), rate: S.rounded_avg(F.when(closed, F.col("is_won")), 3)})
    want = attach_group_stats(join_accounts(want, accounts), [*BY, "account"], {"account_frequency": F.count("*")})
    coded = ("opportunity_id", "sales_agent", "account")
    for c in coded:
        want = join_codes(want, label_codes(opps, c, BY), c, BY)
    got = create_features(opps, teams, accounts, BY, coded)
    assert got.columns[:4] == ["snapshot_period", "account", "product", "sales_agent"]
    cols = sorted(set(want.columns) & set(got.columns))
    assert {"agent_win_rate", "account_frequency", "manager", "sector", *[f"{c}_encoded" for c in coded]} <= set(cols)
    rows = [sorted(map(str, t.select(*cols).collect())) for t in (want, got)]
    assert rows[0] == rows[1] and len(rows[0]) > 200


def test_rows_are_shuffled_once_by_agent_and_once_by_account(opps, teams, accounts, plain_plans):
    wide = [e for e in exchanges(create_features(opps, teams, accounts, BY)) if "opportunity_id" in e[0]]
    assert len(wide) == 2, wide


def test_distinct_snapshots_need_no_shuffle_of_their_own(spark, plain_plans):
    t = {"orders": spark.createDataFrame([(1, 1, "F", 5.0, dt.datetime(2024, 1, 1), "1-URGENT")],
                                         "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
         "lineitem": spark.createDataFrame([(1, 1, 1, 1)], "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long"),
         "supplier": spark.createDataFrame([(1, "a")], "s_suppkey long, s_name string"), "part": spark.createDataFrame([(1, "p")], "p_partkey long, p_brand string"),
         "customer": spark.createDataFrame([(1, "c")], "c_custkey long, c_name string")}
    s = build_snapshots(binding.opportunities(t), "1995-12", offset_days=F.lit(10), max_engage=F.lit(dt.date(2024, 1, 1)))
    assert s.count() == 1 and not [e for e in exchanges(s.dropDuplicates()) if "snapshot_period" in e[0]]


def test_suite_over_written_distinct_rows(spark, opps):
    twice = opps.unionByName(opps.where("opportunity_key % 3 = 0"))
    counted = twice.groupBy(*twice.columns).agg(F.count("*").alias("_copies"))
    own = quality_suite(twice, by=BY)
    assert sorted(own.collect()) == sorted(quality_suite(twice, by=BY, distinct=counted).collect())
    assert own.agg(F.sum("duplicated_rows")).first()[0] == 67


def test_fits_run_beside_each_other(spark, monkeypatch):
    meet = threading.Barrier(3, timeout=60)  # breaks if the fits come one after the other

    class Estimator:
        def copy(self):
            return self

    def fit(estimator, rows, k, key, folds):
        meet.wait()
        return rows.rdd.getNumPartitions(), k

    monkeypatch.setattr(M, "fit_fold", fit)
    n = spark.sparkContext.defaultParallelism
    got = M.fit_all({"x": Estimator(), "y": Estimator()}, spark.range(100).repartition(4 * n), parallelism=3)
    assert {k: v.folds for k, v in got.items()} == {x: [(n, k) for k in range(3)] for x in "xy"}


def test_training_and_scoring_read_one_table_of_features(spark, monkeypatch):
    from dealcast import queries as Q
    from dealcast.operators.monthly import MODEL_FEATURES
    built, seen = [], []

    def features(spark, d):
        built.append(d)
        names = dict.fromkeys(["snapshot_period", "sales_agent", *Q._KEEP, *Q.D.DRIFT_NUMERIC, *Q.D.DRIFT_CATEGORICAL, *MODEL_FEATURES])
        return spark.range(1).select(*[F.lit(0).alias(c) for c in names])

    class Run:
        def score(self, rows):
            return rows.withColumns({"prediction": F.lit(0.5), "prediction_binary": F.lit(1)})

    monkeypatch.setattr(Q.D, "model_features", features)
    monkeypatch.setattr(Q, "_trained", lambda spark, d, rows=None: seen.append(rows) or Run())
    assert Q.q_m11(spark, "x").count() == 1
    assert built == ["x"] and seen[0] is not None and set(MODEL_FEATURES) <= set(seen[0].columns)
