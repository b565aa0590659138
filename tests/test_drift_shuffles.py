"""Drift over the features layer: what is counted is shuffled once, narrow, and the stand-in score needs no join of its own."""

import pytest
from pyspark.sql import functions as F

from dealcast.operators import drift as DR, stats
from dealcast.operators.reports import laplace_rate, smoothed_win_rate
from dealcast.plans.features import create_features
from test_feature_shuffles import BY, accounts, exchanges, opps, plain_plans, teams  # noqa: F401


@pytest.fixture(scope="module")
def values(spark):
    rows = [(f"p{i % 3}", i % 5 if i % 7 else None, i * 10 ** 9, i % 2, float(i % 4) if i % 5 else None) for i in range(90)]
    return spark.createDataFrame(rows, "p string, small int, big long, flag short, x double")


def nodes(df, name):
    def walk(p):
        return (name in p.nodeName()) + sum(walk(p.children().apply(i)) for i in range(p.children().size()))
    return walk(df._jdf.queryExecution().executedPlan())


def test_win_counts_are_those_of_the_rows_with_repeated_and_missing_names(opps, teams, accounts):  # noqa: F811
    f = create_features(opps, teams, accounts, BY, win_counts=True)
    wins, closed = (F.coalesce(F.col(c), F.lit(0)) for c in ("_wins", "_closed"))
    got = smoothed_win_rate(f.withColumn("own", laplace_rate(wins, closed)), "sales_agent", by=BY)
    assert got.count() > 200 and got.where(~F.col("own").eqNullSafe(F.col("win_probability"))).count() == 0
    assert got.where("sales_agent IS NULL").count() > 0 and got.select("own").distinct().count() > 5


def test_values_are_counted_as_numbers_and_named_after(values, plain_plans):  # noqa: F811
    got = DR.period_counts(values, "p", ["small", "big", "flag"], "STRING")
    shuffles = exchanges(got)
    assert len(shuffles) == 1 and "feature" not in shuffles[0][0], shuffles
    want = {(r.p, c, str(r[c])) for r in values.collect() for c in ("small", "big", "flag") if r[c] is not None}
    assert {(r.p, r.feature, r.value) for r in got.collect()} == want
    assert got.agg(F.sum("n")).first()[0] == values.select(F.count("small") + F.count("big") + F.count("flag")).first()[0]
    assert {r.value for r in DR.period_counts(values, "p", ["x"], "STRING").collect()} == {"0.0", "1.0", "2.0", "3.0"}


def test_pairs_meet_in_one_pass_over_the_counts(values, plain_plans):  # noqa: F811
    pairs = DR.consecutive_pairs(values, "p")
    paired = DR.paired_counts(DR.period_counts(values, "p", ["small"], "DOUBLE"), "p", pairs)
    assert sum("_column" in e[0] for e in exchanges(paired)) == 1
    counts = {}
    for r in values.where("small IS NOT NULL").collect():
        counts[r.p, float(r.small)] = counts.get((r.p, float(r.small)), 0) + 1
    want = {(a, b, v): (counts.get((a, v), 0), counts.get((b, v), 0)) for a, b in (("p0", "p1"), ("p1", "p2")) for v in map(float, range(5))}
    assert {(r.ref_period, r.cur_period, r.value): (r.n_ref, r.n_cur) for r in paired.collect()} == want


def test_several_quantiles_read_their_rows_once(values, monkeypatch, plain_plans):  # noqa: F811
    seen, real = [], stats.exact_quantiles
    monkeypatch.setattr(stats, "exact_quantiles", lambda df, *a, **k: seen.append(df) or real(df, *a, **k))
    q = stats.exact_quantiles_many(values, [("m", F.col("x"), 0.5), ("h", F.col("small"), 0.8)], by=["p"])
    assert nodes(seen[0], "Scan") == 1
    for r in q.collect():
        plain = values.where(F.col("p") == r.p).select(F.expr("percentile(x, 0.5)"), F.expr("percentile(small, 0.8)")).first()
        assert (r.m, r.h) == pytest.approx(tuple(plain))
