"""Operators against values worked out by hand from their rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dealcast.functions import scalar as S
from dealcast.operators import aggregates as A, clean as C, drift, encode, quality as Q, reports, windows as W


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


DEALS = [("o1", "ann", "acme", "Won", 100.0, dt.date(2024, 1, 5)), ("o2", "ann", "acme", "Lost", 0.0, dt.date(2024, 1, 9)),
         ("o3", "ann", "acme", "Engaging", None, dt.date(2024, 1, 20)), ("o4", "bob", "bits", "Won", 2000.1256, dt.date(2024, 2, 1)),
         ("o5", "bob", "bits", "Prospecting", None, None)]


@pytest.fixture(scope="module")
def deals(spark):
    return spark.createDataFrame(DEALS, "opportunity_id string, sales_agent string, account string, deal_stage string, close_value double, engage_date date")


def test_a3_counts_closed_deals_only_and_rounds(deals):
    assert rows(A.account_performance(deals), "account", "account_win_rate", "account_value", "account_deals") == [
        ("acme", 0.5, 100.0, 2), ("bits", 1.0, 2000.126, 1)]


def test_a5_counts_open_deals_too(deals):
    assert rows(A.monthly_pattern(deals), "engage_month", "deals", "wins", "win_rate", "avg_value") == [
        (1, 3, 1, 0.333, 50.0), (2, 1, 1, 1.0, 2000.126)]


def test_a6_bands_and_the_overwrite_order_of_the_fallback(spark, deals):
    assert rows(A.win_rate_by_band(deals), "value_band", "deals", "win_rate") == [("Medium", 1, 1.0), ("Small", 2, 0.5)]
    ten = spark.createDataFrame([("Won" if i % 2 else "Lost", float(i)) for i in range(1, 11)] + [("Engaging", None)], "deal_stage string, close_value double")
    # cuts at 4.6 and 6.4: Very Low becomes Low, Very High becomes High, 5 and 6 and the null stay Medium
    assert rows(A.win_rate_by_quartile(ten), "value_category", "deals") == [("High", 4), ("Low", 4), ("Medium", 3)]


def test_a7_having_counts_all_rows(deals):
    assert rows(A.agent_stats(deals, min_deals=3), "sales_agent", "deals") == [("ann", 3)]


def test_a16_each_outcome_is_a_density_of_its_own(spark):
    d = spark.createDataFrame([("Won", float(v)) for v in (0, 1, 2, 10)] + [("Lost", float(v)) for v in (100, 300)], "deal_stage string, v double")
    got = A.histogram(d, "v", bins=2, split="deal_stage")
    assert rows(got, "deal_stage", "bin", "bin_start", "count", "density") == [
        ("Lost", 0, 100.0, 1, 0.005), ("Lost", 1, 200.0, 1, 0.005), ("Won", 0, 0.0, 3, 0.15), ("Won", 1, 5.0, 1, 0.05)]


def test_f4_f17_labels(spark):
    p = spark.createDataFrame([(0.0,), (0.3,), (0.41,), (0.7,), (0.71,), (0.9,), (None,)], "p double")
    assert [tuple(r) for r in p.select(S.probability_band("p"), S.priority("p")).collect()] == [
        (None, "Low Priority - High Risk"), ("Low (0-30%)", "Low Priority - High Risk"), ("Medium (30-60%)", "Medium Priority - Needs Attention"),
        ("High (60-80%)", "Medium Priority - Needs Attention"), ("High (60-80%)", "High Priority Opportunity"),
        ("Very High (80%+)", "High Priority Opportunity"), (None, "Low Priority - High Risk")]


@pytest.mark.parametrize("high", [(), ("c",)])
def test_f23_null_is_the_last_class(spark, high):
    d = spark.createDataFrame([("g", "b"), ("g", None), ("g", "a"), ("g", "b"), ("h", None)], "k string, c string")
    got = encode.label_encode(d, ["c"], by=["k"], high_cardinality=high)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("g", "b", 1), ("g", None, 2), ("g", "a", 0), ("g", "b", 1), ("h", None, 0)], key=str)
    two = encode.label_encode(d.withColumn("e", F.col("c")), ["c", "e"], by=["k"])
    assert {(r.k, r.c, r.c_encoded, r.e_encoded) for r in two.collect()} == {("g", "b", 1, 1), ("g", None, 2, 2), ("g", "a", 0, 0), ("h", None, 0, 0)}


def test_w5_every_stratum_is_cut_at_the_same_share(spark):
    d = spark.range(1000).selectExpr("id key", "case when id % 10 = 0 then 'Won' when id % 3 = 0 then null else 'Lost' end stage")
    got = {(r.stage, r.split): r["count"] for r in W.stratified_split(d, "key", "stage").groupBy("stage", "split").count().collect()}
    assert got == {("Won", "train"): 80, ("Won", "test"): 20, (None, "train"): 240, (None, "test"): 60, ("Lost", "train"): 480, ("Lost", "test"): 120}


def test_t3_filter_does_not_depend_on_the_size(spark):
    d = spark.range(20).selectExpr("id", "id % 2 as won")
    assert {r.won for r in W.seeded_sample(d, 100, "id", where=F.col("won") == 1).collect()} == {1}


def test_stable_hash_is_not_periodic(spark):
    d = spark.createDataFrame([(1,), (1 + 1000003,)], "k long")
    assert d.select(W.stable_hash("k", 42, 1 << 30).alias("h")).distinct().count() == 2


def test_p1_needs_all_words(spark):
    names = {"Opportunity ID": "opportunity_id", "agent_opportunity_count": "agent_opportunity_count", "engage_month": "engage_month",
             "Engage.Date": "engage_date", "Close Value (USD)": "close_value", "value": "value", "Account Name": "account",
             "Sales-Agent": "sales_agent", "Deal Stage": "deal_stage", "product_name": "product"}
    assert {n: C.standard_name(n) for n in names} == names
    with pytest.raises(ValueError):
        C.clean_column_names(spark.createDataFrame([(1, 2)], "`Deal Stage` int, deal_stage int"))


def test_v1_a_null_stage_is_invalid(deals):
    got = Q.schema_check(deals.withColumn("deal_stage", F.when(F.col("opportunity_id") != "o1", F.col("deal_stage")))).first()
    assert got.invalid_stage_rows == 1 and not got.is_valid


def test_v13_gate(spark):
    d = spark.createDataFrame([(1, 1, 5, 1.0, dt.date(2024, 1, 1), None), (0, 1, 5, None, dt.date(2024, 3, 1), None)],
                              "is_won int, is_closed int, sales_cycle_days int, close_value double, engage_date date, close_date date")
    got = Q.training_gate(d).first()
    assert (got.win_rate, got.null_close_value, got.null_close_date, got.span_days, got.warnings, got.passed) == (0.5, 1, 2, 60, 2, False)
    assert Q.training_gate(d.where("close_value is not null")).first().passed
    gone = Q.training_gate(d.drop("close_value", "is_won")).first()
    assert gone.missing_columns == 2 and not gone.passed


def test_v14_an_empty_reference_set_fails(spark):
    s = spark.createDataFrame([("p1", 0.5, 1), ("p2", 1.5, 0)], "period string, prediction double, is_won int")
    groups = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "period string")
    assert rows(Q.reference_set_check(s, by=["period"], groups=groups), "period", "rows", "out_of_range", "passed") == [
        ("p1", 1, 0, True), ("p2", 1, 1, False), ("p3", 0, 0, False)]


def test_m12_an_edge_is_in_the_lower_bin(spark):
    d = spark.createDataFrame([(0.5, 1), (0.51, 0), (0.0, 0), (1.0, 1), (0.3, 1)], "win_probability double, is_won int")
    assert rows(reports.reliability_curve(d), "bin", "count") == [(0, 1), (2, 1), (4, 1), (5, 1), (9, 1)]


def test_d15_health_needs_the_quality_tests(spark):
    suite = spark.createDataFrame([("a", 100, 1, 10, 0, 0, 0), ("b", 200, 1, 22, 0, 0, 0), ("c", 100, 2, 10, 0, 0, 0)],
                                  "p string, rows long, columns_with_missing int, rows_with_missing long, constant_columns int, duplicated_columns int, duplicated_rows long")
    pairs = spark.createDataFrame([("a", "b"), ("b", "c")], "ref_period string, cur_period string")
    assert rows(drift.tests_against_reference(suite, pairs, "p"), "cur_period", "quality_passed") == [("b", True), ("c", False)]


def test_fixed_reference_drift_equals_the_paired_form(spark):
    d = spark.createDataFrame([(p, v, c) for p, vs, c in (("r", [1.0, 2.0, 2.0, 3.0], "x"), ("q", [2.0, 5.0], "y"), ("s", [0.0, 2.5], "x")) for v in vs],
                              "p string, v double, c string")
    ref = F.lit("r")
    ks = rows(drift.fixed_reference_ks(drift.period_counts(d, "p", ["v"], "DOUBLE"), "p", ref), "p", "drift_score")
    # largest gaps: q after 3 (1/2 of q is still to come, 1 of r is there) or before 2; s at 0
    assert ks == [("q", 0.5), ("r", 0.0), ("s", 0.5)]
    js = dict(rows(drift.fixed_reference_js(drift.period_counts(d, "p", ["c"], "STRING"), "p", ref), "p", "drift_score"))
    assert js["r"] == js["s"] == 0.0 and abs(js["q"] - 0.8325546111576977) < 1e-12


def test_isotonic_fit_from_weighted_scores_is_the_same(spark):
    from pyspark.ml.regression import IsotonicRegression
    d = spark.createDataFrame([(s / 10, float((s * 7 + i) % 3 == 0)) for s in range(10) for i in range(5)], "score double, label double")
    plain = IsotonicRegression(featuresCol="score", labelCol="label").fit(d)
    few = d.groupBy("score").agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("w"))
    weighted = IsotonicRegression(featuresCol="score", labelCol="label", weightCol="w").fit(few)
    both = weighted.transform(plain.transform(d.select("score").distinct()).withColumnRenamed("prediction", "a")).collect()
    assert all(abs(r.a - r.prediction) < 1e-12 for r in both)
