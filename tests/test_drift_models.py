"""Drift distances and model operators."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from dealcast.operators import drift as DR


def _pair(spark, ref, cur, name="x"):
    pdf = pd.concat([pd.DataFrame({"period": "a", name: ref}), pd.DataFrame({"period": "b", name: cur})])
    df = spark.createDataFrame(pdf)
    return DR.sides(df, "period", DR.consecutive_pairs(df, "period"))


def test_self_drift_is_zero(spark):
    x = np.random.default_rng(42).normal(0, 1, 200)
    t = _pair(spark, x, x)
    assert DR.numeric_drift(t, ["x"]).first()["drift_score"] == 0.0
    c = _pair(spark, np.array(["a", "b", "b"] * 10), np.array(["a", "b", "b"] * 10))
    assert abs(DR.categorical_drift(c, ["x"]).first()["drift_score"]) < 1e-12


def test_shifted_normal_drifts(spark):
    rng = np.random.default_rng(42)
    t = _pair(spark, rng.normal(0, 1, 100), rng.normal(1, 1, 100))
    r = DR.numeric_drift(t, ["x"]).first()
    assert r["drifted"] and r["drift_score"] > 0.2


def test_prediction_drift_beta(spark):
    rng = np.random.default_rng(42)
    t = _pair(spark, rng.beta(2, 2, 1000), rng.beta(5, 2, 1000), "prediction")
    assert DR.numeric_drift(t, ["prediction"]).first()["drift_score"] > 0.1


def test_ks_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 20, 300).astype(float), rng.integers(3, 25, 200).astype(float)
    grid = np.union1d(a, b)
    want = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    got = DR.numeric_drift(_pair(spark, a, b), ["x"]).first()["drift_score"]
    assert abs(got - want) < 1e-12


def test_auc_exact_mann_whitney(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) * 0.5 + y * 0.3, 2)   # ties on purpose
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    df = spark.createDataFrame(pd.DataFrame({"y": y.astype("int64"), "p": s}))
    got = DR.classification_quality(df, "y", "p").first()["roc_auc"]
    assert abs(got - want) < 1e-12


def test_alert_levels(spark):
    df = spark.createDataFrame([(True, 0.0, 0), (False, 0.15, 0), (False, 0.0, 6), (False, 0.0, 3), (False, 0.0, 1)],
                               "d boolean, p double, n int")
    got = [r[0] for r in df.select(DR.alert_level(F.col("d"), F.col("p"), F.col("n"))).collect()]
    assert got == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "NONE"]


def test_calibrated_model_planted_signal(spark):
    from dealcast.operators import models as M
    rng = np.random.default_rng(42)
    n = 600
    x1 = rng.normal(0, 1, n)
    y = (x1 + rng.normal(0, 0.5, n) > 0).astype("int64")
    pdf = pd.DataFrame({"opportunity_key": np.arange(n, dtype="int64"), "x1": x1, "x2": rng.normal(0, 1, n),
                        "is_won": y})
    data = M.prepare(spark.createDataFrame(pdf), ["x1", "x2"])
    train, test = data.where("opportunity_key % 5 != 0"), data.where("opportunity_key % 5 = 0")
    cal = M.fit_calibrated("lr", M.candidates()["logistic_regression"], train)
    pred = cal.predict(test)
    lo, hi = pred.agg(F.min("prediction"), F.max("prediction")).first()
    assert 0.0 <= lo <= hi <= 1.0
    assert M.evaluate(pred).first()["roc_auc"] > 0.8
