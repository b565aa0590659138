"""One training run: what is written is what SQL says, and all later steps load it."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dealcast.operators import models as M
from dealcast.plans import modelling as P


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(4)
    n = 900
    x = rng.normal(0, 1, n)
    pdf = pd.DataFrame({"opportunity_key": np.arange(n, dtype="int64"), "opportunity_id": [f"o{i}" for i in range(n)], "x1": x, "x2": rng.normal(0, 1, n),
                        "is_won": (x + rng.normal(0, 0.7, n) > 0).astype("int64"), "snapshot_period": [f"2024-0{1 + i % 3}" for i in range(n)],
                        "deal_stage": ["Engaging" if i % 10 == 0 else "Won" if x[i] > 0 else "Lost" for i in range(n)],
                        "kind": ["abc"[i % 3] for i in range(n)], "split": ["test" if i % 4 == 0 else "train" for i in range(n)]})
    return spark.createDataFrame(pdf)


@pytest.fixture(scope="module")
def run(frame, tmp_path_factory):
    return P.train(M.prepare(frame, ["x1", "x2"]), str(tmp_path_factory.mktemp("run") / "v1"), names=["logistic_regression", "boosted_trees"])


def test_metrics_rank_and_thresholds_by_sql_over_the_written_scores(run):
    sql = f"""
    WITH s AS (SELECT * FROM read_parquet('{run.path}/test_scores/*/*.parquet', hive_partitioning = false)),
    a AS (SELECT model, count(*) AS n, avg(CAST((prediction >= 0.5) = (label = 1) AS INTEGER)) AS accuracy, avg((prediction - label) * (prediction - label)) AS brier FROM s GROUP BY 1),
    u AS (SELECT p.model, avg(CASE WHEN p.prediction > q.prediction THEN 1.0 WHEN p.prediction = q.prediction THEN 0.5 ELSE 0 END) AS roc_auc
          FROM s p JOIN s q ON p.model = q.model AND p.label = 1 AND q.label = 0 GROUP BY 1),
    r AS (SELECT a.*, roc_auc, row_number() OVER (ORDER BY roc_auc DESC, a.model) AS rank FROM a JOIN u ON a.model = u.model)
    SELECT *, rank = 1 AS is_best, greatest(0.75, roc_auc * 0.95) AS t_auc, least(0.25, brier * 1.1) AS t_brier, greatest(0.7, accuracy * 0.95) AS t_acc FROM r"""
    want = {r.model: r for r in duckdb.sql(sql).df().itertuples()}
    got = {r.model: r for r in run.metrics.collect()}
    assert got.keys() == want.keys() == {"logistic_regression", "boosted_trees"}
    for m, r in got.items():
        w = want[m]
        assert (r.n, r["rank"], r.is_best) == (w.n, w.rank, w.is_best)
        assert np.allclose([r.accuracy, r.brier, r.roc_auc], [w.accuracy, w.brier, w.roc_auc], atol=1e-12)
    t = run.thresholds.collect()
    assert len(t) == 1 and got[t[0].model].is_best
    w = want[t[0].model]
    assert np.allclose([t[0].roc_auc_threshold, t[0].brier_threshold, t[0].accuracy_threshold], [w.t_auc, w.t_brier, w.t_acc], atol=1e-12)


def test_the_loaded_best_model_gives_the_written_scores(run, frame):
    best = run.metrics.where("is_best").first().model
    written = {r.opportunity_id: r.prediction for r in run.test_scores.where(F.col("model") == best).collect()}
    scored = run.score(frame, ["x1", "x2"])
    assert set(scored.columns) == {*frame.columns, "prediction", "prediction_binary", "monitoring_timestamp"}
    got = {r.opportunity_id: r for r in scored.where("split = 'test'").collect()}
    assert got.keys() == written.keys() and all(abs(got[k].prediction - written[k]) < 1e-9 for k in written)
    assert all(r.prediction_binary == int(r.prediction >= 0.5) for r in got.values())


def test_missing_features_count_as_zero_and_stay_missing(run, spark):
    rows = spark.createDataFrame([("a", None, 0.0), ("b", 0.0, None), ("c", 0.0, 0.0)], "opportunity_id string, x1 double, x2 double")
    got = {r.opportunity_id: r for r in run.score(rows, ["x1", "x2"]).collect()}
    assert got["a"].prediction == got["b"].prediction == got["c"].prediction and got["a"].x1 is None


def test_thresholds_drive_the_alerts(run, frame, spark):
    scored = run.score(frame, ["x1", "x2"])
    spoiled = scored.withColumn("prediction", F.when(F.col("snapshot_period") == "2024-02", 1 - F.col("prediction")).otherwise(F.col("prediction")))
    q = {r.snapshot_period: r for r in P.monitored_quality(spoiled, run.thresholds).collect()}
    assert q["2024-02"].performance_drift and q["2024-02"].roc_auc_alert and q["2024-02"].accuracy_alert and q["2024-02"].brier_alert
    assert all(r.n == 270 and r.scored_by == run.thresholds.first().model for r in q.values())
    for r in q.values():
        t = run.thresholds.first()
        assert (r.accuracy_alert, r.roc_auc_alert, r.brier_alert) == (r.accuracy < t.accuracy_threshold, r.roc_auc < t.roc_auc_threshold, r.brier > t.brier_threshold)
    one = scored.where("snapshot_period = '2024-01' AND is_won = 1")
    assert P.monitored_quality(one, run.thresholds).first().roc_auc is None  # one class: no figure, no alert
    drift = {r.cur_period: r for r in P.model_drift(spoiled, ["x1", "x2"], ["kind"]).collect()}
    plain = {r.cur_period: r for r in P.model_drift(scored, ["x1", "x2"], ["kind"]).collect()}
    assert drift.keys() == {"2024-02", "2024-03"} and drift["2024-02"].roc_auc < 0.5 < plain["2024-02"].roc_auc


def test_calibration_cells_bound_the_isotonic_fit(spark):
    rng = np.random.default_rng(5)
    held = spark.createDataFrame(pd.DataFrame({"score": np.concatenate([rng.random(5000), [0.0, 1.0, 1.0]]), "label": rng.integers(0, 2, 5003).astype(float)}))
    few = M.score_cells(held, 100).collect()
    assert len(few) == 100 and sum(r._w for r in few) == 5003
    assert abs(sum(r._w * r.label for r in few) - held.agg(F.sum("label")).first()[0]) < 1e-6
    assert abs(sum(r._w * r.score for r in few) - held.agg(F.sum("score")).first()[0]) < 1e-6
    scores = sorted(r.score for r in few)
    assert all(int(s * 100) == k or k == 99 for k, s in enumerate(scores))
