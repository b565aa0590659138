"""One training run and what lives on it: scoring and monitoring by the best
model (M3-M13, D1, D2, D13-D18).

``train`` fits the candidates once and writes, under one version, the test rows'
scores of each candidate, the ranked metrics, the monitoring thresholds and the
best model. Everything later loads these: batch scores of any rows, the scored
reference and current periods of the drift plan, and the alerts that compare a
period's quality with the thresholds. Nothing is fitted twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from dealcast.operators import drift as DR
from dealcast.operators import models as M
from dealcast.operators.monthly import MODEL_FEATURES


@dataclass(frozen=True)
class TrainedRun:
    """A version's folder."""
    spark: SparkSession
    path: str

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    @property
    def metrics(self) -> DataFrame:
        """model, accuracy, roc_auc, brier, n, rank, is_best: a row a candidate."""
        return self._table("metrics")

    @property
    def test_scores(self) -> DataFrame:
        """model, opportunity_id, label, prediction of the test rows."""
        return self._table("test_scores")

    @property
    def thresholds(self) -> DataFrame:
        return self._table("thresholds")

    def best_model(self) -> M.CalibratedModel:
        name = self.metrics.where("is_best").first().model  # a row a candidate
        return M.load_calibrated(f"{self.path}/model", name)

    def score(self, rows: DataFrame, features: Sequence[str] = MODEL_FEATURES, label: str = "is_won", threshold: float = 0.5) -> DataFrame:
        """``rows`` with prediction, prediction_binary and
        monitoring_timestamp by the best model; a missing feature counts as 0
        for the model and stays missing in the row."""
        filled = rows.withColumns({f"_f_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
        ready = M.assembler([f"_f_{c}" for c in features]).transform(filled)
        return M.score_batch(self.best_model(), ready, threshold).drop("features", *[f"_f_{c}" for c in features])


def train(data: DataFrame, path: str, names: Sequence[str] | None = None, key: str = "opportunity_id") -> TrainedRun:
    """Fit the candidates (all, or those named) on the rows of ``data`` (see
    ``models.prepare``) whose split is train, and write the run to ``path``."""
    spark = data.sparkSession
    test = data.where(F.col("split") == "test")
    cands = M.candidates()
    rows = data.where(F.col("split") == "train")
    models = M.fit_all({name: cands[name] for name in names or cands}, rows, partitions=M.fit_partitions(rows))
    for name in models:
        scores = models[name].predict(test).select(F.lit(name).alias("model"), key, "label", "prediction")
        scores.write.mode("overwrite").parquet(f"{path}/test_scores/of={name}")
    run = TrainedRun(spark, path)
    M.rank_models(run.test_scores).write.mode("overwrite").parquet(f"{path}/metrics")
    M.monitoring_thresholds(run.metrics).write.mode("overwrite").parquet(f"{path}/thresholds")
    M.save_model(models[run.metrics.where("is_best").first().model], f"{path}/model")
    return run


def monitored_quality(scored: DataFrame, thresholds: DataFrame, period: str = "snapshot_period", label: str = "is_won") -> DataFrame:
    """D18 by M13's thresholds, a row a period: the quality of the scores of
    closed rows, which of the three figures is worse than its threshold, and
    whether any is. A figure that can't be computed (one class only) is no alert."""
    from dealcast.operators.stats import attach_row
    closed = scored.where(F.col("deal_stage").isin("Won", "Lost"))
    q = DR.classification_quality(closed, label, "prediction", by=[period]).select(period, "n", "accuracy", "roc_auc", "brier")
    t = attach_row(q, thresholds.withColumnRenamed("model", "scored_by"))
    low = {"accuracy_alert": F.col("accuracy") < F.col("accuracy_threshold"), "roc_auc_alert": F.col("roc_auc") < F.col("roc_auc_threshold"),
           "brier_alert": F.col("brier") > F.col("brier_threshold")}
    t = t.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in low.items()})
    return t.withColumn("performance_drift", F.col("accuracy_alert") | F.col("roc_auc_alert") | F.col("brier_alert"))


def model_drift(scored: DataFrame, numeric: Sequence[str], categorical: Sequence[str], period: str = "snapshot_period", quality: DataFrame | None = None) -> DataFrame:
    """D13-D17 over scored rows: every period against the one before it."""
    return DR.monitoring_summary(scored, period, DR.consecutive_pairs(scored, period), numeric, categorical, quality=quality)
