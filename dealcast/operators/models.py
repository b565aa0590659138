"""Win-probability models on ``pyspark.ml``.

Candidates (M3-M5) are fitted with the distributed ``pyspark.ml`` learners.
Calibration (M6) follows 3-fold isotonic calibration with averaging: for each
fold a base model is fitted on the other folds, an isotonic map from its score
to the label is fitted on the held-out fold, and the final probability is the
mean of the three calibrated scores. Folds are a reproducible hash of the id.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from dealcast.operators.drift import classification_quality
from dealcast.operators.windows import stable_hash

# Candidate settings (the reference's learners mapped to Spark's)
# and monitoring-threshold rules.
SEED = 42
FOLDS = 3
PARALLELISM = 12  # fits at a time: the folds of all candidates
ROWS_PER_TASK = 100_000  # training rows of a fit's partition, if there are few
CELLS = 10_000  # cells of the score that a calibration tells apart
THRESHOLD_RULES = {"roc_auc": (0.75, 0.95, "max"), "brier": (0.25, 1.1, "min"), "accuracy": (0.7, 0.95, "max")}


def candidates(label: str = "label", features: str = "features") -> dict:
    """M3-M5: logistic regression (1000 iterations), random forest (M4: 200
    trees), and two boosted-tree learners (deep/fast and shallow/slow)."""
    common = dict(labelCol=label, featuresCol=features)
    return {
        "logistic_regression": LogisticRegression(maxIter=1000, **common),
        "random_forest": RandomForestClassifier(numTrees=200, seed=SEED, **common),
        "boosted_trees_deep": GBTClassifier(maxIter=100, maxDepth=6, stepSize=0.3, seed=SEED, **common),
        "boosted_trees": GBTClassifier(maxIter=100, maxDepth=3, stepSize=0.1, seed=SEED, **common),
    }


def assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def prepare(df: DataFrame, features: Sequence[str], label: str = "is_won") -> DataFrame:
    """Feature vector + double label (nulls in features must be filled first, M2)."""
    return assembler(features).transform(df.withColumn("label", F.col(label).cast("double")))


def positive_probability(model_output: DataFrame, prob_col: str = "probability", out: str = "score") -> DataFrame:
    return model_output.withColumn(out, vector_to_array(F.col(prob_col))[1])


@dataclass
class CalibratedModel:
    """M6: the per-fold base models and isotonic maps."""
    name: str
    folds: list = field(default_factory=list)   # [(base PipelineModel, IsotonicRegressionModel)]

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        cols = []
        cur = df
        for i, (base, iso) in enumerate(self.folds):
            b = base.copy()
            b.setProbabilityCol(f"_prob{i}").setRawPredictionCol(f"_raw{i}").setPredictionCol(f"_pred{i}")
            cur = positive_probability(b.transform(cur), f"_prob{i}", f"_score{i}")
            iso_i = iso.copy().setFeaturesCol(f"_score{i}").setPredictionCol(f"_cal{i}")
            cur = iso_i.transform(cur).drop(f"_prob{i}", f"_raw{i}", f"_pred{i}", f"_score{i}")
            cols.append(F.col(f"_cal{i}"))
        avg = sum(cols, F.lit(0.0)) / len(cols)
        return cur.withColumn(out, avg).drop(*[f"_cal{i}" for i in range(len(self.folds))])


def score_cells(held: DataFrame, cells: int = CELLS) -> DataFrame:
    """(score, label, _w): one row for each of ``cells`` equal cells of the score
    that has rows, with their mean score, mean label and number. The isotonic
    fit collects its pooled blocks to the driver; so there are ``cells`` at most,
    however many rows and scores there are. A score moves by less than 1 / cells."""
    cell = F.least(F.floor(F.col("score") * cells), F.lit(cells - 1))
    return held.groupBy(cell.alias("_cell")).agg(F.avg("score").alias("score"), F.avg("label").alias("label"),
                                                 F.count(F.lit(1)).cast("double").alias("_w")).drop("_cell")


def fit_fold(estimator, train: DataFrame, k: int, key: str = "opportunity_key", folds: int = FOLDS) -> tuple:
    """M6: a base model of all folds but the ``k``-th, and the isotonic map of its scores there."""
    tagged = train.withColumn("_fold", stable_hash(key, SEED, folds))
    base = estimator.fit(tagged.where(F.col("_fold") != k))
    held = positive_probability(base.transform(tagged.where(F.col("_fold") == k)))
    iso = IsotonicRegression(featuresCol="score", labelCol="label", weightCol="_w", predictionCol="_iso",
                             isotonic=True).fit(score_cells(held))
    return base, iso


def fit_calibrated(name: str, estimator, train: DataFrame, key: str = "opportunity_key",
                   folds: int = FOLDS) -> CalibratedModel:
    """Fit ``folds`` base models and isotonic maps (actions: model fits)."""
    return CalibratedModel(name, [fit_fold(estimator, train, k, key, folds) for k in range(folds)])


def fit_partitions(train: DataFrame, rows: int = ROWS_PER_TASK) -> int:
    """In how many partitions ``fit_all`` reads ``train``: of ``rows`` rows each, at most as many as tasks run at once."""
    return max(1, min(train.sparkSession.sparkContext.defaultParallelism, -(-train.count() // rows)))


def fit_all(estimators: dict, train: DataFrame, key: str = "opportunity_key", folds: int = FOLDS,
            parallelism: int = PARALLELISM, partitions: int | None = None) -> dict[str, CalibratedModel]:
    """``fit_calibrated`` of several estimators, ``parallelism`` fits at a time (as the
    cross-validator's): a fit is many short jobs one after the other, which leave most
    of a cluster idle. The rows lie in ``partitions`` (no more partitions than tasks run at once by
    default), so that what a job shuffles for a tree's nodes doesn't grow with the data. A task
    sends its statistics of every node whatever its rows, so a few large partitions are less work
    than many small ones (``fit_partitions``)."""
    rows = train.coalesce(partitions or train.sparkSession.sparkContext.defaultParallelism)
    tasks = [(name, k) for name in estimators for k in range(folds)]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        fit = inheritable_thread_target(train.sparkSession)(lambda task: fit_fold(estimators[task[0]].copy(), rows, task[1], key, folds))
        fitted = dict(zip(tasks, pool.map(fit, tasks, chunksize=1)))
    return {name: CalibratedModel(name, [fitted[name, k] for k in range(folds)]) for name in estimators}


def evaluate(pred: DataFrame, label: str = "label", score: str = "prediction") -> DataFrame:
    """M7: accuracy, exact ROC AUC, Brier (one row)."""
    q = classification_quality(pred.withColumn("_y", F.col(label).cast("int")), "_y", score)
    return q.select("accuracy", "roc_auc", "brier", "n")


def rank_models(scores: DataFrame) -> DataFrame:
    """M7-M9: metrics of each model from its scores of the test rows (model,
    label, prediction), ranked by AUC, ties by name, the best one marked."""
    from pyspark.sql import Window
    q = classification_quality(scores.withColumn("_y", F.col("label").cast("int")), "_y", "prediction", by=["model"])
    w = Window.orderBy(F.desc("roc_auc"), F.asc("model"))  # a handful of rows: one per candidate
    ranked = q.select("model", "accuracy", "roc_auc", "brier", "n").withColumn("rank", F.row_number().over(w))
    return ranked.withColumn("is_best", F.col("rank") == 1)


def monitoring_thresholds(metrics: DataFrame) -> DataFrame:
    """Alert thresholds from the best model's metrics."""
    best = metrics.where(F.col("is_best"))
    out = []
    for m, (floor_, mult, how) in THRESHOLD_RULES.items():
        v = F.col(m) * mult
        out.append((F.greatest(F.lit(floor_), v) if how == "max" else F.least(F.lit(floor_), v)).alias(f"{m}_threshold"))
    return best.select("model", *out)


def feature_importance(model, features: Sequence[str]) -> DataFrame:
    """A tree model's feature importances as ranked rows."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray().tolist()   # one number per feature (the model's own size)
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel | CalibratedModel, path: str) -> None:
    """A pipeline model, or every fold of a calibrated model."""
    if isinstance(model, CalibratedModel):
        for i, (base, iso) in enumerate(model.folds):
            PipelineModel([base, iso]).write().overwrite().save(f"{path}/{model.name}/fold-{i}")
    else:
        model.write().overwrite().save(path)


def load_calibrated(path: str, name: str, folds: int = FOLDS) -> CalibratedModel:
    """The calibrated model that ``save_model`` wrote."""
    return CalibratedModel(name, [tuple(PipelineModel.load(f"{path}/{name}/fold-{i}").stages) for i in range(folds)])


def score_batch(model: CalibratedModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Probability, class and a monitoring timestamp."""
    out = model.predict(df)
    return out.withColumns({"prediction_binary": (F.col("prediction") >= threshold).cast("int"),
                            "monitoring_timestamp": F.current_timestamp()})
