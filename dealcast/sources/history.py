"""The history of monitoring results, whatever shape their files have.

A result file is one JSON document. Older files hold their figures at the top,
newer ones nested under ``drift_detection.results``; any field may be missing
and then has the default below. A file that is no JSON document, or whose
fields can't be read, is set apart with its reason and doesn't stop the others.

A file is one row, so it must fit into a task; result files have some kilobytes.
Spark never sees a file without any bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dealcast.sources.layers import latest_by

# The fields of a result and what stands for a missing one.
FIELDS = {"drift_detected": ("boolean", False), "prediction_drift": ("double", 0.0), "num_drifted_columns": ("bigint", 0), "alert_level": ("string", "NONE"),
          "accuracy": ("double", None), "missing_values_share": ("double", 0.0)}
_RESULTS = ", ".join(f"{k}: {t}" for k, (t, _) in FIELDS.items())
SCHEMA = f"timestamp string, current_month string, drift_detection struct<results: struct<{_RESULTS}>>, {_RESULTS.replace(': ', ' ')}, _corrupt string"


def result_files(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """(file, result, reason): each file's parsed document, or why it has none."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True)
    got = files.select(F.col("_metadata.file_path").alias("file"), F.from_json("value", SCHEMA, {"columnNameOfCorruptRecord": "_corrupt"}).alias("result"),
                       F.trim("value").alias("_text"))
    reason = (F.when(F.col("_text").rlike(r"^\s*$"), "empty").when(~F.col("_text").startswith("{"), "no JSON object")
              .when(F.col("result._corrupt").isNotNull() | F.col("result").isNull(), "malformed")
              .when(F.col("result.current_month").isNull(), "no current_month"))
    return got.select("file", "result", reason.alias("reason"))


def result_history(spark: SparkSession, path: str, pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """(trend rows by file, unreadable files with their reason)."""
    files = result_files(spark, path, pattern)

    def field(name: str) -> Column:
        kind, default = FIELDS[name]
        return F.coalesce(F.col(f"result.drift_detection.results.{name}"), F.col(f"result.{name}"), F.lit(default).cast(kind)).alias(name)

    rows = files.where(F.col("reason").isNull()).select(
        "file", F.try_to_timestamp("result.timestamp").alias("timestamp"), F.col("result.current_month").alias("current_month"), *map(field, FIELDS))
    return rows, files.where(F.col("reason").isNotNull()).select("file", "reason")


def trend(history: DataFrame) -> DataFrame:
    """One row a month: the figures of its latest run; of runs at one time, the
    file that sorts last."""
    figures = F.struct("timestamp", *FIELDS)
    order = F.struct("timestamp", "file")
    return latest_by(history, order, figures, by=["current_month"]).select("current_month", "latest.*")
