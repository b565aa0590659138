"""Layered storage: CSV/Parquet/JSON scans and sinks.

A dataset layer (raw / processed / features / monitoring) is one Parquet
dataset partitioned by ``snapshot_period``: choosing a month is a partition
filter that Spark prunes at planning time, writes replace only the
partitions present in the data (dynamic partition overwrite), and listing or
classifying files is a DataFrame over file metadata. Object stores are just
``s3a://`` paths to the same readers and writers.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# Layer names, source files kept by retention, and the
# retention categories.
LAYERS = ("raw", "processed", "features", "monitoring", "monitoring_reports")
SOURCE_FILES = ("accounts.csv", "products.csv", "sales_pipeline.csv", "sales_teams.csv",
                "data_dictionary.csv")
RETENTION_CATEGORIES = ("processed_files", "feature_files", "monitoring_files", "prediction_files",
                        "temp_files")


def layer_path(base: str, layer: str) -> str:
    return os.path.join(base, layer)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             encoding: str = "utf-8", header: bool = True) -> DataFrame:
    """CSV scan with an explicit schema (no inference pass);
    malformed fields become null (PERMISSIVE)."""
    r = spark.read.option("header", header).option("encoding", encoding).option("mode", "PERMISSIVE")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", False)
    return r.csv(path)


def write_layer(df: DataFrame, base: str, layer: str, partition_by: Sequence[str] = ("snapshot_period",),
                fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write a layer partitioned by period; an overwrite replaces
    only the periods present in ``df`` (dynamic partition overwrite, for this
    write alone). Rows are rebalanced by period first: a period's rows come
    together in files of the advisory size, and a large period in several."""
    path = layer_path(base, layer)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)
    return path


def read_layer(spark: SparkSession, base: str, layer: str, period: str | None = None,
               fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Scan a layer; ``period`` is a partition filter (pruned)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    df = r.load(layer_path(base, layer))
    return df.where(F.col("snapshot_period") == period) if period is not None else df


def append_results(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Append result rows. For rows that a second run may bring again, see
    ``committed.CommittedTable``."""
    df.write.mode("append").format(fmt).save(path)


def read_results(spark: SparkSession, path: str, schema: StructType, fmt: str = "json") -> DataFrame:
    """Typed scan of stored results (no schema inference)."""
    return spark.read.schema(schema).format(fmt).load(path)


def latest_period(df: DataFrame, period: str = "snapshot_period") -> DataFrame:
    """The latest period (one row)."""
    return df.agg(F.max(period).alias("latest_period"))


def latest_by(df: DataFrame, order: Column | str, value: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """The value of the latest row by ``order`` (``max_by``)."""
    v, o = (F.col(x) if isinstance(x, str) else x for x in (value, order))
    return df.groupBy(*by).agg(F.max_by(v, o).alias("latest"))


def available_periods(df: DataFrame, date: str = "engage_date") -> DataFrame:
    """Distinct ``yyyy-MM`` periods of a date column."""
    p = F.date_format(F.col(date), "yyyy-MM").alias("period")
    return df.select(p).where(F.col("period").isNotNull()).distinct()


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """File listing as a DataFrame (path, name, size, modified). The
    file contents are never read: only metadata columns are selected."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").load(path))
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"),
                        F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def file_exists(spark: SparkSession, path: str, pattern: str = "*") -> bool:
    """S14 (exists): one bounded probe."""
    return len(list_files(spark, path, pattern).limit(1).collect()) == 1


def retention_plan(files: DataFrame, layer: Column | None = None) -> DataFrame:
    """Classify generated files into the five cleanup categories; the
    original source files are kept. Input: ``list_files`` rows; the layer is
    the parent folder name. The plan is a table - deleting is left to the
    caller (dry run by default)."""
    name = F.col("name")
    layer = layer if layer is not None else F.element_at(F.split("path", "/"), -2)
    cat = (F.when((layer == "raw") & ~name.isin(*SOURCE_FILES)
                  & (name.contains("enhanced") | name.contains("processed")), "processed_files")
           .when(layer == "processed", "processed_files")
           .when((layer == "features") & name.contains("reference_data"), "monitoring_files")
           .when((layer == "features") & name.contains("prediction"), "prediction_files")
           .when(layer == "features", "feature_files")
           .when(layer == "monitoring", "monitoring_files")
           .when(layer == "temp", "temp_files"))
    return files.withColumns({"layer": layer, "category": cat}).where(F.col("category").isNotNull())
