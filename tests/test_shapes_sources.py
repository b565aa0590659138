"""Projection helpers, schema sets, layered storage and encodings."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from dealcast.operators import clean as C
from dealcast.operators.quality import validation_report, validation_score, REQUIRED
from dealcast.plans.features import feature_columns
from dealcast.sources import layers as L


def test_select_existing_and_add_missing(spark):
    df = spark.createDataFrame([(1, None)], "a int, b double")
    sel, missing = C.select_existing(df, ["a", "c"])
    assert sel.columns == ["a"] and missing == ["c"]
    r = C.add_missing_as_zero(df, ["a", "b", "c"]).first()
    assert r["b"] == 0.0 and r["c"] == 0


def test_feature_list_rules():
    cols = ["opportunity_id", "deal_stage", "agent_opportunity_count", "sales_agent", "sales_agent_encoded",
            "close_value", "close_value_scaled", "opportunity_id_encoded", "revenue"]
    got = feature_columns(cols)
    assert "deal_stage" not in got and "sales_agent" not in got and "close_value" not in got
    assert "agent_opportunity_count" not in got            # matches the id/opportunity substring rule
    assert "opportunity_id_encoded" in got and "revenue" in got and "close_value_scaled" in got


def test_time_slice_and_column_sets(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0),), (dt.datetime(2024, 1, 2, 0, 0),)], "ts timestamp")
    assert C.time_slice(df, "ts", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)).count() == 1
    b = spark.createDataFrame([(1,)], "ts int")
    assert C.common_columns(df, b) == ["ts"]
    assert C.column_differences(df, spark.createDataFrame([(1,)], "x int")) == {"only_left": ["ts"],
                                                                              "only_right": ["x"]}


def test_layer_roundtrip_partition_pruning_and_retention(spark):
    base = tempfile.mkdtemp(prefix="dealcast-layer-")
    df = spark.createDataFrame([("a", "2024-01"), ("b", "2024-02"), ("c", "2024-02")], "x string, snapshot_period string")
    L.write_layer(df, base, "processed")
    one = L.read_layer(spark, base, "processed", "2024-02")
    assert one.count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_period" in plan and "Filter (snapshot_period" not in plan
    assert {r.f.split("snapshot_period=")[1][:7] for r in one.select(F.input_file_name().alias("f")).collect()} == {"2024-02"}
    L.write_layer(df.where("snapshot_period = '2024-01'").withColumn("x", F.lit("z")), base, "processed")
    assert sorted(r["x"] for r in L.read_layer(spark, base, "processed").collect()) == ["b", "c", "z"]
    files = L.list_files(spark, base, "*.parquet")
    plan = L.retention_plan(files, F.lit("processed")).collect()
    assert plan and {r["category"] for r in plan} == {"processed_files"}
    assert L.file_exists(spark, base, "*.parquet")


def test_json_results_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="dealcast-json-")
    df = spark.createDataFrame([("2024-01", 0.12, True)], "cur_period string, prediction_drift double, drift boolean")
    L.append_results(df, d)
    L.append_results(df, d)
    back = L.read_results(spark, d, df.schema)
    assert back.count() == 2 and back.first()["prediction_drift"] == 0.12


def test_validation_report_lines(spark):
    rows = [(f"O{i}", "A", "P", "C", "Won", dt.date(2024, 1, 1), dt.date(2024, 1, 20), 100.0,
             dt.date(2023, 12, 20), "2023-12", dt.date(2024, 1, 31)) for i in range(3)]
    rep = validation_report(validation_score(spark.createDataFrame(rows, REQUIRED))).collect()
    assert len(rep) == 6 and rep[0]["text"].startswith("Overall score: 1.000 (PASS)")
