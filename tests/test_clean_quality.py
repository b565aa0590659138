"""Cleaning, validation and quality checks on small literal frames (the
reference tests' fixtures and expectations)."""

import datetime as dt

from pyspark.sql import functions as F

from dealcast.operators import clean as C
from dealcast.operators import quality as Q
from dealcast.operators.encode import frequency_encode, label_codes, standard_scale
from dealcast.operators.joins import attach_group_stats


def test_standard_names():
    assert C.standard_name(" Deal Stage ") == "deal_stage"
    assert C.standard_name("Close-Value (USD)") == "close_value"
    assert C.standard_name("Region.Name") == "region_name"


def test_missing_values_counts(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (None, "b", 2.0), (3, None, 3.0), (4, "d", 4.0)],
                               "a int, b string, c double")
    got = {r["column"]: r["missing"] for r in Q.missing_values(df).collect()}
    assert got == {"a": 1, "b": 1, "c": 0}


def test_iqr_outlier(spark):
    df = spark.createDataFrame([(float(x),) for x in list(range(1, 10)) + [100]], "v double")
    r = Q.iqr_outliers(df, "v").first()
    assert r["outliers"] == 1 and r["upper_fence"] < 100


def test_invalid_dates(spark):
    df = spark.createDataFrame([("2024-01-01",), ("invalid",), (None,)], "d string")
    assert Q.invalid_dates(df, "d").first()["invalid_dates"] == 1


def test_agent_average(spark):
    df = spark.createDataFrame([("Agent1", 1000.0), ("Agent1", 1500.0), ("Agent2", 2000.0), ("Agent2", 3000.0)],
                               "sales_agent string, close_value double")
    out = attach_group_stats(df, ["sales_agent"], {"avg_value": F.avg("close_value")})
    assert {r["sales_agent"]: r["avg_value"] for r in out.collect()}["Agent1"] == 1250.0


def test_scaling_population_std(spark):
    df = spark.createDataFrame([(1000.0, 0.1), (2000.0, 0.2), (3000.0, 0.3)], "a double, b double")
    out = standard_scale(df, ["a", "b"]).agg(F.stddev_pop("a_scaled"), F.avg("a_scaled")).first()
    assert abs(out[0] - 1.0) < 1e-9 and abs(out[1]) < 1e-9
    const = spark.createDataFrame([(5.0,), (5.0,)], "a double")
    assert [r[0] for r in standard_scale(const, ["a"]).select("a_scaled").collect()] == [0.0, 0.0]


def test_label_codes_lexicographic(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "x string")
    lo = {r["x"]: r["x_encoded"] for r in label_codes(df, "x").collect()}
    hi = {r["x"]: r["x_encoded"] for r in label_codes(df, "x", high_cardinality=True).collect()}
    assert lo == hi == {"a": 0, "b": 1, "c": 2, None: 3}  # null is the last class


def test_frequency_encode(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "x string")
    got = {r["x"]: r["x_frequency"] for r in frequency_encode(df, "x").collect()}
    assert got == {"a": 0.5, "b": 0.25, "c": 0.25}


def test_fill_median_over_closed_only(spark):
    df = spark.createDataFrame([("Won", 10.0), ("Lost", 20.0), ("Engaging", 1000.0), ("Prospecting", None)],
                               "deal_stage string, close_value double")
    out = C.fill_numeric_median(df, ["close_value"]).collect()
    assert out[3]["close_value"] == 15.0


def test_mixed_nulls_by_type(spark):
    df = spark.createDataFrame([(1.0, "x", dt.date(2024, 1, 1)), (None, None, None)], "n double, t string, d date")
    r = C.fill_nulls_by_type(df, date="2000-01-01").collect()[1]
    assert r["n"] == 0.0 and r["t"] == "Unknown" and r["d"] == dt.date(2000, 1, 1)


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5",), ("x",)], "v string")
    assert [r[0] for r in C.coerce_numeric(df, ["v"]).collect()] == [1.5, None]


def test_empty_table_is_invalid(spark):
    df = spark.createDataFrame([], Q.REQUIRED)
    # a global aggregate over no rows still yields one row
    r = Q.schema_check(df).first()
    assert r["rows"] == 0 and r["is_valid"] is False


def test_clean_table_scores_one(spark):
    rows = [(f"O{i}", "A", "P", "C", "Won", dt.date(2024, 1, 1), dt.date(2024, 1, 20), 100.0 + i,
             dt.date(2023, 12, 20), "2023-12", dt.date(2024, 1, 31)) for i in range(20)]
    df = spark.createDataFrame(rows, Q.REQUIRED)
    r = Q.validation_score(df).first()
    assert r["score"] == 1.0 and r["overall_passed"]
    assert Q.ingestion_score(df).first()["quality_score"] == 1.0


def test_schema_issues_and_column_sets(spark):
    df = spark.createDataFrame([("1", 2)], "opportunity_id string, close_value long")
    iss = Q.schema_issues(df)
    assert "sales_agent" in iss["missing"] and iss["types"] == [] and iss["extra"] == []


def test_quality_suite_duplicate_and_constant_columns(spark):
    df = spark.createDataFrame([(1, 1, 5, "x"), (2, 2, 5, "y"), (2, 2, 5, "y")], "a int, b int, c int, d string")
    r = Q.quality_suite(df).first()
    assert r["duplicated_columns"] == 1 and r["constant_columns"] == 1 and r["duplicated_rows"] == 1
