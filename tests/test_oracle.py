"""Registered queries against their DuckDB SQL twins on the smallest tables.

The quick set runs by default; ``-m slow`` runs every registered oracle.
"""

import os

import duckdb
import pytest

import __spark_entry__ as E
from dealcast.queries import REGISTRY
from dealcast.testing import compare

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
QUICK = ["binding_opportunities", "c10_snapshots", "a1_agent_performance", "a12_value_quantiles",
         "c3_clean_snapshots", "j4_row_features", "m1_monthly_features", "a8_probability_bands",
         "w2_known_at_engage", "w4_split_with_open", "t3_seeded_sample", "v9_validation_score",
         "v16_quality_suite", "d9_m7_classification_quality", "d12_roc_points", "d19_daily_metrics",
         "s9_s10_json_results", "s4_v4_mixed_encodings", "s1_c5_rescued_lines", "s10_f26_result_history",
         "a13_a20_stored_sketches", "f22_f23_transform_only", "s14_s15_retention_plan", "u2_u3_p3_column_sets", "f19_f21_report_formats"]


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf, t)}.parquet')")
    return c


def _check(spark, sf, con, name):
    got = E.queries()[name](spark, sf).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    why = compare(got, want)
    assert why is None, f"{name}: {why}"


@pytest.mark.parametrize("name", QUICK)
def test_quick_oracles(spark, sf, con, name):
    _check(spark, sf, con, name)


@pytest.mark.slow
@pytest.mark.parametrize("name", sorted({n for n, (_, sql) in REGISTRY.items() if sql} - set(QUICK)))
def test_all_oracles(spark, sf, con, name):
    _check(spark, sf, con, name)


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only = set(REGISTRY) - {n for n, (_, sql) in REGISTRY.items() if sql}
    assert rows_only <= {"m3_m9_model_comparison", "m13_monitoring_thresholds", "m15_feature_importance",
                         "m11_batch_scoring", "d13_model_monitoring"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "win_rate" in df.columns
