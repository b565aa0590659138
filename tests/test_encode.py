"""Label encoding: the shared code table of bounded columns equals per-column codes."""

import pandas as pd

from dealcast.operators.encode import label_codes, label_encode


def _frame(spark):
    rows = [("p1", "a", "x", "u1"), ("p1", "b", None, "u2"), ("p1", "a", "y", "u3"),
            ("p2", "c", "x", "u1"), ("p2", None, "z", "u4"), ("p2", "c", "x", "u5"),
            ("p2", "b", "y", "u6")]
    return spark.createDataFrame(rows, "g string, a string, b string, id string")


def test_stacked_codes_equal_per_column_codes(spark):
    df = _frame(spark)
    got = label_encode(df, ["a", "b", "id"], by=["g"], high_cardinality=["id"]).toPandas()
    assert list(got.columns) == ["g", "a", "b", "id", "a_encoded", "b_encoded", "id_encoded"]
    for c in ("a", "b", "id"):
        want = label_codes(df, c, by=["g"], high_cardinality=(c == "id")).toPandas()
        m = got[["g", c, f"{c}_encoded"]].merge(want, on=["g", c], how="left", suffixes=("", "_want"))
        pd.testing.assert_series_equal(m[f"{c}_encoded"].astype("float"),
                                       m[f"{c}_encoded_want"].astype("float"), check_names=False)
    # codes are dense per group in value order; null is the class after all values
    assert got.loc[(got.g == "p2") & (got.a == "c"), "a_encoded"].unique().tolist() == [1]
    assert got.loc[got.b.isna(), "b_encoded"].tolist() == [2]


def test_a_missing_label_has_one_code_in_training_and_scoring(spark):
    """J8 gives null the class that F23 gives it: the last one."""
    from dealcast.operators.joins import enrich_new_records
    schema = "sales_agent string, product string, account string, manager string, regional_office string, sector string, is_won int, close_value double, engage_date date"
    import datetime as dt
    day = dt.date(2024, 1, 2)
    hist = spark.createDataFrame([("a", "p", "x", "m", None, "s", 1, 1.0, day), ("b", "q", "y", None, "r", None, 0, 2.0, day)], schema)
    new = spark.createDataFrame([("a", None, "x", "m", None, "s", None, 1.0, day), ("b", "zz", None, None, "r", None, None, 2.0, day)], schema)
    got = {r.sales_agent: r for r in enrich_new_records(new, hist).collect()}
    assert (got["a"].product_encoded, got["a"].regional_office_encoded, got["a"].sector_encoded, got["a"].manager_encoded) == (2, 1, 0, 0)
    assert (got["b"].product_encoded, got["b"].account_encoded, got["b"].sector_encoded, got["b"].manager_encoded) == (0, 2, 1, 1)
