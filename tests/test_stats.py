"""Distributed running totals and exact quantiles against numpy."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from dealcast.operators.stats import exact_quantiles, running_totals


def _frame(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"g": rng.integers(0, 5, n).astype("int64"),
                        "v": np.round(rng.normal(100, 30, n), 1)})
    pdf.loc[rng.choice(n, 50, replace=False), "v"] = np.nan
    pdf.loc[pdf.g == 4, "v"] = 7.0          # a constant group
    return pdf, spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "g long, v double")


def test_exact_quantiles_match_numpy_linear(spark):
    pdf, df = _frame(spark)
    qs = [0.0, 0.25, 0.5, 0.8, 1.0]
    got = {r["g"]: r for r in exact_quantiles(df, "v", qs, by=["g"], slices=6).collect()}
    for g, part in pdf.dropna().groupby("g"):
        want = np.percentile(part.v.to_numpy(), [q * 100 for q in qs], method="linear")
        for q, w in zip(qs, want):
            assert abs(got[g][f"q{round(q * 100)}"] - w) < 1e-9


def test_running_totals_match_cumsum_with_ties(spark):
    pdf, df = _frame(spark)
    c = df.where(F.col("v").isNotNull()).groupBy("g", "v").agg(F.count("*").alias("n"))
    out = running_totals(c, ["v"], ["n"], by=["g"], slices=5).toPandas()
    for g, part in out.groupby("g"):
        part = part.sort_values("v")
        assert (part["cum_n"].to_numpy() == part["n"].cumsum().to_numpy()).all()


def test_repartitioning_does_not_change_quantiles(spark):
    _, df = _frame(spark)
    a = sorted(exact_quantiles(df, "v", [0.5], by=["g"]).collect())
    b = sorted(exact_quantiles(df.repartition(13), "v", [0.5], by=["g"], slices=3).collect())
    assert a == b
