"""Wasserstein distance, population stability and counts by period, by hand and
against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealcast.operators import drift as DR
from dealcast.operators.stats import running_totals


def rows_of(spark, samples):
    """samples: {period: {feature: values}} -> one row a value position."""
    out = []
    for period, cols in samples.items():
        n = max(map(len, cols.values()))
        for i in range(n):
            out.append((period, *[float(v[i]) if i < len(v) and v[i] is not None else None for v in cols.values()]))
    names = list(next(iter(samples.values())))
    return spark.createDataFrame(out, ", ".join(["p string", *[f"{c} double" for c in names]])), names


def counts_of(spark, samples):
    df, names = rows_of(spark, samples)
    return DR.paired_counts(DR.period_counts(df, "p", names, "DOUBLE"), "p", DR.consecutive_pairs(df, "p"))


def plain_wasserstein(a, b):
    """Sorted merge of two samples: the area between the steps."""
    at = sorted(set(a) | set(b))
    return sum(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) * (w - v) for v, w in zip(at, at[1:]))


def plain_psi(ref, cur, bins=10):
    s = sorted(ref)
    edges = sorted({s[math.ceil(i * len(s) / bins) - 1] for i in range(1, bins)})
    place = [[sum(e < v for e in edges) for v in x] for x in (ref, cur)]
    total = 0.0
    for k in set(place[0]) | set(place[1]):
        p, q = (max(1e-4, x.count(k) / len(x)) for x in place)
        total += (q - p) * math.log(q / p)
    return total


def test_by_hand(spark):
    got = DR.wasserstein(counts_of(spark, {"a": {"x": [0, 1, 3]}, "b": {"x": [5, 6, 8]}})).first()
    assert abs(got.wasserstein - 5) < 1e-12 and abs(got.normed - 5 / math.sqrt(14 / 9)) < 1e-12
    same = DR.wasserstein(counts_of(spark, {"a": {"x": [2, 2, 2]}, "b": {"x": [2, 2]}})).first()
    assert same.wasserstein == 0 and same.normed == 0
    c = counts_of(spark, {"a": {"x": list(range(1, 11))}, "b": {"x": [1] * 5 + [100] * 5}})
    assert [r.edges for r in DR.reference_bins(c).collect()] == [[float(i) for i in range(1, 10)]]
    want = (0.5 - 0.1) * math.log(5) * 2 + 8 * (1e-4 - 0.1) * math.log(1e-3)
    assert abs(DR.population_stability(c, DR.reference_bins(c)).first().psi - want) < 1e-9


@pytest.mark.parametrize("slices", [2, 7])
def test_against_plain_loops(spark, slices):
    """Ties, unequal sizes, a constant column, values that only one side has."""
    rng = np.random.default_rng(slices)
    samples = {p: {"x": rng.integers(-5, 30, n).tolist(), "y": rng.normal(m, 1, n).round(3).tolist(), "z": [7] * n}
               for p, n, m in (("2024-01", 40, 0), ("2024-02", 60, 1), ("2024-03", 25, -2))}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(slices))
    try:
        c = counts_of(spark, samples)
        w = {(r.ref_period, r.feature): r.wasserstein for r in DR.wasserstein(c).collect()}
        psi = {(r.ref_period, r.feature): r.psi for r in DR.population_stability(c, DR.reference_bins(c)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(w) == len(psi) == 6
    for a, b in (("2024-01", "2024-02"), ("2024-02", "2024-03")):
        for f in "xyz":
            assert abs(w[a, f] - plain_wasserstein(samples[a][f], samples[b][f])) < 1e-9
            assert abs(psi[a, f] - plain_psi(samples[a][f], samples[b][f])) < 1e-9


def test_a_side_without_values(spark):
    c = counts_of(spark, {"a": {"x": [None, None], "y": [1, 2]}, "b": {"x": [1, 2], "y": [3, 4]}})
    assert [r.feature for r in DR.wasserstein(c).collect()] == ["y"]
    assert [r.feature for r in DR.reference_bins(c).collect()] == ["y"]
    assert [r.feature for r in DR.population_stability(c, DR.reference_bins(c)).collect()] == ["y"]


def test_period_drift_equals_tagged_drift(spark):
    """One count by period gives what the doubled rows give."""
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(f"2024-0{1 + i % 4}", float(rng.normal()), None if i % 9 == 0 else "uvw"[int(rng.integers(0, 3))]) for i in range(400)],
                               "p string, x double, c string")
    pairs = DR.consecutive_pairs(df, "p")
    want = {(r.cur_period, r.feature): r.drift_score for r in DR.column_drift(DR.sides(df, "p", pairs), ["x"], ["c"]).collect()}
    got = {(r.cur_period, r.feature): r.drift_score for r in DR.period_drift(df, "p", pairs, ["x"], ["c"]).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_the_following_value_crosses_slices(spark, slices):
    df = spark.range(50).select((F.col("id") * 3).cast("double").alias("v"), (F.col("id") % 2).alias("g"), F.lit(1).alias("n"))
    got = running_totals(df, ["v"], ["n"], by=["g"], slices=slices, following="after").collect()
    assert all(r.after == (r.v + 6 if r.v + 6 <= 147 else None) for r in got) and len(got) == 50
