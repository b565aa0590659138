"""Stored sketches: distinct counts over any range of periods.

A period's row in the sketch layer holds, for each column, the rows, the missing
ones and a HyperLogLog sketch of the values. Summaries of a range of periods
come from these rows alone: counts add up, sketches are united, and no data row
is read again. A union is the sketch of all rows, so its error doesn't grow with
the number of periods.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

LG_K = 14  # the sketch has 2 ** LG_K registers


def relative_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Bound of an estimate's relative error, in standard deviations: a union's
    estimator has one of 1.04 over the root of the registers."""
    return deviations * 1.04 / (1 << lg_k) ** 0.5


def period_sketches(df: DataFrame, cols: Sequence[str], period: str, lg_k: int = LG_K) -> DataFrame:
    """(period, column, rows, missing, sketch): one pass with partial sketches.
    Values are taken as text, so any type goes; a column without values has an
    empty sketch."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    long = df.select(period, F.expr(f"stack({len(cols)}, {pairs}) AS (column, value)"))
    return long.groupBy(period, "column").agg(
        F.count("*").alias("rows"), F.sum(F.col("value").isNull().cast("long")).alias("missing"),
        F.hll_sketch_agg("value", F.lit(lg_k)).alias("sketch"))


def roll_up(sketches: DataFrame, by: Column | str | Sequence[str] = (), period: str = "snapshot_period") -> DataFrame:
    """(by, column, periods, rows, missing, missing_share, distinct): the rows of
    the sketch layer put together, of all periods or of those that ``by`` names
    (an expression of the period, or columns)."""
    by = [by] if isinstance(by, (str, Column)) else list(by)
    g = sketches.groupBy(*by, "column").agg(
        F.countDistinct(period).alias("periods"), F.sum("rows").alias("rows"), F.sum("missing").alias("missing"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))
    return g.withColumn("missing_share", F.col("missing") / F.col("rows"))
