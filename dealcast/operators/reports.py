"""Pipeline reports (A8-A11, A18, A19, M14) on scored opportunities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from dealcast.functions import scalar as S
from dealcast.operators.stats import attach_stats, exact_quantiles
from dealcast.operators.windows import top_k

P = "win_probability"


def laplace_rate(wins: Column, closed: Column) -> Column:
    """``(wins + 1) / (closed + 2)``."""
    return (wins + 1) / (closed + 2)


def smoothed_win_rate(df: DataFrame, key: str = "sales_agent", by: Sequence[str] = (),
                      name: str = P) -> DataFrame:
    """A closed-form stand-in score: Laplace-smoothed win rate of the key over
    its closed deals, ``(wins + 1) / (closed + 2)``. It is what a model
    without features predicts and keeps reports comparable with SQL; a
    fitted model's probability feeds the same report operators."""
    by = list(by)
    closed = F.col("deal_stage").isin("Won", "Lost")
    rate = df.groupBy(*by, key).agg(
        laplace_rate(F.sum(F.when(closed & (F.col("deal_stage") == "Won"), 1).otherwise(0)),
                     F.sum(F.when(closed, 1).otherwise(0))).alias(name))
    return df.join(rate, [*by, key], "left").withColumn(name, F.coalesce(F.col(name), F.lit(0.5)))


def with_expected_revenue(df: DataFrame) -> DataFrame:
    """F16 + F4 + F17 + F18."""
    return df.withColumns({
        "expected_revenue": S.expected_revenue("close_value", P),
        "probability_category": S.probability_band(P),
        "risk_level": S.risk_level(P),
        "priority": S.priority(P),
        "deal_size": S.deal_size("close_value"),
    })


def probability_band_summary(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per probability band - count, mean probability, value and
    expected revenue, rounded to 2 (half-even)."""
    src = with_expected_revenue(df).where(F.col("probability_category").isNotNull())
    return src.groupBy(*by, "probability_category").agg(
        F.count(P).alias("count"), S.rounded_avg(P, 2).alias("avg_probability"),
        S.rounded_sum("close_value", 2).alias("total_value"),
        S.rounded_sum("expected_revenue", 2).alias("expected_revenue"))


def agent_insights(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per agent - pipeline count, mean and total probability, expected
    revenue and value (rounded 3). Sort it where it is shown."""
    src = with_expected_revenue(df).where(F.col("sales_agent").isNotNull())
    return src.groupBy(*by, "sales_agent").agg(
        F.count(P).alias("pipeline_count"), S.rounded_avg(P, 3).alias("avg_win_prob"),
        S.rounded_sum(P, 3).alias("total_win_prob"),
        S.rounded_sum("expected_revenue", 3).alias("expected_revenue"),
        S.rounded_sum("close_value", 3).alias("total_value"))


def pipeline_totals(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A10: rows, value, expected revenue and mean probability."""
    src = with_expected_revenue(df)
    return src.groupBy(*by).agg(F.count("*").alias("opportunities"),
                                F.sum("close_value").alias("total_value"),
                                F.sum("expected_revenue").alias("expected_revenue"),
                                F.avg(P).alias("avg_probability"))


def revenue_by_band(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A11."""
    src = with_expected_revenue(df)
    return src.groupBy(*by, "probability_category").agg(F.sum("expected_revenue").alias("expected_revenue"))


def revenue_scenarios(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """High (p > .6), medium (.3 <= p <= .6) and conservative
    (0.8 high + 0.3 medium) expected revenue."""
    src = with_expected_revenue(df)
    p, er = F.col(P), F.col("expected_revenue")
    g = src.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(p > 0.6, er)), F.lit(0.0)).alias("high_probability"),
        F.coalesce(F.sum(F.when(p.between(0.3, 0.6), er)), F.lit(0.0)).alias("medium_probability"))
    return g.withColumn("conservative", 0.8 * F.col("high_probability") + 0.3 * F.col("medium_probability"))


def hot_and_at_risk(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Hot deals (p > .7 and value above the exact 80th percentile) and
    at-risk deals (p < .3 and more than 60 days since engagement)."""
    by = list(by)
    src = with_expected_revenue(df)
    q = exact_quantiles(src, "close_value", [0.8], by=by, names=["_q80"])
    j = attach_stats(src, q, by)
    p, v = F.col(P), F.col("close_value")
    hot = (p > 0.7) & (v > F.col("_q80"))
    risk = (p < 0.3) & (F.col("days_since_engage") > 60)
    return j.groupBy(*by).agg(
        F.sum(F.when(hot, 1).otherwise(0)).alias("hot_deals"),
        F.sum(F.when(hot, v)).alias("hot_value"),
        F.sum(F.when(hot, F.col("expected_revenue"))).alias("hot_expected_revenue"),
        F.sum(F.when(risk, 1).otherwise(0)).alias("at_risk_deals"),
        F.sum(F.when(risk, v)).alias("at_risk_value"))


def top_opportunities(df: DataFrame, k: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` most probable opportunities (tie-break on id)."""
    src = with_expected_revenue(df)
    cols = [*by, "opportunity_id", "sales_agent", "account", "product", "close_value", P,
            "expected_revenue", "sales_cycle_days", "days_since_engage"]
    out = top_k(src.select(*[c for c in cols if c in src.columns]), k,
                [F.desc(P), F.asc("opportunity_id")], by=by)
    return out.drop("rank") if by else out


def top_agents(df: DataFrame, k: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` agents with the highest expected revenue."""
    a = agent_insights(df, by)
    out = top_k(a, k, [F.desc("expected_revenue"), F.asc("sales_agent")], by=by)
    return out.drop("rank") if by else out


def reliability_curve(df: DataFrame, label: str = "is_won", bins: int = 10,
                      by: Sequence[str] = ()) -> DataFrame:
    """Equal-width probability bins - mean predicted vs observed rate. A
    probability on an edge is in the lower bin; the edges are multiples of the
    bin width, as floating-point numbers."""
    b = sum(((F.col(P) > F.lit(i * (1.0 / bins))).cast("int") for i in range(1, bins)), F.lit(0))
    return df.where(F.col(P).isNotNull()).groupBy(*by, b.alias("bin")).agg(
        F.count("*").alias("count"), F.avg(P).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("fraction_positive"))


def monthly_report(df: DataFrame, by: Sequence[str] = (), top_n: int = 50) -> dict[str, DataFrame]:
    """The monthly pipeline report - totals, probability bands, top
    opportunities and agent insights - as lazy tables over the report rows
    (open deals plus those due next month)."""
    from dealcast.operators.monthly import pipeline_rows
    pipe = pipeline_rows(df)
    return {"totals": pipeline_totals(pipe, by), "bands": probability_band_summary(pipe, by),
            "top_opportunities": top_opportunities(pipe, top_n, by), "agents": agent_insights(pipe, by)}
