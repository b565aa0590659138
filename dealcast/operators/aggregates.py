"""Aggregations (A1-A7, A12-A17, A20). Each is one ``groupBy().agg()`` with
partial aggregation; grouping keys are parameters so one operator serves
every snapshot at once (``by=["snapshot_period"]``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dealcast.functions import scalar as S
from dealcast.operators.stats import attach_stats, exact_quantiles

CLOSED = ("Won", "Lost")


def _closed(stage: str = "deal_stage") -> Column:
    return F.col(stage).isin(*CLOSED)


def _won(stage: str = "deal_stage") -> Column:
    return F.when(F.col(stage) == "Won", 1).otherwise(0)


def performance(df: DataFrame, key: str, by: Sequence[str] = (), digits: int = 3,
                stage: str = "deal_stage", value: str = "close_value") -> DataFrame:
    """A1 / A2: win rate, wins, average value, revenue and closed count per
    key over closed deals, rounded half-even. Null keys are dropped."""
    src = df.where(_closed(stage) & F.col(key).isNotNull())
    return src.groupBy(*by, key).agg(
        S.rounded_avg(_won(stage), digits).alias("win_rate"),
        F.sum(_won(stage)).alias("total_wins"),
        S.rounded_avg(value, digits).alias("avg_deal_value"),
        S.rounded_sum(value, digits).alias("total_revenue"),
        F.count("*").alias("closed_deals"))


def account_performance(df: DataFrame, by: Sequence[str] = (), stage: str = "deal_stage",
                        value: str = "close_value") -> DataFrame:
    """A3: win rate, value sum and count per account over closed deals,
    rounded to 3 (half-even)."""
    src = df.where(_closed(stage) & F.col("account").isNotNull())
    return src.groupBy(*by, "account").agg(
        S.rounded_avg(_won(stage), 3).alias("account_win_rate"),
        S.rounded_sum(value, 3).alias("account_value"),
        F.count("*").alias("account_deals"))


def value_counts(df: DataFrame, key: str | Column, by: Sequence[str] = (), name: str | None = None) -> DataFrame:
    """A4: rows per value (nulls dropped, as ``value_counts``)."""
    k = F.col(key) if isinstance(key, str) else key
    name = name or (key if isinstance(key, str) else "value")
    return df.where(k.isNotNull()).groupBy(*by, k.alias(name)).agg(F.count("*").alias("count"))


def monthly_pattern(df: DataFrame, by: Sequence[str] = (), date: str = "engage_date",
                    stage: str = "deal_stage", value: str = "close_value") -> DataFrame:
    """A5: by engage month (all rows): count, wins, win rate, mean value,
    rounded to 3 (half-even)."""
    return df.where(F.col(date).isNotNull()).groupBy(*by, F.month(date).alias("engage_month")).agg(
        F.count("*").alias("deals"), F.sum(_won(stage)).alias("wins"),
        S.rounded_avg(_won(stage), 3).alias("win_rate"), S.rounded_avg(value, 3).alias("avg_value"))


def win_rate_by_band(df: DataFrame, by: Sequence[str] = (), value: str = "close_value",
                     stage: str = "deal_stage") -> DataFrame:
    """Win rate per value band (all rows that have a band)."""
    src = df.withColumn("value_band", S.value_band(value))
    return src.where(F.col("value_band").isNotNull()).groupBy(*by, "value_band").agg(
        F.count("*").alias("deals"), F.avg(_won(stage)).alias("win_rate"))


def win_rate_by_quartile(df: DataFrame, by: Sequence[str] = (), value: str = "close_value",
                         stage: str = "deal_stage") -> DataFrame:
    """A6 fallback: win rate per value category (all rows). Every row starts as
    Medium and is then overwritten in the order <= q20 Very Low, <= q40 Low,
    >= q80 Very High, >= q60 High, so the later, wider rules win: what is left
    is Low, Medium and High. A null value stays Medium. The cuts are exact."""
    cuts = exact_quantiles(df, value, [0.4, 0.6], by=by)
    v = F.col(value)
    cat = F.when(v >= F.col("q60"), "High").when(v <= F.col("q40"), "Low").otherwise("Medium")
    j = attach_stats(df, cuts, by).withColumn("value_category", cat)
    return j.groupBy(*by, "value_category").agg(F.count("*").alias("deals"),
                                                F.avg(_won(stage)).alias("win_rate"))


def agent_stats(df: DataFrame, by: Sequence[str] = (), min_deals: int = 10,
                stage: str = "deal_stage", value: str = "close_value") -> DataFrame:
    """Agent stats over all rows, HAVING at least ``min_deals``."""
    src = df.where(F.col("sales_agent").isNotNull())
    g = src.groupBy(*by, "sales_agent").agg(
        F.count("*").alias("deals"), F.avg(_won(stage)).alias("win_rate"),
        F.avg(value).alias("avg_value"))
    return g.where(F.col("deals") >= min_deals)


def quantiles(df: DataFrame, value: str, qs: Sequence[float] = (0.25, 0.5, 0.75, 0.8),
              by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles (linear interpolation), distributed."""
    return exact_quantiles(df, value, qs, by=by)


def distinct_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                    approx: bool = False) -> DataFrame:
    """Distinct values per column (``approx`` uses HyperLogLog++). The
    columns are stacked and made distinct (partial, so a value that repeats
    costs one row a task), then counted: no row is expanded in the shuffle."""
    by = list(by)
    if approx:
        return df.groupBy(*by).agg(*[F.approx_count_distinct(c).alias(f"distinct_{c}") for c in cols])
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    values = df.select(*by, F.expr(f"stack({len(cols)}, {pairs}) AS (_column, _value)")).distinct()
    return values.groupBy(*by).agg(*[
        F.count(F.when(F.col("_column") == c, F.col("_value"))).alias(f"distinct_{c}") for c in cols])


def date_span(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    """Min, max and span in days."""
    return df.groupBy(*by).agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"),
                               F.datediff(F.max(date), F.min(date)).alias("span_days"))


def describe(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles, max."""
    base = df.groupBy(*by).agg(F.count(value).alias("count"), F.avg(value).alias("mean"),
                               F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
                               F.max(value).alias("max"))
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], by=by, names=["p25", "p50", "p75"])
    return base.join(q, list(by), "left") if by else attach_stats(base, q, by)


def histogram(df: DataFrame, value: str, bins: int = 20, by: Sequence[str] = (),
              split: str | None = None) -> DataFrame:
    """Equal-width histogram between the group's min and max (the max
    falls in the last bin); count and density (count / (n * width)). With
    ``split`` each of its values is a histogram of its own: own range, own
    bins, and a density that sums to 1."""
    by = [*by, *([split] if split else [])]
    src = df.where(F.col(value).isNotNull())
    rng = src.groupBy(*by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"),
                               F.count("*").alias("_n"))
    j = attach_stats(src, rng, by)
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - F.col("_lo")) / F.when(width == 0, 1).otherwise(width)),
                F.lit(bins - 1)))
    g = j.withColumn("bin", b.cast("int")).groupBy(*by, "bin").agg(
        F.count("*").alias("count"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"),
        F.first("_n").alias("_n"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return g.select(*by, "bin",
                    (F.col("_lo") + F.col("bin") * w).alias("bin_start"),
                    (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_end"),
                    "count",
                    F.when(w > 0, F.col("count") / (F.col("_n") * w)).alias("density"))


def monthly_trend(df: DataFrame, date: str = "engage_date", by: Sequence[str] = ()) -> DataFrame:
    """Rows per (year, month) of a date."""
    src = df.where(F.col(date).isNotNull())
    return src.groupBy(*by, F.year(date).alias("year"), F.month(date).alias("month")) \
        .agg(F.count("*").alias("count"))


def dataset_summary(df: DataFrame, by: Sequence[str] = (), stage: str = "deal_stage",
                    value: str = "close_value") -> DataFrame:
    """One pass - rows, stage distribution, date and value ranges."""
    st = F.col(stage)
    return df.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.sum(F.when(st == "Won", 1).otherwise(0)).alias("won"),
        F.sum(F.when(st == "Lost", 1).otherwise(0)).alias("lost"),
        F.sum(F.when(st == "Engaging", 1).otherwise(0)).alias("engaging"),
        F.sum(F.when(st == "Prospecting", 1).otherwise(0)).alias("prospecting"),
        F.sum(F.when(st.isin(*CLOSED), 1).otherwise(0)).alias("closed"),
        F.min("engage_date").alias("min_engage"), F.max("engage_date").alias("max_engage"),
        F.min("close_date").alias("min_close"), F.max("close_date").alias("max_close"),
        F.min(value).alias("min_value"), F.max(value).alias("max_value"),
        F.sum(value).alias("total_value"))
