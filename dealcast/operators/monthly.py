"""Monthly win-probability features (M1 = F12-F15) and the training matrix
(M2 = P7 + feature selection + median fill, C6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dealcast.operators.stats import attach_stats, exact_quantiles, exact_quantiles_many

# Flag windows in days and the model's feature list.
DUE_WINDOW = (-15, 45)
OVERDUE_BELOW = -30
EARLY_ABOVE = 60
AS_OF_LAG_DAYS = 30
DEFAULT_CYCLE_DAYS = 90
MODEL_FEATURES = (
    "close_value_log", "close_value_category_encoded", "days_since_engage", "sales_cycle_days",
    "engage_month", "engage_quarter", "engage_day_of_week", "agent_win_rate",
    "agent_opportunity_count", "product_win_rate", "product_popularity", "revenue", "employees",
    "is_repeat_account", "account_frequency", "should_close_next_month", "is_overdue",
    "is_early_stage", "high_value_deal", "long_sales_cycle", "sales_velocity",
    "sales_agent_encoded", "product_encoded", "account_encoded", "manager_encoded",
    "regional_office_encoded", "sector_encoded")
NUMERIC_DRIFT = ("close_value_log", "days_since_engage", "sales_cycle_days", "agent_win_rate",
                 "agent_opportunity_count", "product_win_rate", "product_popularity", "revenue",
                 "employees", "account_frequency", "sales_velocity")
CATEGORICAL_DRIFT = ("close_value_category_encoded", "engage_month", "engage_quarter",
                     "engage_day_of_week", "is_repeat_account", "should_close_next_month",
                     "is_overdue", "is_early_stage", "high_value_deal", "long_sales_cycle",
                     "sales_agent_encoded", "product_encoded", "account_encoded", "manager_encoded",
                     "regional_office_encoded", "sector_encoded")


def monthly_features(df: DataFrame, by: Sequence[str] = (), as_of: Column | None = None) -> DataFrame:
    """M1: days since engagement, expected close, due/overdue/early flags
    (F13, inclusive ``between``: P6), sales velocity (F14), high-value and
    long-cycle flags.

    ``as_of`` defaults to the group's latest snapshot date + 30 days (the
    training convention). The median cycle (closed deals, 90 days when none)
    and the 80th percentiles are exact, one small row per group, joined back.
    Velocity divides only by a positive cycle (ANSI-safe).
    """
    by = list(by)
    # the three quantiles are one distributed ranking over stacked values
    qs = exact_quantiles_many(df, [
        ("_med_cycle", F.when(F.col("is_closed") == 1, F.col("sales_cycle_days")), 0.5),
        ("_q80_value", F.col("close_value"), 0.8),
        ("_q80_cycle", F.col("sales_cycle_days"), 0.8)], by=by)
    stats = df.groupBy(*by).agg(F.max("snapshot_date").alias("_max_snap"),
                                F.max(F.col("is_closed")).alias("_any_closed"))
    stats = stats.join(qs, by, "left") if by else attach_stats(stats, qs, by)
    j = attach_stats(df, stats, by)
    as_of = as_of if as_of is not None else F.date_add(F.col("_max_snap"), AS_OF_LAG_DAYS)
    # pandas' median of an empty closed set is the 90-day default; of closed
    # rows with no cycle it is NaN (-> null expected close)
    cycle = F.when(F.col("_any_closed") == 1, F.col("_med_cycle")).otherwise(F.lit(float(DEFAULT_CYCLE_DAYS)))
    to_close = F.datediff(F.col("engage_date"), as_of) + F.floor(cycle)
    # zone-free: a local date-time plus a (possibly fractional) number of days
    expected = F.col("engage_date").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (cycle * 86400).cast("decimal(18,6)"))
    v, c = F.col("close_value"), F.col("sales_cycle_days")
    out = j.withColumns({
        "as_of_date": as_of,
        "days_since_engage": F.datediff(as_of, F.col("engage_date")),
        "expected_close_date": expected,
        "days_to_expected_close": to_close.cast("int"),
    })
    d = F.col("days_to_expected_close")
    out = out.withColumns({
        "should_close_next_month": F.coalesce(d.between(*DUE_WINDOW), F.lit(False)).cast("int"),
        "is_overdue": F.coalesce(d < OVERDUE_BELOW, F.lit(False)).cast("int"),
        "is_early_stage": F.coalesce(d > EARLY_ABOVE, F.lit(False)).cast("int"),
        "sales_velocity": F.when(c.isNotNull() & (c > 0), v / c).otherwise(F.lit(0.0)),
        "high_value_deal": F.coalesce(v > F.col("_q80_value"), F.lit(False)).cast("int"),
        "long_sales_cycle": F.coalesce(c > F.col("_q80_cycle"), F.lit(False)).cast("int"),
    })
    return out.drop("_med_cycle", "_q80_value", "_q80_cycle", "_max_snap", "_any_closed")


def training_rows(df: DataFrame) -> DataFrame:
    """Closed deals plus those due next month."""
    return df.where((F.col("is_closed") == 1) | (F.col("should_close_next_month") == 1))


def pipeline_rows(df: DataFrame) -> DataFrame:
    """Open deals plus those due next month (the report population)."""
    return df.where((F.col("is_closed") == 0) | (F.col("should_close_next_month") == 1))


def column_medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact medians of many columns in one distributed job: the columns are
    unpivoted to (column, value) and ranked per (group, column), then pivoted
    back to one row per group."""
    by = list(by)
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.select(*by, F.expr(f"stack({len(cols)}, {pairs}) AS (_column, _value)"))
    med = exact_quantiles(long, "_value", [0.5], by=[*by, "_column"], names=["_median"])
    return med.groupBy(*by).pivot("_column", list(cols)).agg(F.first("_median"))


def fill_medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Null -> the column's exact median (per group)."""
    by = list(by)
    meds = column_medians(df, cols, by).select(*by, *[F.col(c).alias(f"_med_{c}") for c in cols])
    j = attach_stats(df, meds, by)
    return j.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")) for c in cols}) \
        .drop(*[f"_med_{c}" for c in cols])


def training_matrix(df: DataFrame, by: Sequence[str] = (), features: Sequence[str] = MODEL_FEATURES,
                    keep: Sequence[str] = ("opportunity_id", "is_won")) -> DataFrame:
    """M2: training rows, available features, nulls filled by medians of the
    training rows (velocity and days-since first, then every feature).

    The two passes are one: after the first, velocity and days-since hold no
    nulls the second could fill, and no other column's median depends on
    them, so every median is taken over the unfilled rows in one ranking."""
    by = list(by)
    rows = training_rows(df)
    have = [c for c in features if c in df.columns]
    first = [c for c in ("sales_velocity", "days_since_engage") if c in df.columns]
    rows = fill_medians(rows, [*first, *[c for c in have if c not in first]], by)
    return rows.select(*by, *[k for k in keep if k in rows.columns], *have)
