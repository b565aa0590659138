"""Month-end snapshots of the opportunity table.

The reference cuts the history into one file per creation month with a Python
loop over groups. Here a snapshot is a value of the ``snapshot_period``
column: one projection computes it for every row, so all snapshots are built
in a single narrow (shuffle-free) pass and can be written with
``partitionBy("snapshot_period")``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from dealcast.functions.periods import period_end, period_of


def add_creation_dates(df: DataFrame, offset_days: Column | None = None,
                       max_engage: Column | None = None) -> DataFrame:
    """C7 + C8: creation date = engage date (null -> latest engage date) minus
    ``offset_days``; creation period ``yyyy-MM``.

    ``offset_days`` defaults to a reproducible 10-29 day offset hashed from the
    id (the reference draws it at random). ``max_engage`` defaults to a scalar
    subquery over ``df``.
    """
    if offset_days is None:
        offset_days = 10 + F.pmod(F.xxhash64("opportunity_id"), F.lit(20))
    if max_engage is None:
        max_engage = df.select(F.max("engage_date")).scalar()
    created = F.date_sub(F.coalesce(F.col("engage_date"), max_engage), offset_days.cast("int"))
    return (df.withColumn("creation_date", created)
            .withColumn("creation_year_month", period_of("creation_date")))


def rewind_to(df: DataFrame, snapshot_date: Column) -> DataFrame:
    """State of each opportunity as known at ``snapshot_date`` (masked
    updates, P10: ``when(cond, v).otherwise(col)``).

    A close after the snapshot date reverts the deal to Engaging with no close
    date; an engagement after it reverts the deal to Prospecting with no engage
    date. The close value is kept, as in the reference.
    """
    close_after = F.coalesce(F.col("close_date") > snapshot_date, F.lit(False))
    engage_after = F.coalesce(F.col("engage_date") > snapshot_date, F.lit(False))
    stage = (F.when(engage_after, F.lit("Prospecting"))
             .when(close_after, F.lit("Engaging")).otherwise(F.col("deal_stage")))
    return df.withColumns({
        "snapshot_date": snapshot_date,
        "deal_stage": stage,
        "close_date": F.when(close_after, F.lit(None).cast("date")).otherwise(F.col("close_date")),
        "engage_date": F.when(engage_after, F.lit(None).cast("date")).otherwise(F.col("engage_date")),
    })


def assemble_snapshots(df: DataFrame, first_month: str) -> DataFrame:
    """C10 (and U1: one table, not concatenated groups): rows created up to
    ``first_month`` form the first snapshot; each
    later creation month is its own snapshot. Each snapshot is rewound to its
    month end. Periods before ``first_month`` are kept even when the first
    month itself has no rows."""
    period = F.greatest(F.col("creation_year_month"), F.lit(first_month))
    out = df.withColumn("snapshot_period", period)
    return rewind_to(out, period_end(F.col("snapshot_period")))


def first_n_periods_month(df: DataFrame, n: int) -> Column:
    """C11: the ``n``-th distinct creation period, as a scalar subquery, for use
    as ``first_month`` (the first ``n`` periods merge into one snapshot).
    The distinct periods are few (one per month), so ranking them in one
    window partition is bounded by the calendar, not by the data."""
    periods = df.select("creation_year_month").where(F.col("creation_year_month").isNotNull()).distinct()
    ranked = periods.withColumn("r", F.dense_rank().over(Window.orderBy("creation_year_month")))
    return ranked.where(F.col("r") <= n).select(F.max("creation_year_month")).scalar()


def build_snapshots(opps: DataFrame, first_month: str | Column,
                    offset_days: Column | None = None,
                    max_engage: Column | None = None) -> DataFrame:
    """C7-C10 composed: the 11 model columns plus ``snapshot_period``."""
    df = add_creation_dates(opps, offset_days, max_engage)
    if isinstance(first_month, str):
        return assemble_snapshots(df, first_month)
    period = F.greatest(F.col("creation_year_month"), first_month)
    return rewind_to(df.withColumn("snapshot_period", period), period_end(F.col("snapshot_period")))
