"""The standard lazy datasets over a folder of test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dealcast.operators.monthly import CATEGORICAL_DRIFT as DRIFT_CATEGORICAL, NUMERIC_DRIFT as DRIFT_NUMERIC
from dealcast.plans import binding
from dealcast.plans.snapshots import build_snapshots
from dealcast.sources.tables import load_tables

FIRST_MONTH = "1995-12"   # first snapshot month (all earlier creation months merge into it)
BY = ["snapshot_period"]


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return load_tables(spark, sf_dir)


def opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.opportunities(tables(spark, sf_dir))


def snapshots(spark: SparkSession, sf_dir: str, first_month: str = FIRST_MONTH) -> DataFrame:
    t = tables(spark, sf_dir)
    offset = 10 + (F.col("opportunity_key") * binding.CREATE_OFFSET_MULT) % binding.CREATE_OFFSET_MOD
    return build_snapshots(binding.opportunities(t), first_month, offset_days=offset,
                           max_engage=binding.max_engage_date(t))


def dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    t = tables(spark, sf_dir)
    return binding.sales_teams(t), binding.accounts(t), binding.products(t)


def distinct_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct rows of all snapshots with their number, ``_copies``: the layer
    that the cleaning and the quality suite read. The snapshots come dealt by their key,
    so no further shuffle is needed. Written once."""
    from dealcast.session import materialize
    s = snapshots(spark, sf_dir)
    return materialize(s.groupBy(*s.columns).agg(F.count("*").alias("_copies")))


def cleaned(spark: SparkSession, sf_dir: str, distinct: DataFrame | None = None) -> DataFrame:
    """C1-C3 on every snapshot (medians per snapshot), from ``distinct_snapshots``."""
    from dealcast.operators.clean import clean_opportunities
    rows = (distinct if distinct is not None else distinct_snapshots(spark, sf_dir)).drop("_copies")
    return clean_opportunities(rows, by=BY, numeric=["close_value"], distinct=rows)


def row_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dealcast.plans.features import create_features
    teams, accts, _ = dims(spark, sf_dir)
    return create_features(cleaned(spark, sf_dir), teams, accts, by=BY)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table. Its row features and codes are written, the table itself is
    written by whoever stores it, and only then."""
    from dealcast.plans.features import feature_table
    teams, accts, _ = dims(spark, sf_dir)
    return feature_table(cleaned(spark, sf_dir), teams, accts, by=BY)


def model_features(spark: SparkSession, sf_dir: str, distinct: DataFrame | None = None, win_counts: bool = False) -> DataFrame:
    from dealcast.operators.monthly import monthly_features
    from dealcast.plans.features import MODEL_ENCODED, encode_labels, model_rows as build
    teams, accts, _ = dims(spark, sf_dir)
    rows = build(cleaned(spark, sf_dir, distinct), teams, accts, by=BY, win_counts=win_counts)
    # the bounded labels' codes are broadcast, after the monthly features: a reader of the
    # training rows only (P7) has the other rows dropped before that
    return encode_labels(monthly_features(rows, by=BY), MODEL_ENCODED, BY, source=rows)


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned snapshots + stage flags + cycle + M1 monthly features."""
    from dealcast.functions import scalar as S
    from dealcast.operators.monthly import monthly_features
    c = cleaned(spark, sf_dir).withColumns({**S.stage_flags(), "sales_cycle_days": S.cycle_days()})
    return monthly_features(c, by=BY)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly rows with the closed-form stand-in win probability."""
    from dealcast.operators.reports import smoothed_win_rate
    from dealcast.session import materialize
    # the scored set (D2): written once, read by every report and drift branch
    return materialize(smoothed_win_rate(monthly(spark, sf_dir), "sales_agent", by=BY))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dealcast.operators.monthly import pipeline_rows
    return pipeline_rows(scored(spark, sf_dir))


VALIDATED = ("opportunity_id", "sales_agent", "product", "account", "deal_stage", "engage_date",
             "close_date", "close_value", "creation_date", "creation_year_month", "snapshot_date",
             "snapshot_period")


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 11 model columns (+ snapshot_period) of the snapshots."""
    return snapshots(spark, sf_dir).select(*VALIDATED)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule-breaking table, for the checks (see ``binding.ledger``)."""
    return binding.ledger(tables(spark, sf_dir)).select(*VALIDATED)


def drift_input(spark: SparkSession, sf_dir: str, distinct: DataFrame | None = None) -> DataFrame:
    """The scored set (D2): all 27 model features of every row, the outcome and
    ``prediction`` (the closed-form win rate, so that SQL can repeat it; a fitted
    model's score goes through the same operators). The agent's won and closed rows
    come with its other figures, so the wide rows are not joined again."""
    from dealcast.operators.reports import laplace_rate
    from dealcast.session import materialize
    f = model_features(spark, sf_dir, distinct, win_counts=True)
    wins, closed = (F.coalesce(F.col(c), F.lit(0)) for c in ("_wins", "_closed"))
    keep = [*BY, "opportunity_id", "sales_agent", "deal_stage", "is_won", *DRIFT_NUMERIC, *DRIFT_CATEGORICAL]
    return materialize(f.select(*keep, laplace_rate(wins, closed).alias("prediction")))


def drift_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each snapshot (current) against the previous snapshot (reference)."""
    from dealcast.operators.drift import consecutive_pairs, sides
    d = drift_input(spark, sf_dir)
    return sides(d, "snapshot_period", consecutive_pairs(d, "snapshot_period"))


MODEL_KEEP = ("opportunity_id", "opportunity_key", "is_won", "is_closed", "deal_stage", "engage_date", "close_date")


def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 over all snapshots (see ``model_rows``); only the training rows are written,
    and of them what the training matrix is made of."""
    from dealcast.operators.monthly import MODEL_FEATURES, training_rows
    from dealcast.session import materialize
    rows = training_rows(model_features(spark, sf_dir))
    return model_rows(materialize(rows.select(*dict.fromkeys([*BY, *MODEL_KEEP, *MODEL_FEATURES]))))


def model_rows(monthly_rows: DataFrame) -> DataFrame:
    """Training rows with the 27 model features (median-filled), label and
    split (W3 over the whole table) of written monthly features."""
    from dealcast.operators.monthly import MODEL_FEATURES, training_matrix
    from dealcast.operators.windows import temporal_split
    from dealcast.session import materialize
    m = training_matrix(monthly_rows, by=BY, keep=MODEL_KEEP)
    split = temporal_split(m.where(F.col("is_closed") == 1), by=())
    return materialize(split.select("opportunity_id", "opportunity_key", "is_won", "split", *MODEL_FEATURES))
