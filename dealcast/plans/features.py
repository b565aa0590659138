"""The feature table (create_features -> encode -> scale -> targets -> feature
list), computed per snapshot (``by=["snapshot_period"]``) for all snapshots in
one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dealcast.functions import scalar as S
from dealcast.operators.encode import join_codes, label_encode, standard_scale, targets, value_codes
from dealcast.operators.joins import attach_key_stats, repeated_keys
from dealcast.session import materialize

TARGET = "deal_stage"
# labels whose value count grows with the data (ids, customers, suppliers)
HIGH_CARDINALITY = ("opportunity_id", "account", "sales_agent")

# Columns the reference label-encodes (text columns of the
# feature table other than the target and the dates).
ENCODED = ("opportunity_id", "sales_agent", "product", "account", "creation_year_month",
           "close_value_category", "sales_cycle_category", "manager", "regional_office", "sector")


# The encoded columns among the model's features.
MODEL_ENCODED = ("sales_agent", "product", "account", "close_value_category", "manager", "regional_office", "sector")
# Row features that neither the model nor the drift comparison uses.
MODEL_UNUSED = ("creation_date", "creation_year_month", "deal_stage_order", "engage_year", "close_year", "close_month",
                "close_quarter", "close_day_of_week", "sales_cycle_category")


def create_features(opps: DataFrame, teams: DataFrame, accounts: DataFrame,
                    by: Sequence[str] = (), codes: Sequence[str] = (), win_counts: bool = False) -> DataFrame:
    """Value, stage, agent, product, date, cycle and account features.

    Per-key statistics are computed over the whole snapshot including the row
    itself, as the reference does (see ``windows.known_at_engage`` for the
    leakage-free variant). All of them come from narrow aggregates of ``opps``; a
    row that a repeated agent or account name would multiply counts as often.
    What an agent has (team, statistics, codes) is one table, and so is what an
    account has, so the rows are shuffled once by agent and once by account. Columns
    that follow from a row alone are added after that. ``codes`` names text
    columns whose values grow with the data, for which ``<col>_encoded`` is added;
    ``win_counts`` adds ``_wins`` and ``_closed``, an agent's won and closed rows of the
    result (null if there are none), so that a rate from them needs no further join.
    """
    by = list(by)
    group = [F.col(b) for b in by]
    flags = S.stage_flags(TARGET)
    won = F.when(flags["is_closed"] == 1, flags["is_won"])
    narrow = (opps.select(*by, "sales_agent", "product", "account", won.alias("_won"))
              .join(repeated_keys(teams, "sales_agent", "_a"), "sales_agent", "left")
              .join(repeated_keys(accounts, "account", "_b"), "account", "left")
              .withColumns({"_a": F.coalesce("_a", F.lit(1).cast("long")), "_b": F.coalesce("_b", F.lit(1).cast("long"))}))

    rows = F.col("_a") * F.col("_b")
    wins = {"_wins": F.sum(rows * F.col("_won")), "_closed": F.sum(F.when(F.col("_won").isNotNull(), rows))} if win_counts else {}

    def rates(key: str, count: str, rate: str, **more: Column) -> DataFrame:
        g = narrow.groupBy(*group, key).agg(F.sum("_a").alias(count), F.sum(F.col("_a") * F.col("_won")).alias("_w"),
                                            F.sum(F.when(F.col("_won").isNotNull(), F.col("_a"))).alias("_c"), *[v.alias(k) for k, v in more.items()])
        return g.select(*by, key, count, F.bround((F.col("_w") / F.col("_c")).cast(S.EXACT), 3).cast("double").alias(rate), *more)

    tables = {"sales_agent": rates("sales_agent", "agent_opportunity_count", "agent_win_rate", **wins),
              "account": narrow.groupBy(*group, "account").agg(F.sum(rows).alias("account_frequency"))}
    f = opps
    coded = value_codes(opps, codes, by) if codes else {}
    for c, table in coded.items():
        if c in tables:
            tables[c] = tables[c].join(table, [*by, c], "left")
        else:
            f = join_codes(f, table, c, by)
    f = attach_key_stats(f, teams, tables["sales_agent"], "sales_agent", by)
    f = attach_key_stats(f, accounts, tables["account"], "account", by)
    products = materialize(rates("product", "product_popularity", "product_win_rate"))  # brands: few
    f = f.join(F.broadcast(products), [*by, "product"], "left")
    for c, table in coded.items():
        if c in tables:  # rows without a value have the class after all values
            null = F.broadcast(table.where(F.col(c).isNull()).select(*by, F.col(f"{c}_encoded").alias("_null"))) if by else None
            if by:
                f = f.join(null, by, "left")
            else:
                f = f.withColumn("_null", table.where(F.col(c).isNull()).select(F.max(f"{c}_encoded")).scalar())
            f = f.withColumn(f"{c}_encoded", F.coalesce(F.when(F.col(c).isNull(), F.col("_null")).otherwise(F.col(f"{c}_encoded")), F.lit(0))).drop("_null")
    cyc = S.cycle_days()
    f = f.withColumns({
        "close_value_log": S.log_value("close_value"),
        "close_value_category": S.value_band("close_value"),
        "deal_stage_order": S.stage_order(TARGET),
        **flags,
        **S.date_parts("engage_date", "engage"),
        "close_year": F.year("close_date"), "close_month": F.month("close_date"),
        "close_quarter": F.quarter("close_date"), "close_day_of_week": F.weekday("close_date"),
        "sales_cycle_days": cyc,
        "sales_cycle_category": S.cycle_band(cyc),
        "is_repeat_account": F.coalesce(F.col("account_frequency") > 1, F.lit(False)).cast("int"),
    })
    first = list(dict.fromkeys([*by, "account", "product", "sales_agent", *opps.columns]))
    own = ["close_value_log", "close_value_category", "deal_stage_order", *flags, *[c for c in teams.columns if c != "sales_agent"],
           "agent_opportunity_count", "agent_win_rate", "product_popularity", "product_win_rate", *S.date_parts("engage_date", "engage"),
           "close_year", "close_month", "close_quarter", "close_day_of_week", "sales_cycle_days", "sales_cycle_category",
           *[c for c in accounts.columns if c != "account"], "account_frequency", "is_repeat_account"]
    return f.select(*first, *own, *[f"{c}_encoded" for c in coded], *wins)


def scale_columns(df: DataFrame, by: Sequence[str] = ()) -> list[str]:
    """Numeric columns the scaler takes: all numerics except the target, the
    grouping columns and any column whose name contains ``id``."""
    from dealcast.operators.clean import numeric_columns
    return [c for c in numeric_columns(df) if c not in by and c != TARGET
            and "id" not in c.lower() and c != "opportunity_key"]


def feature_columns(columns: Sequence[str]) -> list[str]:
    """The model feature list by name rules - skip the target and id-like
    names, prefer ``_encoded``/``_scaled`` versions, then append every
    ``_encoded``/``_scaled`` column (which re-adds ``opportunity_id_encoded``)."""
    cols = list(columns)
    keep = [c for c in cols if c != TARGET
            and not any(w in c.lower() for w in ("id", "opportunity"))
            and f"{c}_encoded" not in cols and f"{c}_scaled" not in cols]
    for c in cols:
        if (c.endswith("_encoded") or c.endswith("_scaled")) and c not in keep:
            keep.append(c)
    return keep


def model_rows(opps: DataFrame, teams: DataFrame, accounts: DataFrame,
               by: Sequence[str] = (), win_counts: bool = False) -> DataFrame:
    """What the model and the drift comparison use of the row features, with the codes of
    ``HIGH_CARDINALITY`` labels, written: the monthly features and the other labels' codes read it."""
    f = create_features(opps, teams, accounts, list(by), [c for c in MODEL_ENCODED if c in HIGH_CARDINALITY], win_counts)
    return materialize(f.drop(*MODEL_UNUSED))


def encode_labels(f: DataFrame, cols: Sequence[str], by: Sequence[str], source: DataFrame | None = None) -> DataFrame:
    """Rows that have the codes of ``HIGH_CARDINALITY`` labels, with the others' as well, in the order
    of ``cols``. ``source`` is a written table with the same labels."""
    have = [f"{c}_encoded" for c in cols if c in HIGH_CARDINALITY]
    out = label_encode(f, [c for c in cols if c not in HIGH_CARDINALITY], by, source=source)
    return out.select(*[c for c in f.columns if c not in have], *[f"{c}_encoded" for c in cols])


def feature_table(opps: DataFrame, teams: DataFrame, accounts: DataFrame,
                  by: Sequence[str] = ()) -> DataFrame:
    """The reference's feature engineering run, end to end."""
    by = list(by)
    # The row features feed ten encoders, the scaler and the targets: write
    # them once instead of replaying the binding and cleaning per branch.
    rows = materialize(create_features(opps, teams, accounts, by, HIGH_CARDINALITY))
    f = encode_labels(rows, [c for c in ENCODED if c in rows.columns], by)
    f = standard_scale(f, scale_columns(f, by), by)
    return targets(f, TARGET, by, source=rows)
