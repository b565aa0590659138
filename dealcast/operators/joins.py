"""Joins (J1-J8).

Dimension joins are plain equi-joins without a broadcast hint: the sales
team, account and product tables grow with the data, so AQE chooses a
broadcast only when the runtime size is below the broadcast threshold and a
sort-merge join (with skew splitting) otherwise. ``bounded=True`` forces a
broadcast and is only for tables whose size is fixed by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def dim_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str],
             how: str = "left", bounded: bool = False) -> DataFrame:
    return fact.join(F.broadcast(dim) if bounded else dim, on, how)


def join_sales_teams(fact: DataFrame, teams: DataFrame) -> DataFrame:
    """Facts left-join sales teams on the agent."""
    return dim_join(fact, teams, "sales_agent")


def join_accounts(fact: DataFrame, accounts: DataFrame) -> DataFrame:
    """J2."""
    return dim_join(fact, accounts, "account")


def join_products(fact: DataFrame, products: DataFrame) -> DataFrame:
    """J3."""
    return dim_join(fact, products, "product")


def unmatched(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row (anti-join). A null key never
    matches, as in a left join."""
    return fact.join(dim.select(key).distinct(), key, "left_anti")


def unmatched_count(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """J1 check: one row ``(key_column, unmatched_rows)``."""
    return unmatched(fact, dim, key).agg(F.count("*").alias("unmatched_rows")) \
        .select(F.lit(key).alias("key_column"), "unmatched_rows")


def attach_group_stats(fact: DataFrame, key: Sequence[str], stats: dict[str, Column],
                       where: Column | None = None) -> DataFrame:
    """Aggregate per key and join the result back to every row.

    ``groupBy`` + join instead of ``count().over(partitionBy(key))``: the
    aggregate is partial (map-side), so a key holding a third of all rows does
    not pull those rows into one task; the join back is split by AQE's skew
    handling or broadcast when the per-key table is small. Rows whose key is
    null get null stats (as the reference's value-count lookup).
    """
    key = list(key)
    src = fact.where(where) if where is not None else fact
    agg = src.groupBy(*key).agg(*[c.alias(n) for n, c in stats.items()])
    return fact.join(agg, key, "left")


def attach_key_stats(fact: DataFrame, dim: DataFrame, table: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Rows with the columns of a dimension (by ``key``) and of a table of
    statistics (by ``by`` and ``key``). Both are put together first, as narrow rows, so
    the rows themselves are joined, and shuffled, once. Rows whose key is null get nulls;
    a key that the dimension has several times repeats its rows, as in a plain join."""
    by = list(by)
    stats = [c for c in table.columns if c not in (*by, key)]
    more = [c for c in dim.columns if c != key]
    both = table.join(dim, key, "left").select(*[F.col(c).alias(f"_on_{c}") for c in (*by, key)], *more, *stats)
    on = F.col(key) == F.col(f"_on_{key}")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_on_{b}"))
    return fact.join(both, on, "left").select(*fact.columns, *more, *stats)


def repeated_keys(dim: DataFrame, key: str, out: str) -> DataFrame:
    """(key, out): how often a dimension has the keys that it has more than once. Written,
    so that its size is known (it is empty if the keys are unique)."""
    from dealcast.session import materialize
    return materialize(dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(out)).where(F.col(out) > 1))


def having_min_rows(fact: DataFrame, key: str | Sequence[str], n: int,
                    where: Column | None = None) -> DataFrame:
    """Rows whose key has at least ``n`` rows (semi-join)."""
    key = [key] if isinstance(key, str) else list(key)
    src = fact.where(where) if where is not None else fact
    keep = src.groupBy(*key).count().where(F.col("count") >= n).select(*key)
    return fact.join(keep, key, "left_semi")


def values_not_in(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Distinct values outside an allowed list (nulls are reported too)."""
    v = df.select(column).distinct()
    return v.where(~F.coalesce(F.col(column).isin(*allowed), F.lit(False)))


def enrich_new_records(new: DataFrame, history: DataFrame,
                       defaults: dict[str, float] | None = None) -> DataFrame:
    """J8 (+ F5): enrich a batch of new opportunities with what the history
    knows: per agent and product the row count and mean win flag, per account
    the row count (unseen keys: count 1, rate 0.5); the value's quartile code
    (0-3) against the history's exact quartiles; and the history's
    lexicographic codes of agent, product, account, manager, region and
    sector (unseen: 0).

    Both inputs carry sales_agent, product, account, manager,
    regional_office, sector; ``history`` also ``is_won`` and ``close_value``;
    ``new`` also ``engage_date`` and ``close_value``. Every lookup is a
    per-key aggregate of the history joined to the batch.
    """
    from dealcast.operators.stats import attach_row, exact_quantiles
    d = {"count": 1, "rate": 0.5, "code": 0}
    d.update(defaults or {})
    agent = history.groupBy("sales_agent").agg(F.count("*").alias("agent_opportunity_count"),
                                              F.avg("is_won").alias("agent_win_rate"))
    product = history.groupBy("product").agg(F.count("*").alias("product_popularity"),
                                             F.avg("is_won").alias("product_win_rate"))
    account = history.groupBy("account").agg(F.count("*").alias("account_frequency"))
    out = (new.join(agent, "sales_agent", "left").join(product, "product", "left")
           .join(account, "account", "left"))
    # null is a class of its own, as in training
    for c in ("product", "regional_office", "sector"):          # bounded label sets
        out = _with_codes(out, history, c)
    for c in ("sales_agent", "account"):                          # grow with the data
        out = _with_codes(out, history, c, high_cardinality=True)
    agent_mgr = _with_codes(history.select("sales_agent", "manager").where(F.col("sales_agent").isNotNull()).distinct(), history, "manager") \
        .groupBy("sales_agent").agg(F.min("manager_encoded").alias("manager_encoded"))
    out = out.join(agent_mgr, "sales_agent", "left")
    q = exact_quantiles(history, "close_value", [0.25, 0.5, 0.75], names=["_q25", "_q50", "_q75"])
    out = attach_row(out, q)
    v = F.col("close_value")
    quartile = (F.when(v <= F.col("_q25"), 0).when(v <= F.col("_q50"), 1)
                .when(v <= F.col("_q75"), 2).otherwise(3))
    fill = {c: F.coalesce(c, F.lit(d["code"])) for c in
            ("sales_agent_encoded", "product_encoded", "account_encoded", "manager_encoded",
             "regional_office_encoded", "sector_encoded")}
    return out.withColumns({
        "agent_opportunity_count": F.coalesce("agent_opportunity_count", F.lit(d["count"])),
        "agent_win_rate": F.coalesce("agent_win_rate", F.lit(d["rate"])),
        "product_popularity": F.coalesce("product_popularity", F.lit(d["count"])),
        "product_win_rate": F.coalesce("product_win_rate", F.lit(d["rate"])),
        "account_frequency": F.coalesce("account_frequency", F.lit(d["count"])),
        "engage_month": F.month("engage_date"), "engage_quarter": F.quarter("engage_date"),
        "engage_day_of_week": F.weekday("engage_date"),
        "close_value_category_encoded": quartile, **fill,
    }).drop("_q25", "_q50", "_q75")


def _with_codes(df: DataFrame, history: DataFrame, col: str, high_cardinality: bool = False) -> DataFrame:
    from dealcast.operators.encode import label_codes
    codes = label_codes(history, col, high_cardinality=high_cardinality).withColumnRenamed(col, "_class")
    return df.join(codes, F.col(col).eqNullSafe(F.col("_class")), "left").drop("_class")
