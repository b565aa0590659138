"""Encoders and scalers (F22-F25) as aggregates joined back, not fitted
Python objects: the fitted state is itself a (small or distributed) table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from dealcast.operators.stats import attach_stats, running_totals


def label_codes(df: DataFrame, col: str, by: Sequence[str] = (), out: str | None = None,
                high_cardinality: bool = False) -> DataFrame:
    """Lexicographic 0-based code of each distinct value of ``col`` (per ``by``
    group): ``(by..., col, <col>_encoded)``. Null is a class of its own, after
    all values; its row is there for every group.

    Label columns with a bounded set of values (agents, regions, sectors,
    bands) are ranked with one window per group over their distinct values.
    ``high_cardinality`` columns (ids, accounts) are ranked with
    ``running_totals`` instead, so no group's distinct values meet in one task.
    """
    by = list(by)
    out = out or f"{col}_encoded"
    distinct = df.select(*by, col).where(F.col(col).isNotNull()).distinct()
    if not high_cardinality:
        w = Window.partitionBy(*by).orderBy(col)
        codes = distinct.withColumn(out, (F.dense_rank().over(w) - 1).cast("int"))
    else:
        ranked = running_totals(distinct.withColumn("_one", F.lit(1)), [col], ["_one"], by=by)
        codes = ranked.select(*by, col, (F.col("cum__one") - 1).cast("int").alias(out))
    kind = df.schema[col].dataType
    null = codes.groupBy(*by).agg((F.max(out) + 1).alias(out)).select(*by, F.lit(None).cast(kind).alias(col), out)
    return codes.unionByName(null)


def join_codes(df: DataFrame, codes: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Add the codes to rows; null values meet the null class. A group whose
    values are all null has no code table: its one class is 0."""
    out = [c for c in codes.columns if c not in (*by, col)]
    named = codes.select(*[F.col(b).alias(f"_by_{b}") for b in by], F.col(col).alias("_class"), *out)
    on = F.col(col).eqNullSafe(F.col("_class"))
    for b in by:
        on = on & (F.col(b) == F.col(f"_by_{b}"))
    joined = df.join(named, on, "left").drop("_class", *[f"_by_{b}" for b in by])
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in out})


def stacked_codes(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Codes of several bounded text columns in one pass: the columns are
    unpivoted to ``(_column, _value)``, made distinct (partial map-side) and
    ranked per ``(by..., _column)``. One scan and one shuffle for all columns
    instead of one per column; the result has one row per distinct value."""
    by = list(by)
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = df.select(*by, F.expr(f"stack({len(cols)}, {pairs}) AS (_column, _value)"))
    # null sorts after all values: a class of its own where it occurs
    w = Window.partitionBy(*by, "_column").orderBy(F.col("_value").asc_nulls_last())
    return long.distinct().withColumn("_code", (F.dense_rank().over(w) - 1).cast("int"))


def stacked_ranks(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The same table for text columns whose values grow with the data (ids,
    customers): one distributed ranking of all of them, so neither a group's nor a
    column's distinct values meet in one task."""
    by = list(by)
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = df.select(*by, F.expr(f"stack({len(cols)}, {pairs}) AS (_column, _value)"))
    distinct = long.where(F.col("_value").isNotNull()).distinct().withColumn("_one", F.lit(1))
    ranked = running_totals(distinct, ["_value"], ["_one"], by=[*by, "_column"])
    codes = ranked.select(*by, "_column", "_value", (F.col("cum__one") - 1).cast("int").alias("_code"))
    null = codes.groupBy(*by, "_column").agg((F.max("_code") + 1).alias("_code"))
    return codes.unionByName(null.withColumn("_value", F.lit(None).cast("string")))


def value_codes(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """``(by..., col, <col>_encoded)`` of text columns whose values grow with the
    data, from one written ranking of all of them (``stacked_ranks``)."""
    from dealcast.session import materialize
    codes = materialize(stacked_ranks(df, cols, by))
    return {c: codes.where(F.col("_column") == c).select(*by, F.col("_value").alias(c), F.col("_code").alias(f"{c}_encoded")) for c in cols}


def label_encode(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                 high_cardinality: Sequence[str] = (), source: DataFrame | None = None) -> DataFrame:
    """F23 (fit + transform): add ``<col>_encoded`` for each column. ``source`` is a
    table with the same values from which the codes are taken, where that is less work.

    Bounded text columns share one code table (``stacked_codes``), written
    once and joined back per column; it is a few rows per group, so the
    joins are broadcast from its file size. High-cardinality text columns share
    one distributed ranking (``stacked_ranks``); other types are coded one by one."""
    from dealcast.session import materialize
    by = list(by)
    source = source if source is not None else df
    text = [c for c in cols if isinstance(df.schema[c].dataType, StringType)]
    tables = {}
    for group, rank in (([c for c in text if c not in high_cardinality], stacked_codes),
                        ([c for c in text if c in high_cardinality], stacked_ranks)):
        if group:
            codes = materialize(rank(source, group, by))
            for c in group:
                tables[c] = codes.where(F.col("_column") == c).select(
                    *by, F.col("_value").alias(c), F.col("_code").alias(f"{c}_encoded"))
    out = df
    for c in cols:
        codes = tables[c] if c in tables else label_codes(source, c, by, high_cardinality=c in high_cardinality)
        out = join_codes(out, codes, c, by)
    return out.select(*df.columns, *[f"{c}_encoded" for c in cols])


def frequency_encode(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """share of rows having the value."""
    by = list(by)
    counts = df.groupBy(*by, col).agg(F.count("*").alias("_c"))
    totals = df.groupBy(*by).agg(F.count("*").alias("_t"))
    freq = counts.join(totals, by, "inner") if by else \
        counts.withColumn("_t", df.select(F.count("*")).scalar())
    freq = freq.select(*by, col, (F.col("_c") / F.col("_t")).alias(f"{col}_frequency"))
    return df.join(freq, [*by, col], "left")


def scaler_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Fit of F22: population mean and std per column, one aggregation pass."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"_mu_{c}"), F.stddev_pop(c).alias(f"_sd_{c}")]
    return df.groupBy(*by).agg(*aggs)


def standard_scale(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                   stats: DataFrame | None = None) -> DataFrame:
    """``<col>_scaled = (x - mean) / std_pop``; a zero std scales by 1.
    The fitted statistics are one row per group, joined back."""
    by = list(by)
    stats = stats if stats is not None else scaler_stats(df, cols, by)
    j = attach_stats(df, stats, by)
    scaled = {}
    for c in cols:
        sd = F.col(f"_sd_{c}")
        scaled[f"{c}_scaled"] = (F.col(c) - F.col(f"_mu_{c}")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
    return j.withColumns(scaled).drop(*[x for c in cols for x in (f"_mu_{c}", f"_sd_{c}")])


def targets(df: DataFrame, stage: str = "deal_stage", by: Sequence[str] = (), source: DataFrame | None = None) -> DataFrame:
    """binary target (Won) and multi-class code of the stage. ``source`` as for ``label_encode``."""
    out = df.withColumn("target_binary", F.coalesce(F.col(stage) == "Won", F.lit(False)).cast("int"))
    return join_codes(out, label_codes(source if source is not None else df, stage, by, out="target_multiclass"), stage, by)
