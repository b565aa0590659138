"""Distributed ordered statistics: running totals and exact quantiles.

A global ``Window.orderBy`` without ``partitionBy`` moves every row into one
task. ``running_totals`` instead range-partitions the rows, takes running sums
inside each slice (one window partition per slice), sums each slice, and adds
the totals of all earlier slices. Only the per-slice totals (at most
``slices`` rows per group) are ranked in a small window.

Range bounds come from sampling, and the order of rows arriving from a
shuffle is not fixed, so two evaluations of the same range exchange may cut
the slices differently. The sliced rows are therefore checkpointed (a
reliable checkpoint under ``spark.checkpoint.dir``) before the slice totals
are taken from them: both passes read the same slices, and a lost executor
re-reads the checkpoint instead of re-cutting. Equal ordering keys always land
in the same slice. Callers pre-aggregate to distinct keys first
(``groupBy(key).count()``), which also bounds a hot key to one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from dealcast.session import materialize, shuffle_partitions


def running_totals(df: DataFrame, order_cols: Sequence[str], sum_cols: Sequence[str],
                   by: Sequence[str] = (), slices: int | None = None,
                   prefix: str = "cum_", totals: str | None = None, bounded: bool = True, following: str | None = None) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over rows of the same ``by`` group whose
    ordering key is <= the row's key (ties included, as a RANGE frame), and
    with ``totals`` (a prefix) the group's whole sums. Both come from the
    written slices, so the input is evaluated once.

    ``bounded`` states that the ``by`` groups are few whatever the data's size
    (periods, column names): the offsets, at most slices + groups rows, are then
    broadcast. Pass False for groups that grow with the data. ``following``
    names a column for the first ordering column's value in the group's next
    row (null in its last): each slice is told the first value of the next one.
    It asks for distinct ordering keys in a group.
    Runs one checkpoint job when called (see the module notes)."""
    by, order_cols, sum_cols = list(by), list(order_cols), list(sum_cols)
    n = slices or shuffle_partitions(df.sparkSession)
    ranged = df.repartitionByRange(n, *by, *order_cols).withColumn("_slice", F.spark_partition_id())
    w_in = Window.partitionBy("_slice", *by).orderBy(*order_cols)  # default RANGE frame: peers included
    lead = [F.lead(order_cols[0]).over(w_in).alias("_lead")] if following else []
    local = materialize(ranged.select("*", *[F.sum(c).over(w_in).alias(f"_loc_{c}") for c in sum_cols], *lead))
    low = [F.min(order_cols[0]).alias("_low")] if following else []
    sums = local.groupBy(*by, "_slice").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols], *low)
    w_all = Window.partitionBy(*by)
    w_off = w_all.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = [F.sum(f"_tot_{c}").over(w_all).alias(f"{totals}{c}") for c in sum_cols] if totals else []
    after = [F.lead("_low").over(w_all.orderBy("_slice")).alias("_after")] if following else []
    offsets = sums.select(*by, "_slice", *after, *[
        F.coalesce(F.sum(f"_tot_{c}").over(w_off), F.lit(0)).alias(f"_off_{c}") for c in sum_cols], *whole)
    if bounded or not by:
        offsets = F.broadcast(offsets)
    out = local.join(offsets, [*by, "_slice"], "inner")
    return out.select(*df.columns, *[(F.col(f"_off_{c}") + F.col(f"_loc_{c}")).alias(f"{prefix}{c}")
                                     for c in sum_cols], *([f"{totals}{c}" for c in sum_cols] if totals else []),
                      *([F.coalesce("_lead", "_after").alias(following)] if following else []))


def _qname(q: float) -> str:
    return f"q{round(q * 100):d}"


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None, slices: int | None = None,
                    weight: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (``quantile_cont`` /
    ``percentile``) per ``by`` group, nulls ignored, without holding a group's
    values in one task: distinct values are counted, ranked with
    ``running_totals``, and the two values around each position picked.

    Returns one row per group that has at least one value: ``by`` columns plus
    one column per quantile (``names`` or ``q25``-style). ``weight`` names a
    column of row multiplicities (pre-counted input).
    """
    by = list(by)
    names = list(names) if names else [_qname(q) for q in qs]
    counts = (df.where(F.col(value).isNotNull())
              .groupBy(*by, F.col(value).cast("double").alias("_v"))
              .agg((F.sum(weight) if weight else F.count("*")).cast("long").alias("_n")))
    r = running_totals(counts, ["_v"], ["_n"], by=by, slices=slices, totals="_all").withColumnRenamed("_all_n", "_total")
    first_rank = F.col("cum__n") - F.col("_n")          # 0-based rank of the value's first copy
    last_rank = F.col("cum__n") - 1
    aggs = []
    for i, q in enumerate(qs):
        pos = (F.col("_total") - 1) * F.lit(float(q))
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs.append(F.max(F.when((first_rank <= lo) & (lo <= last_rank), F.col("_v"))).alias(f"_lo{i}"))
        aggs.append(F.max(F.when((first_rank <= hi) & (hi <= last_rank), F.col("_v"))).alias(f"_hi{i}"))
        aggs.append(F.max(pos - lo).alias(f"_fr{i}"))
    g = r.groupBy(*by).agg(*aggs)

    def interp(i):  # (ceil - pos) * lo + (pos - floor) * hi, as Spark's percentile
        lo_v, hi_v, fr = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_fr{i}")
        return F.when(fr == 0, lo_v).otherwise((1 - fr) * lo_v + fr * hi_v)
    return g.select(*by, *[interp(i).alias(names[i]) for i in range(len(qs))])


def exact_quantiles_many(df: DataFrame, specs: Sequence[tuple[str, Column, float]],
                         by: Sequence[str] = ()) -> DataFrame:
    """Several exact quantiles of different columns / row subsets in one
    distributed ranking: ``specs`` = [(name, value expression, q)], where the
    expression is null for rows outside the spec's subset. The rows are
    stacked to (spec, value) and ranked per (group, spec). Returns one row
    per group with one column per spec."""
    by = list(by)
    names = [n for n, _, _ in specs]
    cells = [x for n, expr, _ in specs for x in (F.lit(n), expr.cast("double"))]
    long = df.select(*by, F.stack(F.lit(len(specs)), *cells).alias("_spec", "_value"))  # one scan for all
    qs = sorted({q for _, _, q in specs})
    qn = [f"_q{i}" for i in range(len(qs))]
    q = exact_quantiles(long, "_value", qs, by=[*by, "_spec"], names=qn)
    pick = F.lit(None).cast("double")
    for n, _, qv in specs:
        pick = F.when(F.col("_spec") == n, F.col(qn[qs.index(qv)])).otherwise(pick)
    q = q.select(*by, "_spec", pick.alias("_pick"))
    return q.groupBy(*by).pivot("_spec", names).agg(F.first("_pick"))


def quantile_scalar(df: DataFrame, value: str, q: float) -> Column:
    """One exact quantile of a whole table as a scalar-subquery column."""
    return exact_quantiles(df, value, [q], names=["_q"]).select("_q").scalar()


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate (a global statistic) to every
    row: a broadcast hash join on a constant key. The broadcast side is one
    row by construction (a global ``agg``)."""
    return (df.withColumn("_one_row_key", F.lit(1))
            .join(F.broadcast(one_row.withColumn("_one_row_key", F.lit(1))), "_one_row_key", "left")
            .drop("_one_row_key"))


def attach_stats(df: DataFrame, stats: DataFrame, by: Sequence[str], bounded: bool = True) -> DataFrame:
    """Join per-group statistics (one row per ``by`` group) back to rows.
    ``bounded`` states that the groups are few whatever the data's size
    (periods, outcomes, column names): they are broadcast, and the rows, a third
    of which may be one period's, are not shuffled. Pass False for others."""
    if not by:
        return attach_row(df, stats)
    return df.join(F.broadcast(stats) if bounded else stats, list(by), "left")
