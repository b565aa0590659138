"""Window-style operators: leakage-free history (W2), splits (W3-W5),
sort / top-k / seeded sample (T1-T3).

No operator here uses a window without ``partitionBy``: global orderings go
through ``stats.running_totals``; per-group top-k uses ``row_number() <= k``,
which Spark plans with a map-side group limit (``WindowGroupLimit``), so a
hot group is cut to k rows per partition before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dealcast.operators.stats import attach_stats, exact_quantiles, running_totals


def stable_hash(key: str | Column, seed: int = 42, buckets: int = 1000) -> Column:
    """Reproducible bucket in [0, buckets) from a key of any type: the first 60
    bits of the md5 of its text and the seed, so any SQL engine can compute the
    same bucket and no two keys share it by a narrow modulus."""
    k = F.col(key) if isinstance(key, str) else key
    bits = F.substring(F.md5(F.concat(k.cast("string"), F.lit(f"-{seed}"))), 1, 15)
    return F.pmod(F.conv(bits, 16, 10).cast("long"), F.lit(buckets))


def known_at_engage(df: DataFrame, key: str, by: Sequence[str] = (), stage: str = "deal_stage",
                    engage: str = "engage_date", close: str = "close_date",
                    prefix: str | None = None) -> DataFrame:
    """Per row, the key's closed deals and wins with a close date strictly
    before the row's engage date (no look-ahead).

    Closed deals are first reduced to one row per (key, close day); rows ask
    one question per (key, engage day). Both are unioned and a running sum per
    key over days gives the history - the window runs over days, never over
    raw rows, so a hot key is bounded by its number of distinct days.
    """
    by = list(by)
    prefix = prefix or f"{key}_prior"
    closed = F.col(stage).isin("Won", "Lost")
    events = (df.where(closed & F.col(close).isNotNull() & F.col(key).isNotNull())
              .groupBy(*by, key, F.col(close).alias("_day"))
              .agg(F.count("*").alias("_closed"), F.sum(F.when(F.col(stage) == "Won", 1).otherwise(0)).alias("_wins")))
    asks = (df.where(F.col(engage).isNotNull() & F.col(key).isNotNull())
            .select(*by, key, F.col(engage).alias("_day")).distinct()
            .withColumns({"_closed": F.lit(0).cast("long"), "_wins": F.lit(0).cast("long")}))
    both = events.unionByName(asks).groupBy(*by, key, "_day").agg(
        F.sum("_closed").alias("_closed"), F.sum("_wins").alias("_wins"))
    w = Window.partitionBy(*by, key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    hist = both.select(*by, key, F.col("_day").alias(engage),
                       F.coalesce(F.sum("_closed").over(w), F.lit(0)).alias(f"{prefix}_closed"),
                       F.coalesce(F.sum("_wins").over(w), F.lit(0)).alias(f"{prefix}_wins"))
    out = df.join(hist, [*by, key, engage], "left")
    return out.withColumn(f"{prefix}_win_rate",
                          F.when(F.col(f"{prefix}_closed") > 0,
                                 F.col(f"{prefix}_wins") / F.col(f"{prefix}_closed")))


def effective_close(df: DataFrame, by: Sequence[str] = (), default_cycle: int = 90) -> DataFrame:
    """Close date, or engage date + median closed-deal cycle (``default_cycle``
    days when no closed deal has a cycle)."""
    by = list(by)
    closed = df.where(F.col("deal_stage").isin("Won", "Lost"))
    cyc = closed.select(*by, F.datediff("close_date", "engage_date").alias("_cycle"))
    med = exact_quantiles(cyc, "_cycle", [0.5], by=by, names=["_med_cycle"])
    j = attach_stats(df, med, by)
    days = F.coalesce(F.col("_med_cycle"), F.lit(float(default_cycle)))
    # the median may be fractional: keep the time of day, as a timestamp
    fallback = F.col("engage_date").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.floor(days * 86400).cast("decimal(18,6)"))
    eff = F.coalesce(F.col("close_date").cast("timestamp_ntz"), fallback)
    return j.withColumn("effective_close", eff).drop("_med_cycle")


def position_split(df: DataFrame, order_cols: Sequence[str], by: Sequence[str] = (),
                   train_share: float = 0.8, name: str = "split") -> DataFrame:
    """First ``floor(n * share)`` rows by ``order_cols`` (per group) are
    'train', the rest 'test' - a distributed rank, not a one-task window."""
    by = list(by)
    r = running_totals(df.withColumn("_one", F.lit(1)), list(order_cols), ["_one"], by=by, totals="_all")
    return r.withColumn(name, F.when(F.col("cum__one") <= F.floor(F.col("_all_one") * train_share), "train")
                        .otherwise("test")).drop("_one", "cum__one", "_all_one")


def temporal_split(df: DataFrame, by: Sequence[str] = (), train_share: float = 0.8,
                   include_open: bool = False) -> DataFrame:
    """W3 (and W4 with ``include_open``): closed rows ordered by effective
    close date then id; the first 80 % train. Open rows are excluded (W3) or
    split 80/20 by id position (W4)."""
    closed = F.col("deal_stage").isin("Won", "Lost")
    e = effective_close(df, by)
    out = position_split(e.where(closed), ["effective_close", "opportunity_id"], by, train_share)
    if include_open:
        open_ = position_split(e.where(~closed), ["opportunity_id"], by, train_share)
        out = out.unionByName(open_)
    return out


def stratified_split(df: DataFrame, key: str, strata: str, train_share: float = 0.8,
                     seed: int = 42) -> DataFrame:
    """In every stratum, the first ``floor(n * share)`` rows by a seeded hash
    are 'train' - a distributed rank in each stratum (null is a stratum too)."""
    cols = df.columns
    tagged = df.withColumns({"_hash": stable_hash(key, seed, 1 << 30),
                             "_stratum": F.coalesce(F.col(strata).cast("string"), F.lit("\u0000"))})
    return position_split(tagged, ["_hash", key], ["_stratum"], train_share).select(*cols, "split")


def top_k(df: DataFrame, k: int, order: Sequence[Column], by: Sequence[str] = (),
          rank_name: str = "rank") -> DataFrame:
    """Top ``k`` rows per group by ``order`` (include a unique id as
    the last ordering column for a stable tie-break)."""
    if not by:
        return df.orderBy(*order).limit(k)   # TakeOrderedAndProject: per-partition top-k, then merge
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= k)


def seeded_sample(df: DataFrame, n: int, key: str, by: Sequence[str] = (), seed: int = 42,
                  where: Column | None = None) -> DataFrame:
    """Fixed-size reproducible sample of ``n`` rows per group, ordered by
    a seeded hash of the key (tie-break on the key), of the rows that satisfy
    ``where`` whatever the group's size."""
    by = list(by)
    src = df if where is None else df.where(where)
    order = [stable_hash(key, seed, 1 << 30), F.col(key)]
    return top_k(src, n, order, by=by).drop("rank")
