"""The daily monitor with state of a fixed size (ST1).

State holds one row for each open day and feature, however many values a day
has: a KLL sketch of the numbers, and the counts of the categories that the
reference day has (its ``CATEGORIES`` most frequent ones; all others count
together, on either side). Sketches and counts merge, so partial rows of all
tasks go into one.

Drift of a number is the largest gap between the two sketches' ranks at and
just before each of the reference's quantiles (between two of them the
reference's rank hardly grows, so no gap is much larger); the quantile comes
from the day's sketch. Both are within ``error_bounds`` of the
exact figures. Shares of missing values and of values in the reference's range,
and the distance of the categories, are exact. An event that comes after its
day was closed can't change the day any more: ``late_events`` counts them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dealcast.operators import drift as DR
from dealcast.session import materialize, path_exists
from dealcast.streaming.monitoring import CATEGORICAL, NUMERIC, _write_days, event_stream, tokens

K = 1024           # a KLL sketch's parameter
CATEGORIES = 64    # categories of a feature with counts of their own
GRID = 250         # quantiles of the reference at which ranks are compared

#: (day, feature) rows as the state holds them.
PROFILE = "n long, missing long, inside long, sketch binary, counts array<long>"


def error_bounds(k: int = K, grid: int = GRID) -> tuple[float, float]:
    """(rank of a quantile, drift): a sketch's ranks are within 2.296 / k ** 0.9723
    of the true ones with a confidence of 99 %; a gap has two of them, and the
    reference's rank grows by 1 / grid between two points."""
    rank = 2.296 / k ** 0.9723
    return rank, 2 * rank + 1 / grid


@dataclass(frozen=True)
class Reference:
    """The reference day: constants of the stream's plan, and its profile row a feature."""
    ranges: dict[str, tuple]
    categories: dict[str, list[str]]
    profile: DataFrame
    grid: dict[str, tuple[list, list]]  # of each number: points and the reference's ranks there


def _profile(rows: DataFrame, by: Sequence[Column | str], ranges: dict[str, tuple], categories: dict[str, list[str]], k: int = K) -> DataFrame:
    """Aggregate (feature, num, cat) rows."""
    inside = F.lit(False)
    for f, (low, high) in ranges.items():
        if low is not None:
            inside = inside | ((F.col("feature") == f) & F.col("num").between(low, high))
    place = F.lit(0)  # 1, 2 ... for the reference's categories, 0 for others
    for f, names in categories.items():
        place = F.when(F.col("feature") == f, F.array_position(F.array(*[F.lit(c) for c in names] or [F.lit("")]), F.col("cat"))).otherwise(place)
    width = max([0, *map(len, categories.values())]) + 1
    known = F.col("cat").isNotNull()
    return rows.groupBy(*by, "feature").agg(
        F.count("*").alias("n"), F.sum((F.col("num").isNull() & F.col("cat").isNull()).cast("long")).alias("missing"),
        F.sum(F.coalesce(inside, F.lit(False)).cast("long")).alias("inside"), F.kll_sketch_agg_double("num", F.lit(k)).alias("sketch"),
        *[F.sum((known & (place == i)).cast("long")).alias(f"_c{i}") for i in range(width)])


def _rows(profile: DataFrame, day: Column) -> DataFrame:
    counts = [c for c in profile.columns if c.startswith("_c")]
    return profile.select(day.alias("day"), "feature", "n", "missing", "inside", "sketch", F.array(*counts).alias("counts"))


def reference(events: DataFrame, day, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL, k: int = K) -> Reference:
    """Profile of the reference day. Its ranges (a row a column) and categories
    (``CATEGORIES`` a column at most) come to the driver."""
    ref = materialize(tokens(events.where(F.to_date("ts") == F.lit(day)), numeric, categorical))
    ranges = {r.feature: (r.low, r.high) for r in ref.where("num is not null").groupBy("feature").agg(F.min("num").alias("low"), F.max("num").alias("high")).collect()}
    categories = {}
    for c in categorical:
        top = ref.where((F.col("feature") == c) & F.col("cat").isNotNull()).groupBy("cat").count().orderBy(F.desc("count"), "cat").limit(CATEGORIES)
        categories[c] = sorted(r.cat for r in top.collect())
    profile = materialize(_rows(_profile(ref, [], ranges, categories, k), F.lit(day).cast("date")))
    grid = {}
    for f in ranges:
        own = profile.where(F.col("feature") == f)
        q = own.select(F.kll_sketch_get_quantile_double("sketch", F.lit([i / GRID for i in range(GRID + 1)]))).first()[0]
        points = [x for v in sorted(set(q)) for x in (math.nextafter(v, -math.inf), v)]
        grid[f] = points, list(own.select(F.kll_sketch_get_rank_double("sketch", F.lit(points))).first()[0])
    return Reference(ranges, categories, profile, grid)


def _metrics(days: DataFrame, ref: Reference, prediction: str, quantile_col: str) -> DataFrame:
    """Daily metrics from (day, feature) rows. The reference has a row a feature: broadcast."""
    own = days.join(F.broadcast(ref.profile.select("feature", F.col("counts").alias("r_counts"))), "feature", "left")
    some = F.kll_sketch_get_n_double("sketch") > 0
    gap = F.lit(None).cast("double")
    for f, (points, ranks) in ref.grid.items():
        gaps = F.zip_with(F.kll_sketch_get_rank_double("sketch", F.lit(points)), F.lit(ranks), lambda a, b: F.abs(a - b))
        gap = F.when((F.col("feature") == f) & some, F.array_max(gaps)).otherwise(gap)
    t, rt = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x), F.aggregate("r_counts", F.lit(0).cast("long"), lambda a, x: a + x)

    def term(x: Column, m: Column) -> Column:
        return F.when(x > 0, 0.5 * x * F.log(x / m)).otherwise(0.0)

    js = F.aggregate(F.zip_with("r_counts", "counts", lambda a, b: term(a / rt, (a / rt + b / t) / 2) + term(b / t, (a / rt + b / t) / 2)),
                     F.lit(0.0), lambda a, x: a + x)
    score = F.coalesce(gap, F.when((t > 0) & (rt > 0), F.sqrt(F.greatest(js, F.lit(0.0)))))
    s = own.withColumn("score", score)
    full = F.col("n") - F.col("missing")
    return s.groupBy("day").agg(
        F.max(F.when(F.col("feature") == prediction, F.col("score"))).alias("prediction_drift"),
        F.sum((F.col("score") >= DR.COLUMN_DRIFT_THRESHOLD).cast("long")).alias("num_drifted_columns"),
        (F.sum("missing") / F.sum("n")).alias("share_missing_values"),
        F.max(F.when((F.col("feature") == quantile_col) & some, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)))).alias("quantile"),
        F.max(F.when((F.col("feature") == quantile_col) & (full > 0), F.col("inside") / full)).alias("value_range"),
        F.max("n").alias("events")).select(F.col("day").cast("timestamp_ntz").alias("timestamp"), "prediction_drift", "num_drifted_columns",
                                           "share_missing_values", "quantile", "value_range", "events", "day")


def window_profiles(stream: DataFrame, ref: Reference, delay: str = "1 day", numeric: Sequence[str] = NUMERIC,
                    categorical: Sequence[str] = CATEGORICAL, k: int = K) -> DataFrame:
    """The stateful part: (window, feature) rows of closed days."""
    rows = tokens(stream, numeric, categorical).withWatermark("ts", delay)
    return _profile(rows, [F.window("ts", "1 day").alias("w")], ref.ranges, ref.categories, k)


def start_daily_metrics(spark: SparkSession, stream: DataFrame, ref: Reference, out: str, checkpoint: str, delay: str = "1 day",
                        prediction: str = "value", quantile_col: str = "value", available_now: bool = True):
    """Start the monitor over a stream of events; returns the ``StreamingQuery``.
    A day's partition is replaced, so a replayed micro-batch changes nothing."""
    def write(batch: DataFrame, epoch: int) -> None:
        days = materialize(_rows(batch, F.to_date(F.col("w.start"))))
        if not days.isEmpty():
            _write_days(_metrics(days, ref, prediction, quantile_col), out)

    w = window_profiles(stream, ref, delay).writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def flush_open_days(events: DataFrame, ref: Reference, out: str, prediction: str = "value", quantile_col: str = "value",
                    numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL) -> None:
    """After the end of the input: the days that the watermark has not closed,
    from the stored events. Written days stay as they are."""
    day = F.to_date("ts")
    still = events.where(day.isNotNull()).withColumn("_day", day)
    if path_exists(events.sparkSession, out):
        written = events.sparkSession.read.schema("day DATE").parquet(out).select(F.col("day").alias("_day")).distinct()
        still = still.join(F.broadcast(written), "_day", "left_anti")  # a row a day
    rows = tokens(still, numeric, categorical)
    days = materialize(_rows(_profile(rows, [F.to_date("ts").alias("_day")], ref.ranges, ref.categories), F.col("_day")))
    if not days.isEmpty():
        _write_days(_metrics(days, ref, prediction, quantile_col), out)


def late_events(events: DataFrame, out: str) -> DataFrame:
    """(day, late): how many of the stored events of each written day came after
    the day was closed."""
    written = events.sparkSession.read.schema("events LONG, day DATE").parquet(out)
    stored = events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("stored"))
    return stored.join(F.broadcast(written), "day").select("day", (F.col("stored") - F.col("events")).alias("late"))  # a row a day


def dropped_rows(query) -> int:
    """Partial rows that the stream's state has refused as too late."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def state_rows(query) -> int:
    """The most rows that the state has held."""
    return max((s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]), default=0)


def events_of(spark: SparkSession, folder: str) -> DataFrame:
    """The stored events, as ``event_stream`` streams them."""
    return DR.events_with_props(spark.read.parquet(f"{folder}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")))


def run_to_the_end(spark: SparkSession, folder: str, out: str, checkpoint: str):
    """Stream a folder's events, then flush the days that are still open."""
    events = events_of(spark, folder)
    first = events.select(F.min(F.to_date("ts"))).first()[0]  # one scalar
    ref = reference(events, first)
    query = start_daily_metrics(spark, event_stream(spark, folder), ref, out, checkpoint)
    query.awaitTermination()
    flush_open_days(events, ref, out)
    return query
