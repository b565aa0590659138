"""Structured Streaming monitors (ST1, ST2).

ST1 keeps, per one-day event-time window, the count of every (feature,
value) pair in state; the watermark closes a window one day after its end and
append mode emits it once, final. ``foreachBatch`` turns the closed windows'
counts into the daily metrics against a static reference day and writes them
with dynamic partition overwrite by day, so a replayed micro-batch rewrites
the same partitions (idempotent). Events later than the watermark are
dropped, as Structured Streaming does.

ST2 runs the batch quality checks on every micro-batch and commits the check
rows under the batch's id, so a replayed micro-batch adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from dealcast.operators import drift as DR
from dealcast.operators.quality import missing_values
from dealcast.operators.stats import attach_row, exact_quantiles
from dealcast.session import materialize
from dealcast.sources.committed import CommittedTable

NUMERIC = ("value", "k")
CATEGORICAL = ("event_type",)


def event_stream(spark: SparkSession, folder: str, name: str = "events", max_files: int | None = None) -> DataFrame:
    """Parquet files of a table as a stream (event time as TIMESTAMP)."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    s = r.parquet(folder)
    return DR.events_with_props(s.withColumn("ts", F.col("ts").cast("timestamp")))


def tokens(df: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL) -> DataFrame:
    """One row per (event, feature): numeric value or category (null kept, so
    missing values are counted too)."""
    parts = [f"'{c}', CAST(`{c}` AS DOUBLE), CAST(NULL AS STRING)" for c in numeric]
    parts += [f"'{c}', CAST(NULL AS DOUBLE), CAST(`{c}` AS STRING)" for c in categorical]
    n = len(parts)
    return df.select("ts", F.expr(f"stack({n}, {', '.join(parts)}) AS (feature, num, cat)"))


def window_counts(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Stateful part: per day window, the count of each (feature, value)."""
    t = tokens(stream).withWatermark("ts", delay)
    return t.groupBy(F.window("ts", "1 day").alias("w"), "feature", "num", "cat").agg(F.count("*").alias("n"))


def reference_counts(events: DataFrame, day) -> DataFrame:
    """The static reference day in the same (feature, num, cat, n) shape."""
    ev = DR.events_with_props(events).withColumn("ts", F.col("ts").cast("timestamp"))
    ref = ev.where(F.to_date("ts") == F.lit(day))
    return tokens(ref).groupBy("feature", "num", "cat").agg(F.count("*").alias("n"))


def metrics_from_counts(cur: DataFrame, ref: DataFrame, prediction: str = "value",
                        quantile_col: str = "value") -> DataFrame:
    """Daily metrics from counts: ``cur`` = (day, feature, num, cat, n) of
    closed windows; ``ref`` = (feature, num, cat, n) of the reference day, which
    is counted once, whatever the number of days."""
    sentinel = F.lit("reference")
    both = materialize(cur.select(F.col("day").cast("string").alias("day"), "feature", "num", "cat", "n")
                       .unionByName(ref.withColumn("day", sentinel)))
    nums = both.where(F.col("num").isNotNull()).select("day", "feature", F.col("num").alias("value"), "n")
    cats = both.where(F.col("cat").isNotNull()).select("day", "feature", F.col("cat").alias("value"), "n")
    ks = DR.fixed_reference_ks(nums, "day", sentinel)
    js = DR.fixed_reference_js(cats, "day", sentinel)
    scores = materialize(ks.unionByName(js).where(F.col("day") != sentinel))
    drifted = scores.groupBy("day").agg(
        F.sum((F.col("drift_score") >= DR.COLUMN_DRIFT_THRESHOLD).cast("int")).cast("long").alias("num_drifted_columns"))
    pred = scores.where(F.col("feature") == prediction).select("day", F.col("drift_score").alias("prediction_drift"))
    c = both.where(F.col("day") != sentinel)
    miss = c.groupBy("day").agg(
        (F.sum(F.when(F.col("num").isNull() & F.col("cat").isNull(), F.col("n")).otherwise(0))
         / F.sum("n")).alias("share_missing_values"))
    qv = c.where((F.col("feature") == quantile_col) & F.col("num").isNotNull())
    med = exact_quantiles(qv, "num", [0.5], by=["day"], names=["quantile"], weight="n")
    rr = ref.where((F.col("feature") == quantile_col) & F.col("num").isNotNull()).agg(
        F.min("num").alias("_rmin"), F.max("num").alias("_rmax"))
    rng = attach_row(qv, rr).groupBy("day").agg(
        (F.sum(F.when((F.col("num") >= F.col("_rmin")) & (F.col("num") <= F.col("_rmax")), F.col("n")).otherwise(0))
         / F.sum("n")).alias("value_range"))
    j = pred.join(drifted, "day", "left").join(miss, "day", "left").join(med, "day", "left").join(rng, "day", "left")
    return j.select(F.col("day").cast("timestamp_ntz").alias("timestamp"), "prediction_drift", "num_drifted_columns",
                    "share_missing_values", "quantile", "value_range", F.to_date("day").alias("day"))


def _write_days(metrics: DataFrame, out: str) -> None:
    """A day's partition is replaced, so writing a day again changes nothing."""
    metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(out)


def start_daily_metrics(spark: SparkSession, folder: str, out: str, checkpoint: str,
                        reference_day, available_now: bool = True):
    """ST1: start the monitor; returns the ``StreamingQuery``."""
    static = spark.read.parquet(f"{folder}/events.parquet")
    ref = reference_counts(static, reference_day)
    counts = window_counts(event_stream(spark, folder))

    def write(batch: DataFrame, epoch: int) -> None:
        cur = batch.select(F.to_date(F.col("w.start")).alias("day"), "feature", "num", "cat", "n")
        _write_days(metrics_from_counts(cur, ref), out)

    w = (counts.writeStream.outputMode("append").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def flush_open_days(spark: SparkSession, folder: str, out: str, reference_day) -> None:
    """ST1 after the end of the input: the days whose windows the watermark has
    not closed yet, from the stored events. Days that the stream has written are
    left alone, and a second flush finds nothing to do."""
    static = spark.read.parquet(f"{folder}/events.parquet")
    day = F.to_date(F.col("ts").cast("timestamp"))
    written = spark.read.schema("day DATE").parquet(out).select("day").distinct()
    # a row a day
    still = static.select(day.alias("day")).where("day is not null").distinct().join(F.broadcast(written), "day", "left_anti")
    open_days = [r.day for r in still.collect()]
    if not open_days:
        return
    events = DR.events_with_props(static).withColumn("ts", F.col("ts").cast("timestamp")).where(day.isin(open_days))
    cur = tokens(events).groupBy(F.to_date("ts").alias("day"), "feature", "num", "cat").agg(F.count("*").alias("n"))
    _write_days(metrics_from_counts(cur, reference_counts(static, reference_day)), out)


def order_stream(spark: SparkSession, folder: str) -> DataFrame:
    """ST2: the orders table as a stream of opportunities (stage, dates and
    value need the order alone)."""
    from dealcast.plans.binding import order_fields
    schema = spark.read.parquet(f"{folder}/orders.parquet").schema
    return order_fields(spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(folder))


def start_quality_gate(spark: SparkSession, folder: str, out: str, checkpoint: str,
                       checks: Callable[[DataFrame], DataFrame] | None = None,
                       available_now: bool = True, stream: DataFrame | None = None, run: str = "gate"):
    """ST2: per micro-batch quality checks committed as rows with the batch id
    (missing values per column by default, plus negative values) to the result
    table ``out``; ``gate_results`` reads it. ``run`` names the stream: with a new
    checkpoint, which counts batches from 0 again, take a new one. ``stream``
    is the events by default; ``order_stream`` with ``business_rules`` checks
    stages, values, date order and closing dates."""
    stream = stream if stream is not None else event_stream(spark, folder)

    def default_checks(b: DataFrame) -> DataFrame:
        mv = missing_values(b.drop("props"))
        neg = b.agg(F.sum(F.when(F.col("value") < 0, 1).otherwise(0)).cast("long").alias("missing"))
        neg = neg.select(F.lit("value<0").alias("column"), "missing",
                         F.lit(None).cast("double").alias("missing_pct"), (F.col("missing") == 0).alias("passed"))
        return mv.unionByName(neg)

    fn = checks or default_checks

    def write(batch: DataFrame, epoch: int) -> None:
        rows = fn(batch).withColumn("batch_id", F.lit(epoch).cast("long"))
        CommittedTable(spark, out, rows.schema).commit(rows, f"{run}-{epoch}")

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def gate_results(spark: SparkSession, out: str) -> DataFrame:
    """The committed check rows of all batches."""
    return CommittedTable(spark, out, spark.read.parquet(f"{out}/rows").schema).read().drop("commit_key")
