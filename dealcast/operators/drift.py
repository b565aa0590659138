"""Drift and monitoring.

Reference and current data are two tagged sides of one long table, so every
period pair (e.g. each snapshot against the previous one) is compared in one
plan. Numeric columns get the exact two-sample Kolmogorov-Smirnov distance
(max ECDF gap, from distributed running totals over merged distinct values);
categorical columns the Jensen-Shannon distance (natural log) of value
shares. Both are distances: higher means more drift.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from dealcast.operators.stats import attach_stats, exact_quantiles, running_totals

# Drift and alert thresholds.
COLUMN_DRIFT_THRESHOLD = 0.1
DATASET_DRIFT_SHARE = 0.5
PREDICTION_DRIFT_DETECTED = 0.1
ALERT_HIGH_SCORE, ALERT_MEDIUM_SCORE = 0.2, 0.1
ALERT_MEDIUM_COLUMNS, ALERT_LOW_COLUMNS = 5, 2
PAIR = ["ref_period", "cur_period"]


def consecutive_pairs(df: DataFrame, period: str) -> DataFrame:
    """(ref_period, cur_period) for each period and the one before it. The
    distinct periods are few (calendar-bounded), so one window ranks them."""
    p = df.select(F.col(period).alias("cur_period")).where(F.col("cur_period").isNotNull()).distinct()
    w = Window.orderBy("cur_period")
    return p.select(F.lag("cur_period").over(w).alias("ref_period"), "cur_period") \
        .where(F.col("ref_period").isNotNull())


def sides(df: DataFrame, period: str, pairs: DataFrame) -> DataFrame:
    """Rows tagged ``side`` = 'ref' / 'cur' for every pair they belong to.
    ``pairs`` has one row per period (calendar-bounded): broadcast."""
    pb = F.broadcast(pairs)
    ref = df.join(pb, df[period] == pb["ref_period"]).withColumn("side", F.lit("ref"))
    cur = df.join(pb, df[period] == pb["cur_period"]).withColumn("side", F.lit("cur"))
    return ref.unionByName(cur)


def _long(tagged: DataFrame, cols: Sequence[str], cast: str) -> DataFrame:
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS {cast})" for c in cols)
    return tagged.select(*PAIR, "side", F.expr(f"stack({len(cols)}, {pairs}) AS (feature, value)"))


def numeric_drift(tagged: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D3: KS distance per (pair, column) over non-null values."""
    long = _long(tagged, cols, "DOUBLE").where(F.col("value").isNotNull())
    return ks_from_counts(side_counts(long, [*PAIR, "feature"]))


def side_counts(long: DataFrame, key: Sequence[str], weight: str | None = None) -> DataFrame:
    """Rows per (key, value) on each side (``weight`` sums pre-counted rows)."""
    w = F.col(weight) if weight else F.lit(1)
    return long.groupBy(*key, "value").agg(
        F.sum(F.when(F.col("side") == "ref", w).otherwise(0)).alias("n_ref"),
        F.sum(F.when(F.col("side") == "cur", w).otherwise(0)).alias("n_cur"))


def ks_from_counts(counts: DataFrame, key: Sequence[str] = (*PAIR, "feature")) -> DataFrame:
    """Exact KS from per-value side counts: the largest gap between the two
    ECDFs over the merged distinct values (distributed running totals)."""
    key = list(key)
    j = (running_totals(counts, ["value"], ["n_ref", "n_cur"], by=key, totals="all_")
         .withColumnsRenamed({"all_n_ref": "t_ref", "all_n_cur": "t_cur"}))
    gap = F.abs(F.col("cum_n_ref") / F.col("t_ref") - F.col("cum_n_cur") / F.col("t_cur"))
    score = j.groupBy(*key).agg(F.max(F.when((F.col("t_ref") > 0) & (F.col("t_cur") > 0), gap)).alias("drift_score"))
    return score.withColumns({"stattest": F.lit("ks"),
                              "drifted": F.coalesce(F.col("drift_score") >= COLUMN_DRIFT_THRESHOLD, F.lit(False))})


def categorical_drift(tagged: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Jensen-Shannon distance of value shares per (pair, column); a
    value absent on one side has share 0 there (a full outer join in effect,
    done as one grouped count). Nulls are not a category."""
    long = _long(tagged, cols, "STRING").where(F.col("value").isNotNull())
    return js_from_counts(side_counts(long, [*PAIR, "feature"]))


def js_from_counts(counts: DataFrame, key: Sequence[str] = (*PAIR, "feature")) -> DataFrame:
    key = list(key)
    tot = counts.groupBy(*key).agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    j = counts.join(tot, key, "inner")
    p = F.col("n_ref") / F.col("t_ref")
    q = F.col("n_cur") / F.col("t_cur")
    m = (p + q) / 2
    term = (F.when(p > 0, 0.5 * p * F.log(p / m)).otherwise(0.0)
            + F.when(q > 0, 0.5 * q * F.log(q / m)).otherwise(0.0))
    score = j.where((F.col("t_ref") > 0) & (F.col("t_cur") > 0)).groupBy(*key) \
        .agg(F.sqrt(F.greatest(F.sum(term), F.lit(0.0))).alias("drift_score"))
    return score.withColumns({"stattest": F.lit("jensenshannon"),
                              "drifted": F.coalesce(F.col("drift_score") >= COLUMN_DRIFT_THRESHOLD, F.lit(False))})


def column_drift(tagged: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    return numeric_drift(tagged, numeric).unionByName(categorical_drift(tagged, categorical))


def paired_counts(counts: DataFrame, period: str, pairs: DataFrame) -> DataFrame:
    """(ref_period, cur_period, feature, value, n_ref, n_cur) from counts by
    period: each period's rows are counted once and only its counts take part
    in two pairs. ``pairs`` has one row a period (calendar-bounded): broadcast."""
    roles = pairs.select(F.col("ref_period").alias("_own"), *PAIR, F.lit(True).alias("_ref")).unionByName(
        pairs.select(F.col("cur_period").alias("_own"), *PAIR, F.lit(False).alias("_ref")))
    both = counts.join(F.broadcast(roles), F.col(period) == F.col("_own"))
    return both.groupBy(*PAIR, "feature", "value").agg(F.sum(F.when(F.col("_ref"), F.col("n")).otherwise(0)).alias("n_ref"),
                                                       F.sum(F.when(F.col("_ref"), 0).otherwise(F.col("n"))).alias("n_cur"))


def period_drift(df: DataFrame, period: str, pairs: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """``column_drift`` of every pair of periods from one count of the
    numeric and one of the categorical columns."""
    ks = ks_from_counts(paired_counts(period_counts(df, period, numeric, "DOUBLE"), period, pairs))
    return ks.unionByName(js_from_counts(paired_counts(period_counts(df, period, categorical, "STRING"), period, pairs)))


def wasserstein(counts: DataFrame, key: Sequence[str] = (*PAIR, "feature")) -> DataFrame:
    """D3: the 1-Wasserstein distance of two samples from per-value side counts:
    the area between their ECDFs, which are flat from each merged value to the
    next. ``normed`` is in standard deviations of the reference (0.001 at least)."""
    key = list(key)
    r = running_totals(counts, ["value"], ["n_ref", "n_cur"], by=key, totals="all_", following="next")
    gap = F.abs(F.col("cum_n_ref") / F.col("all_n_ref") - F.col("cum_n_cur") / F.col("all_n_cur"))
    both = r.where("all_n_ref > 0 AND all_n_cur > 0")
    mean = counts.groupBy(*key).agg(F.try_divide(F.sum(F.col("value") * F.col("n_ref")), F.sum("n_ref")).alias("_mean"))
    # a row a pair and column
    off = both.join(F.broadcast(mean), key)
    g = off.groupBy(*key).agg(F.sum(F.coalesce(gap * (F.col("next") - F.col("value")), F.lit(0.0))).alias("wasserstein"),
                              F.sqrt(F.sum(F.col("n_ref") * (F.col("value") - F.col("_mean")) * (F.col("value") - F.col("_mean"))) / F.sum("n_ref")).alias("_sd"))
    return g.select(*key, "wasserstein", (F.col("wasserstein") / F.greatest("_sd", F.lit(0.001))).alias("normed"))


def reference_bins(counts: DataFrame, bins: int = 10, key: Sequence[str] = (*PAIR, "feature")) -> DataFrame:
    """The inner edges of ``bins`` bins of about equal size of the reference:
    the smallest values that at least a tenth, two tenths ... of it don't exceed.
    Repeated edges are one; a reference without values has none. A fitted state:
    write it to compare later data with the same bins."""
    key = list(key)
    r = running_totals(counts, ["value"], ["n_ref"], by=key, totals="all_")
    edge = [F.min(F.when(F.col("cum_n_ref") * bins >= i * F.col("all_n_ref"), F.col("value"))).alias(f"_e{i}") for i in range(1, bins)]
    g = r.where("all_n_ref > 0").groupBy(*key).agg(*edge)
    return g.select(*key, F.array_sort(F.array_distinct(F.array(*[f"_e{i}" for i in range(1, bins)]))).alias("edges"))


def population_stability(counts: DataFrame, bins: DataFrame, floor: float = 1e-4, key: Sequence[str] = (*PAIR, "feature")) -> DataFrame:
    """The population stability index over ``reference_bins``. A value lies in
    the bin of as many edges as are smaller; a bin that one side leaves empty has
    the share ``floor`` there, one that both leave empty adds nothing."""
    key = list(key)
    placed = counts.join(F.broadcast(bins), key)  # a row a pair and column
    placed = placed.withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("value"))))
    own = placed.groupBy(*key, "bin").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    whole = own.groupBy(*key).agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    p, q = (F.greatest(F.col(f"n_{x}") / F.col(f"t_{x}"), F.lit(floor)) for x in ("ref", "cur"))
    return (own.join(F.broadcast(whole), key).where("t_ref > 0 AND t_cur > 0").groupBy(*key)
            .agg(F.sum((q - p) * F.log(q / p)).alias("psi"), F.count("*").alias("bins")))


def dataset_drift(col_drift: DataFrame, share: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """Drifted-column count and share per pair; drift when share >= 0.5."""
    g = col_drift.groupBy(*PAIR).agg(F.count("*").alias("num_columns"),
                                     F.sum(F.col("drifted").cast("int")).alias("num_drifted_columns"))
    return g.withColumns({"share_drifted_columns": F.col("num_drifted_columns") / F.col("num_columns"),
                          "dataset_drift": F.col("num_drifted_columns") / F.col("num_columns") >= share})


def missing_share(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Share of missing cells over ``cols``."""
    nulls = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    return df.groupBy(*by).agg((F.sum(nulls) / (F.count("*") * len(cols))).alias("share_missing_values"))


def in_range_share(tagged: DataFrame, value: str) -> DataFrame:
    """Share of current values within the reference [min, max]."""
    ref = tagged.where(F.col("side") == "ref").groupBy(*PAIR).agg(
        F.min(value).alias("_rmin"), F.max(value).alias("_rmax"))
    cur = tagged.where((F.col("side") == "cur") & F.col(value).isNotNull()).join(ref, PAIR, "inner")
    v = F.col(value)
    return cur.groupBy(*PAIR).agg(F.avg(((v >= F.col("_rmin")) & (v <= F.col("_rmax"))).cast("double"))
                                  .alias("value_range_share"))


def classification_quality(df: DataFrame, label: str = "is_won", score: str = "prediction",
                           by: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """D9 (+ M7): accuracy, precision, recall, F1, Brier and exact ROC AUC.

    AUC is the Mann-Whitney statistic over distinct scores (ties count half):
    scores are counted per (group, score), ranked with distributed running
    totals, and each score's positives are credited with the negatives below.
    """
    by = list(by)
    y = F.col(label).cast("int")
    yhat = (F.col(score) >= threshold).cast("int")
    base = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    g = base.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum(y * yhat).alias("tp"), F.sum((1 - y) * yhat).alias("fp"),
        F.sum(y * (1 - yhat)).alias("fn"), F.sum((1 - y) * (1 - yhat)).alias("tn"),
        F.avg((F.col(score) - y) * (F.col(score) - y)).alias("brier"))
    per_score = base.groupBy(*by, F.col(score).cast("double").alias("_s")).agg(
        F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg"))
    ranked = running_totals(per_score, ["_s"], ["_neg"], by=by)
    auc = ranked.groupBy(*by).agg(
        F.sum(F.col("_pos") * (F.col("cum__neg") - 0.5 * F.col("_neg"))).alias("_u"),
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_q"))
    auc = auc.select(*by, F.when((F.col("_p") > 0) & (F.col("_q") > 0),
                                 F.col("_u") / (F.col("_p") * F.col("_q"))).alias("roc_auc"))
    j = g.join(auc, by, "left") if by else attach_stats(g, auc, by)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    return j.select(*by, "n", "tp", "fp", "fn", "tn",
                    ((tp + F.col("tn")) / F.col("n")).alias("accuracy"), prec.alias("precision"),
                    rec.alias("recall"),
                    F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0).alias("f1"),
                    "brier", "roc_auc")


def class_balance(df: DataFrame, label: str = "is_won", by: Sequence[str] = ()) -> DataFrame:
    """D10."""
    return df.groupBy(*by, F.col(label).alias("label")).agg(F.count("*").alias("count"))


def confusion_matrix(df: DataFrame, label: str = "is_won", score: str = "prediction",
                     by: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """D11."""
    return df.where(F.col(score).isNotNull()).groupBy(
        *by, F.col(label).cast("int").alias("actual"),
        (F.col(score) >= threshold).cast("int").alias("predicted")).agg(F.count("*").alias("count"))


def roc_points(df: DataFrame, label: str = "is_won", score: str = "prediction",
               by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score t - TPR and FPR of ``score >= t``.
    Counts above each threshold come from distributed running totals over
    the negated score (descending order)."""
    by = list(by)
    y = F.col(label).cast("int")
    per = df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("threshold")) \
        .agg(F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg")).withColumn("_desc", -F.col("threshold"))
    j = (running_totals(per, ["_desc"], ["_pos", "_neg"], by=by, totals="_all")
         .withColumnsRenamed({"_all_pos": "_P", "_all_neg": "_Q"}))
    return j.select(*by, "threshold",
                    F.when(F.col("_P") > 0, F.col("cum__pos") / F.col("_P")).alias("tpr"),
                    F.when(F.col("_Q") > 0, F.col("cum__neg") / F.col("_Q")).alias("fpr"))


def alert_level(dataset_drift_flag: Column, prediction_drift: Column, drifted: Column) -> Column:
    """HIGH on dataset drift or prediction drift > .2; MEDIUM on > .1 or
    more than 5 drifted columns; LOW on more than 2; else NONE."""
    pd_ = F.coalesce(prediction_drift, F.lit(0.0))
    return (F.when(F.coalesce(dataset_drift_flag, F.lit(False)) | (pd_ > ALERT_HIGH_SCORE), "HIGH")
            .when((pd_ > ALERT_MEDIUM_SCORE) | (drifted > ALERT_MEDIUM_COLUMNS), "MEDIUM")
            .when(drifted > ALERT_LOW_COLUMNS, "LOW").otherwise("NONE"))


def tests_against_reference(suite: DataFrame, pairs: DataFrame, period: str) -> DataFrame:
    """Whether a period's quality counts (V16) are no worse than its reference
    period's: no more columns with missing values or constant ones, as many
    duplicated columns, and rows with missing values or repeated ones in the
    reference's proportion, within a tenth. One row a pair."""
    cols = ("rows", "columns_with_missing", "rows_with_missing", "constant_columns", "duplicated_columns", "duplicated_rows")
    ref = suite.select(F.col(period).alias("ref_period"), *[F.col(c).alias(f"r_{c}") for c in cols])
    cur = suite.select(F.col(period).alias("cur_period"), *cols)
    scale = F.col("rows") / F.col("r_rows")
    copies = F.col("r_duplicated_rows") * scale
    passed = ((F.col("columns_with_missing") <= F.col("r_columns_with_missing"))
              & (F.col("rows_with_missing") <= F.col("r_rows_with_missing") * scale * 1.1)
              & (F.col("constant_columns") <= F.col("r_constant_columns"))
              & (F.col("duplicated_columns") == F.col("r_duplicated_columns"))
              & (F.abs(F.col("duplicated_rows") - copies) <= copies * 0.1))
    # a row a period on each side
    return (pairs.join(F.broadcast(ref), "ref_period").join(F.broadcast(cur), "cur_period")
            .select(*PAIR, passed.alias("quality_passed")))


def monitoring_summary(df: DataFrame, period: str, pairs: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                       prediction: str = "prediction", label: str = "is_won",
                       quality: DataFrame | None = None) -> DataFrame:
    """D5, D6, D9, D13-D15 per pair: dataset drift, prediction drift (KS of
    the prediction, ranked together with the other columns), drifted columns,
    missing share, classification quality on the current side, drift flag, alert
    level and health: no drift and, with ``quality`` (a row a pair), passed tests.
    Everything is counted by period; the pairs meet in the counts."""
    from dealcast.session import materialize
    cd = materialize(period_drift(df, period, pairs, [*numeric, prediction], categorical))
    ds = dataset_drift(cd.where(F.col("feature") != prediction))
    pred = cd.where(F.col("feature") == prediction).select(*PAIR, F.col("drift_score").alias("prediction_drift"))
    miss = missing_share(df, list(numeric) + list(categorical), [period]).withColumnRenamed(period, "cur_period")
    qual = classification_quality(df.where(F.col(label).isNotNull()), label, prediction, by=[period]) \
        .select(F.col(period).alias("cur_period"), "accuracy", "precision", "recall", "f1", "roc_auc")
    j = ds.join(pred, PAIR, "left").join(miss, "cur_period", "left").join(qual, "cur_period", "left")
    j = j.join(quality, PAIR, "left") if quality is not None else j.withColumn("quality_passed", F.lit(True))
    detected = F.col("dataset_drift") | F.coalesce(F.col("prediction_drift") > PREDICTION_DRIFT_DETECTED, F.lit(False))
    return j.withColumns({
        "quality_passed": F.coalesce("quality_passed", F.lit(False)),
        "drift_detected": detected,
        "alert_level": alert_level(F.col("dataset_drift"), F.col("prediction_drift"), F.col("num_drifted_columns")),
        "healthy": ~detected & F.coalesce("quality_passed", F.lit(False))})


def alerts(summary: DataFrame) -> DataFrame:
    """One alert row per pair with drift, with its message."""
    return summary.where(F.col("drift_detected")).select(
        *PAIR, "alert_level",
        F.format_string("Drift detected for %s vs %s: %d drifted columns, prediction drift %.3f",
                        F.col("cur_period"), F.col("ref_period"), F.col("num_drifted_columns"),
                        F.coalesce(F.col("prediction_drift"), F.lit(0.0))).alias("message"))


def drift_history(summary: DataFrame) -> DataFrame:
    """Trend by current period with the .1/.2 markers and the change in
    prediction drift since the previous period (few rows: one per period)."""
    w = Window.orderBy("cur_period")
    return summary.select(
        "cur_period", "prediction_drift", "num_drifted_columns", "alert_level",
        (F.col("prediction_drift") - F.lag("prediction_drift").over(w)).alias("prediction_drift_change"),
        F.coalesce(F.col("prediction_drift") > 0.1, F.lit(False)).alias("above_warning"),
        F.coalesce(F.col("prediction_drift") > 0.2, F.lit(False)).alias("above_critical"))


def performance_drop(summary: DataFrame, metric: str = "roc_auc", threshold: float = 0.05) -> DataFrame:
    """The metric fell by more than ``threshold`` from the previous period."""
    w = Window.orderBy("cur_period")
    prev = F.lag(metric).over(w)
    return summary.select("cur_period", metric, (prev - F.col(metric)).alias(f"{metric}_drop"),
                          F.coalesce(prev - F.col(metric) > threshold, F.lit(False)).alias("performance_drift"))


def fixed_reference_ks(counts: DataFrame, period: str, reference: Column) -> DataFrame:
    """Exact KS distance of every period to one reference period, from counts
    ``(period, feature, value, n)``: ``(period, feature, drift_score)``.

    The reference's cumulative counts are taken once per feature over all
    values, each period's own over its values; no row of the reference is
    repeated for a period. Between two values of a period its ECDF is flat, so
    the largest gap is at one of its values or just before it."""
    per_value = counts.groupBy("feature", "value").agg(
        F.sum(F.when(F.col(period) == reference, F.col("n")).otherwise(0)).alias("ref"))
    base = running_totals(per_value, ["value"], ["ref"], by=["feature"], totals="all_")
    own = running_totals(counts, ["value"], ["n"], by=[period, "feature"], totals="all_")
    j = own.join(base, ["feature", "value"])
    at = F.abs(F.col("cum_n") / F.col("all_n") - F.col("cum_ref") / F.col("all_ref"))
    before = F.abs((F.col("cum_n") - F.col("n")) / F.col("all_n") - (F.col("cum_ref") - F.col("ref")) / F.col("all_ref"))
    return j.where("all_ref > 0").groupBy(period, "feature").agg(F.max(F.greatest(at, before)).alias("drift_score"))


def fixed_reference_js(counts: DataFrame, period: str, reference: Column) -> DataFrame:
    """Jensen-Shannon distance of every period to one reference period, from
    counts of category values. Values that only the reference has add half of
    their share times log 2, which is their total share less the shared ones."""
    totals = counts.groupBy(period, "feature").agg(F.sum("n").alias("t"))
    ref = counts.where(F.col(period) == reference).select("feature", "value", F.col("n").alias("r"))
    t_ref = totals.where(F.col(period) == reference).select("feature", F.col("t").alias("tr"))
    j = (counts.join(totals, [period, "feature"]).join(F.broadcast(t_ref), "feature").join(ref, ["feature", "value"], "left"))
    p, q = F.coalesce(F.col("r"), F.lit(0)) / F.col("tr"), F.col("n") / F.col("t")
    m = (p + q) / 2
    term = F.when(p > 0, 0.5 * p * F.log(p / m)).otherwise(0.0) + 0.5 * q * F.log(q / m)
    g = j.groupBy(period, "feature").agg(F.sum(term).alias("_s"), F.sum(p).alias("_p"))
    lone = (F.lit(1.0) - F.col("_p")) * 0.5 * F.log(F.lit(2.0))
    return g.select(period, "feature", F.sqrt(F.greatest(F.col("_s") + lone, F.lit(0.0))).alias("drift_score"))


def period_counts(df: DataFrame, period: str, cols: Sequence[str], cast: str) -> DataFrame:
    """(period, feature, value, n) of the non-null values: one pass, partial counts.
    A column is its number until the values are counted, and whole numbers become
    text only then: what is hashed and shuffled is of fixed width."""
    whole = cast == "STRING" and all(isinstance(df.schema[c].dataType, IntegralType) for c in cols)
    pairs = ", ".join(f"{i}, CAST(`{c}` AS {'BIGINT' if whole else cast})" for i, c in enumerate(cols))
    long = df.select(period, F.expr(f"stack({len(cols)}, {pairs}) AS (_column, value)"))
    counted = long.where(F.col("value").isNotNull()).groupBy(period, "_column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(period, F.array(*[F.lit(c) for c in cols])[F.col("_column")].alias("feature"), F.col("value").cast(cast).alias("value"), "n")


def daily_metrics(events: DataFrame, ts: str = "ts", prediction: str = "value",
                  numeric: Sequence[str] = ("value", "k"), categorical: Sequence[str] = ("event_type",),
                  quantile_col: str = "value", reference_day: Column | None = None) -> DataFrame:
    """Per day - prediction drift, drifted columns, share of missing
    values, median and share in the reference range, every day against one
    fixed reference day (the first day by default). One plan, no day loop, and
    the reference day's rows are counted once."""
    from dealcast.session import materialize
    day = F.to_date(F.col(ts))
    ref_day = reference_day if reference_day is not None else events.select(F.min(day)).scalar()
    cols = list(dict.fromkeys([*numeric, *categorical, quantile_col, prediction]))
    ev = events.select(day.alias("day"), *cols).where(F.col("day").isNotNull())
    features = list(dict.fromkeys([*numeric, prediction]))
    nums = materialize(period_counts(ev, "day", list(dict.fromkeys([*features, quantile_col])), "DOUBLE"))
    ks = materialize(fixed_reference_ks(nums.where(F.col("feature").isin(*features)), "day", ref_day))
    scores = ks.where(F.col("feature").isin(*numeric))
    if categorical:
        scores = scores.unionByName(fixed_reference_js(materialize(period_counts(ev, "day", categorical, "STRING")), "day", ref_day))
    drifted = scores.groupBy("day").agg(F.sum((F.col("drift_score") >= COLUMN_DRIFT_THRESHOLD).cast("int")).alias("num_drifted_columns"))
    pred = ks.where(F.col("feature") == prediction).select("day", F.col("drift_score").alias("prediction_drift"))
    # the reference's range: one row, two scalars
    own = nums.where(F.col("feature") == quantile_col)
    ref = own.where(F.col("day") == ref_day)
    low, high = ref.select(F.min("value")).scalar(), ref.select(F.max("value")).scalar()
    inside = own.groupBy("day").agg((F.sum(F.when(F.col("value").between(low, high), F.col("n")).otherwise(0)) / F.sum("n")).alias("value_range"))
    med = exact_quantiles(own, "value", [0.5], by=["day"], names=["quantile"], weight="n")
    miss = missing_share(ev, list(numeric) + list(categorical), ["day"])
    j = pred
    for side in (drifted, miss, med, inside):  # a row a day
        j = j.join(side, "day", "left")
    return j.select(F.col("day").cast("timestamp_ntz").alias("timestamp"), "prediction_drift",
                    F.col("num_drifted_columns").cast("long").alias("num_drifted_columns"),
                    "share_missing_values", "quantile", "value_range")


def events_with_props(events: DataFrame) -> DataFrame:
    """Events with the JSON ``props`` field ``k`` extracted."""
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("double"))
