"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole test tables. Column names match the oracle's exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dealcast import oracle as O
from dealcast.operators import aggregates as A
from dealcast.plans import datasets as D

BY = D.BY
REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None):
    """Register a builder. Dates are compared with the SQL twin in UTC, and
    the event-time day windows of the streams are UTC days, so the builder
    pins the session time zone."""
    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        build.__name__, build.__doc__ = fn.__name__, fn.__doc__
        REGISTRY[name] = (build, sql)
        return fn
    return deco


# ---------------------------------------------------------------- binding / snapshots

@query("binding_opportunities", O.with_(O.OPPS) + "SELECT * FROM opps")
def q_binding(spark, d):
    return D.opportunities(spark, d)


@query("c10_snapshots", O.with_(O.SNAPS) + "SELECT * FROM snaps")
def q_snapshots(spark, d):
    return D.snapshots(spark, d)


# ---------------------------------------------------------------- aggregations

@query("a1_agent_performance", O.with_(O.SNAPS) + """
SELECT snapshot_period, sales_agent,
       CAST(round_even(CAST(avg(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) AS DECIMAL(38,10)), 3) AS DOUBLE) AS win_rate,
       sum(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) AS total_wins,
       CAST(round_even(CAST(avg(close_value) AS DECIMAL(38,10)), 3) AS DOUBLE) AS avg_deal_value,
       CAST(round_even(sum(CAST(close_value AS DECIMAL(38,10))), 3) AS DOUBLE) AS total_revenue,
       count(*) AS closed_deals
FROM snaps WHERE deal_stage IN ('Won', 'Lost') AND sales_agent IS NOT NULL
GROUP BY snapshot_period, sales_agent""")
def q_a1(spark, d):
    return A.performance(D.snapshots(spark, d), "sales_agent", by=BY)


# ---------------------------------------------------------------- cleaning

@query("c3_clean_snapshots", O.with_(O.CLEAN) + "SELECT * FROM clean")
def q_clean(spark, d):
    return D.cleaned(spark, d)


@query("c4_open_value_zero", O.with_(O.SNAPS) + """
SELECT opportunity_id, deal_stage,
       CASE WHEN deal_stage NOT IN ('Won', 'Lost') AND close_value IS NULL THEN 0.0
            ELSE close_value END AS close_value
FROM snaps""")
def q_c4(spark, d):
    from dealcast.operators.clean import fill_open_value_zero
    return fill_open_value_zero(D.snapshots(spark, d)).select("opportunity_id", "deal_stage", "close_value")


@query("c8_creation_periods", O.with_(O.SNAPS) + """
SELECT creation_year_month, CAST(count(*) AS BIGINT) AS opportunities,
       min(creation_date) AS first_created, max(creation_date) AS last_created
FROM snaps GROUP BY creation_year_month""")
def q_c8(spark, d):
    return D.snapshots(spark, d).groupBy("creation_year_month").agg(
        F.count("*").alias("opportunities"), F.min("creation_date").alias("first_created"),
        F.max("creation_date").alias("last_created"))


@query("c9_rewind_stage_counts", O.with_(O.SNAPS) + """
SELECT snapshot_period, deal_stage, count(*) AS count,
       CAST(sum(CASE WHEN close_date IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS without_close,
       CAST(sum(CASE WHEN engage_date IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS without_engage
FROM snaps GROUP BY snapshot_period, deal_stage""")
def q_c9(spark, d):
    return D.snapshots(spark, d).groupBy("snapshot_period", "deal_stage").agg(
        F.count("*").alias("count"),
        F.sum(F.when(F.col("close_date").isNull(), 1).otherwise(0)).alias("without_close"),
        F.sum(F.when(F.col("engage_date").isNull(), 1).otherwise(0)).alias("without_engage"))


# ---------------------------------------------------------------- features and joins

@query("j4_row_features", O.with_(O.FEAT) + "SELECT * FROM feat")
def q_row_features(spark, d):
    return D.row_features(spark, d)


@query("f22_f25_feature_table", O.with_(O.FEATURE_TABLE) + "SELECT * FROM features")
def q_feature_table(spark, d):
    return D.features(spark, d)


def _codes_sql(c: str) -> str:
    return f"(SELECT v AS {c}_v, dense_rank() OVER (ORDER BY v NULLS LAST) - 1 AS {c}_encoded FROM (SELECT DISTINCT {c} AS v FROM fitted))"


@query("f22_f23_transform_only", O.with_(O.SNAPS) + f""",
fitted AS (SELECT * FROM snaps WHERE snapshot_period <= '1998-06'),
fresh AS (SELECT * FROM snaps WHERE snapshot_period > '1998-06')
SELECT snapshot_period, opportunity_id, """ + ", ".join(f"CAST(coalesce({c}_encoded, 0) AS INTEGER) AS {c}_encoded" for c in ("account", "deal_stage", "product", "sales_agent")) + """,
  (close_value - (SELECT avg(close_value) FROM fitted)) / (SELECT stddev_pop(close_value) FROM fitted) AS close_value_scaled
FROM fresh """ + " ".join(f"LEFT JOIN {_codes_sql(c)} ON {c} IS NOT DISTINCT FROM {c}_v" for c in ("account", "deal_stage", "product", "sales_agent")))
def q_transform_only(spark, d):
    """F22, F23 at inference: codes and scales fitted on the snapshots up to a month, saved, loaded and applied to all later ones."""
    from dealcast.operators.fitted import Encoders
    s, path = D.snapshots(spark, d), _scratch(spark, "encoders")
    before = F.col("snapshot_period") <= "1998-06"
    Encoders.fit(s.where(before), ["sales_agent", "product", "account", "deal_stage"], ["close_value"], growing=["account"]).save(path, "1998-06")
    rows = Encoders.load(spark, path, "1998-06").transform(s.where(~before))
    return rows.select("snapshot_period", "opportunity_id", *[f"{c}_encoded" for c in ("sales_agent", "product", "account", "deal_stage")], "close_value_scaled")


@query("j1_unmatched_agents", O.with_(O.SNAPS, O.TEAMS) + """
SELECT 'sales_agent' AS key_column, count(*) AS unmatched_rows
FROM snaps s WHERE NOT EXISTS (SELECT 1 FROM teams t WHERE t.sales_agent = s.sales_agent)""")
def q_j1_unmatched(spark, d):
    from dealcast.operators.joins import unmatched_count
    teams, _, _ = D.dims(spark, d)
    return unmatched_count(D.snapshots(spark, d), teams, "sales_agent")


@query("j3_product_join", O.with_(O.SNAPS) + """,
prods AS (SELECT p_brand AS product, count(*) AS parts, CAST(round_even(CAST(avg(p_retailprice) AS DECIMAL(38,10)), 2) AS DOUBLE) AS sales_price
          FROM part GROUP BY p_brand)
SELECT s.opportunity_id, s.snapshot_period, s.product, p.parts, p.sales_price
FROM snaps s LEFT JOIN prods p USING (product)""")
def q_j3(spark, d):
    from dealcast.operators.joins import join_products
    _, _, prods = D.dims(spark, d)
    s = D.snapshots(spark, d).select("opportunity_id", "snapshot_period", "product")
    return join_products(s, prods)


@query("j6_agents_with_pipeline", O.with_(O.SNAPS) + """
SELECT s.opportunity_id, s.snapshot_period, s.sales_agent FROM snaps s
WHERE s.deal_stage IN ('Engaging', 'Prospecting') AND EXISTS (
  SELECT 1 FROM (SELECT snapshot_period, sales_agent FROM snaps
                 WHERE deal_stage IN ('Engaging', 'Prospecting')
                 GROUP BY snapshot_period, sales_agent HAVING count(*) >= 3) k
  WHERE k.snapshot_period = s.snapshot_period AND k.sales_agent = s.sales_agent)""")
def q_j6(spark, d):
    from dealcast.operators.joins import having_min_rows
    s = D.snapshots(spark, d).where(F.col("deal_stage").isin("Engaging", "Prospecting"))
    return having_min_rows(s, ["snapshot_period", "sales_agent"], 3) \
        .select("opportunity_id", "snapshot_period", "sales_agent")


@query("j7_invalid_stages", O.with_(O.SNAPS) + """
SELECT DISTINCT deal_stage FROM snaps
WHERE deal_stage IS NULL OR deal_stage NOT IN ('Won', 'Lost', 'Engaging', 'Prospecting')""")
def q_j7(spark, d):
    from dealcast.operators.joins import values_not_in
    return values_not_in(D.snapshots(spark, d), "deal_stage", ["Won", "Lost", "Engaging", "Prospecting"])


@query("w1_account_frequency", O.with_(O.SNAPS) + """
SELECT s.opportunity_id, s.snapshot_period, s.account, a.account_frequency,
       CAST(coalesce(a.account_frequency > 1, false) AS INTEGER) AS is_repeat_account
FROM snaps s LEFT JOIN (SELECT snapshot_period, account, count(*) AS account_frequency FROM snaps
                        GROUP BY 1, 2) a USING (snapshot_period, account)""")
def q_w1(spark, d):
    from dealcast.operators.joins import attach_group_stats
    s = D.snapshots(spark, d).select("opportunity_id", "snapshot_period", "account")
    out = attach_group_stats(s, ["snapshot_period", "account"], {"account_frequency": F.count("*")})
    return out.withColumn("is_repeat_account",
                          F.coalesce(F.col("account_frequency") > 1, F.lit(False)).cast("int"))


# ---------------------------------------------------------------- more aggregations

_CLOSED_SNAPS = "FROM snaps WHERE deal_stage IN ('Won', 'Lost')"


@query("a2_product_performance", O.with_(O.SNAPS) + f"""
SELECT snapshot_period, product,
       CAST(round_even(CAST(avg(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) AS DECIMAL(38,10)), 3) AS DOUBLE) AS win_rate,
       CAST(sum(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) AS BIGINT) AS total_wins,
       CAST(round_even(CAST(avg(close_value) AS DECIMAL(38,10)), 3) AS DOUBLE) AS avg_deal_value,
       CAST(round_even(sum(CAST(close_value AS DECIMAL(38,10))), 3) AS DOUBLE) AS total_revenue, count(*) AS closed_deals
{_CLOSED_SNAPS} AND product IS NOT NULL GROUP BY snapshot_period, product""")
def q_a2(spark, d):
    return A.performance(D.snapshots(spark, d), "product", by=BY)


@query("a3_account_performance", O.with_(O.SNAPS) + f"""
SELECT snapshot_period, account,
       CAST(round_even(CAST(avg(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) AS DECIMAL(38,10)), 3) AS DOUBLE) AS account_win_rate,
       CAST(round_even(sum(CAST(close_value AS DECIMAL(38,10))), 3) AS DOUBLE) AS account_value, count(*) AS account_deals
{_CLOSED_SNAPS} AND account IS NOT NULL GROUP BY snapshot_period, account""")
def q_a3(spark, d):
    return A.account_performance(D.snapshots(spark, d), by=BY)


@query("a4_stage_counts", O.with_(O.SNAPS) + """
SELECT snapshot_period, deal_stage, count(*) AS count FROM snaps
WHERE deal_stage IS NOT NULL GROUP BY snapshot_period, deal_stage""")
def q_a4(spark, d):
    return A.value_counts(D.snapshots(spark, d), "deal_stage", by=BY)


@query("a5_monthly_pattern", O.with_(O.SNAPS) + """
SELECT CAST(month(engage_date) AS INTEGER) AS engage_month, count(*) AS deals,
       CAST(sum(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) AS BIGINT) AS wins,
       CAST(round_even(CAST(avg(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) AS DECIMAL(38,10)), 3) AS DOUBLE) AS win_rate,
       CAST(round_even(CAST(avg(close_value) AS DECIMAL(38,10)), 3) AS DOUBLE) AS avg_value
FROM snaps WHERE engage_date IS NOT NULL GROUP BY 1""")
def q_a5(spark, d):
    return A.monthly_pattern(D.snapshots(spark, d))


@query("a6_win_rate_by_band", O.with_(O.SNAPS) + f"""
SELECT snapshot_period, value_band, count(*) AS deals,
       avg(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) AS win_rate
FROM (SELECT *, {O.VALUE_BAND} AS value_band FROM snaps)
WHERE value_band IS NOT NULL GROUP BY snapshot_period, value_band""")
def q_a6(spark, d):
    return A.win_rate_by_band(D.snapshots(spark, d), by=BY)


@query("a6_win_rate_by_quartile", O.with_(O.SNAPS) + """,
q AS (SELECT quantile_cont(close_value, 0.4) AS q40, quantile_cont(close_value, 0.6) AS q60 FROM snaps)
SELECT CASE WHEN close_value >= q60 THEN 'High' WHEN close_value <= q40 THEN 'Low' ELSE 'Medium' END AS value_category,
       count(*) AS deals, avg(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) AS win_rate
FROM snaps, q GROUP BY 1""")
def q_a6q(spark, d):
    return A.win_rate_by_quartile(D.snapshots(spark, d))


@query("a7_agent_stats_having", O.with_(O.SNAPS) + """
SELECT sales_agent, count(*) AS deals, avg(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) AS win_rate,
       avg(close_value) AS avg_value
FROM snaps WHERE sales_agent IS NOT NULL GROUP BY sales_agent HAVING count(*) >= 10""")
def q_a7(spark, d):
    return A.agent_stats(D.snapshots(spark, d))


@query("a12_value_quantiles", O.with_(O.SNAPS) + """
SELECT snapshot_period, quantile_cont(close_value, 0.25) AS q25, quantile_cont(close_value, 0.5) AS q50,
       quantile_cont(close_value, 0.75) AS q75, quantile_cont(close_value, 0.8) AS q80
FROM snaps WHERE close_value IS NOT NULL GROUP BY snapshot_period""")
def q_a12(spark, d):
    return A.quantiles(D.snapshots(spark, d), "close_value", by=BY)


@query("a13_distinct_counts", O.with_(O.SNAPS) + """
SELECT snapshot_period, count(DISTINCT sales_agent) AS distinct_sales_agent,
       count(DISTINCT product) AS distinct_product, count(DISTINCT account) AS distinct_account,
       count(DISTINCT deal_stage) AS distinct_deal_stage
FROM snaps GROUP BY snapshot_period""")
def q_a13(spark, d):
    return A.distinct_counts(D.snapshots(spark, d), ["sales_agent", "product", "account", "deal_stage"], by=BY)


_SKETCHED = ("opportunity_id", "account", "sales_agent", "product", "deal_stage", "close_date")


@query("a13_a20_stored_sketches", O.with_(O.SNAPS) + "SELECT *, missing / rows AS missing_share, TRUE AS within_bound FROM (" + " UNION ALL ".join(f"""
SELECT left(snapshot_period, 4) AS year, '{c}' AS column, count(DISTINCT snapshot_period) AS periods, count(*) AS rows,
  CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing FROM snaps GROUP BY 1""" for c in _SKETCHED) + ")")
def q_sketches(spark, d):
    """Distinct and missing values of each year from a layer of stored sketches a month, within the stated bound of the exact counts."""
    from dealcast.operators.sketches import period_sketches, relative_error, roll_up
    from dealcast.sources.layers import read_layer, write_layer
    base, s = _scratch(spark, "sketches"), D.snapshots(spark, d)
    layer = period_sketches(s, _SKETCHED, "snapshot_period")
    write_layer(layer, base, "monitoring")
    year = F.substring("snapshot_period", 1, 4).alias("year")
    rolled = roll_up(read_layer(spark, base, "monitoring", schema=layer.schema), year)
    exact = s.groupBy(year).agg(*[F.countDistinct(c).alias(c) for c in _SKETCHED])
    exact = exact.select("year", F.expr(f"stack({len(_SKETCHED)}, " + ", ".join(f"'{c}', `{c}`" for c in _SKETCHED) + ") AS (column, exact)"))
    return rolled.join(F.broadcast(exact), ["year", "column"]).select(  # a row a year and column
        "year", "column", "periods", "rows", "missing", "missing_share", (F.abs(F.col("distinct") - F.col("exact")) <= F.ceil(F.col("exact") * relative_error())).alias("within_bound"))


@query("a14_date_span", O.with_(O.SNAPS) + """
SELECT snapshot_period, min(engage_date) AS min_date, max(engage_date) AS max_date,
       CAST(max(engage_date) - min(engage_date) AS INTEGER) AS span_days
FROM snaps GROUP BY snapshot_period""")
def q_a14(spark, d):
    return A.date_span(D.snapshots(spark, d), "engage_date", by=BY)


@query("a15_describe_value", O.with_(O.SNAPS) + """
SELECT snapshot_period, count(close_value) AS count, avg(close_value) AS mean,
       stddev_samp(close_value) AS std, min(close_value) AS min, max(close_value) AS max,
       quantile_cont(close_value, 0.25) AS p25, quantile_cont(close_value, 0.5) AS p50,
       quantile_cont(close_value, 0.75) AS p75
FROM snaps GROUP BY snapshot_period""")
def q_a15(spark, d):
    return A.describe(D.snapshots(spark, d), "close_value", by=BY)


def _histogram_sql(src: str, value: str, bins: int, split: str) -> str:
    """Each value of ``split`` is a histogram of its own."""
    return f""",
c AS (SELECT {split}, {value} AS v FROM {src} WHERE {value} IS NOT NULL),
r AS (SELECT {split}, min(v) AS lo, max(v) AS hi, count(*) AS n FROM c GROUP BY 1),
b AS (SELECT c.{split}, r.lo, r.hi, r.n,
             CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((c.v - r.lo) / ((r.hi - r.lo) / {bins})), {bins - 1}) END AS INTEGER) AS bin
      FROM c JOIN r USING ({split}))
SELECT {split}, bin, any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / {bins}) AS bin_start,
       any_value(lo) + (bin + 1) * ((any_value(hi) - any_value(lo)) / {bins}) AS bin_end, count(*) AS count,
       CASE WHEN any_value(hi) > any_value(lo) THEN count(*) / (any_value(n) * ((any_value(hi) - any_value(lo)) / {bins})) END AS density
FROM b GROUP BY {split}, bin"""


@query("a16_value_histogram", O.with_(O.SNAPS) + _histogram_sql(
    "(SELECT * FROM snaps WHERE deal_stage IN ('Won', 'Lost'))", "close_value", 20, "deal_stage"))
def q_a16(spark, d):
    s = D.snapshots(spark, d).where(F.col("deal_stage").isin("Won", "Lost"))
    return A.histogram(s, "close_value", bins=20, split="deal_stage")


@query("a16_cycle_histogram", O.with_(O.SNAPS) + _histogram_sql(
    "(SELECT *, CAST(close_date - engage_date AS DOUBLE) AS cycle FROM snaps WHERE deal_stage IN ('Won', 'Lost'))", "cycle", 30, "deal_stage"))
def q_a16_cycle(spark, d):
    """Sales cycle days by outcome, 30 bins, as densities."""
    from dealcast.functions import scalar as S
    s = D.snapshots(spark, d).where(F.col("deal_stage").isin("Won", "Lost")).withColumn("cycle", S.cycle_days().cast("double"))
    return A.histogram(s, "cycle", bins=30, split="deal_stage")


@query("a16_probability_histogram", O.with_(O.SCORED) + _histogram_sql("pipe", "win_probability", 30, "snapshot_period"))
def q_a16_probability(spark, d):
    """Win probability of each period's open pipeline, 30 bins."""
    return A.histogram(D.pipeline(spark, d), "win_probability", bins=30, split="snapshot_period")


@query("a17_monthly_trend", O.with_(O.SNAPS) + """
SELECT CAST(year(engage_date) AS INTEGER) AS year, CAST(month(engage_date) AS INTEGER) AS month,
       count(*) AS count FROM snaps WHERE engage_date IS NOT NULL GROUP BY 1, 2""")
def q_a17(spark, d):
    return A.monthly_trend(D.snapshots(spark, d))


@query("a20_dataset_summary", O.with_(O.SNAPS) + """
SELECT snapshot_period, count(*) AS rows,
       CAST(sum(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) AS BIGINT) AS won,
       CAST(sum(CASE WHEN deal_stage = 'Lost' THEN 1 ELSE 0 END) AS BIGINT) AS lost,
       CAST(sum(CASE WHEN deal_stage = 'Engaging' THEN 1 ELSE 0 END) AS BIGINT) AS engaging,
       CAST(sum(CASE WHEN deal_stage = 'Prospecting' THEN 1 ELSE 0 END) AS BIGINT) AS prospecting,
       CAST(sum(CASE WHEN deal_stage IN ('Won', 'Lost') THEN 1 ELSE 0 END) AS BIGINT) AS closed,
       min(engage_date) AS min_engage, max(engage_date) AS max_engage,
       min(close_date) AS min_close, max(close_date) AS max_close,
       min(close_value) AS min_value, max(close_value) AS max_value, sum(close_value) AS total_value
FROM snaps GROUP BY snapshot_period""")
def q_a20(spark, d):
    return A.dataset_summary(D.snapshots(spark, d), by=BY)


# ---------------------------------------------------------------- monthly features and reports

_M1_COLS = ("opportunity_id", "snapshot_period", "as_of_date", "days_since_engage", "expected_close_date",
            "days_to_expected_close", "should_close_next_month", "is_overdue", "is_early_stage",
            "sales_velocity", "high_value_deal", "long_sales_cycle")


@query("m1_monthly_features", O.with_(O.SCORED) + f"SELECT {', '.join(_M1_COLS)} FROM monthly")
def q_m1(spark, d):
    return D.monthly(spark, d).select(*_M1_COLS)


@query("a8_probability_bands", O.with_(O.SCORED) + """
SELECT snapshot_period, probability_category, count(win_probability) AS count,
       CAST(round_even(CAST(avg(win_probability) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_probability,
       CAST(round_even(sum(CAST(close_value AS DECIMAL(38,10))), 2) AS DOUBLE) AS total_value, CAST(round_even(sum(CAST(expected_revenue AS DECIMAL(38,10))), 2) AS DOUBLE) AS expected_revenue
FROM pipe WHERE probability_category IS NOT NULL GROUP BY snapshot_period, probability_category""")
def q_a8(spark, d):
    from dealcast.operators.reports import probability_band_summary
    return probability_band_summary(D.pipeline(spark, d), by=BY)


@query("a9_agent_insights", O.with_(O.SCORED) + """
SELECT snapshot_period, sales_agent, count(win_probability) AS pipeline_count,
       CAST(round_even(CAST(avg(win_probability) AS DECIMAL(38,10)), 3) AS DOUBLE) AS avg_win_prob, CAST(round_even(sum(CAST(win_probability AS DECIMAL(38,10))), 3) AS DOUBLE) AS total_win_prob,
       CAST(round_even(sum(CAST(expected_revenue AS DECIMAL(38,10))), 3) AS DOUBLE) AS expected_revenue, CAST(round_even(sum(CAST(close_value AS DECIMAL(38,10))), 3) AS DOUBLE) AS total_value
FROM pipe WHERE sales_agent IS NOT NULL GROUP BY snapshot_period, sales_agent""")
def q_a9(spark, d):
    from dealcast.operators.reports import agent_insights
    return agent_insights(D.pipeline(spark, d), by=BY)


@query("a10_pipeline_totals", O.with_(O.SCORED) + """
SELECT snapshot_period, count(*) AS opportunities, sum(close_value) AS total_value,
       sum(expected_revenue) AS expected_revenue, avg(win_probability) AS avg_probability
FROM pipe GROUP BY snapshot_period""")
def q_a10(spark, d):
    from dealcast.operators.reports import pipeline_totals
    return pipeline_totals(D.pipeline(spark, d), by=BY)


@query("a11_revenue_by_band", O.with_(O.SCORED) + """
SELECT snapshot_period, probability_category, sum(expected_revenue) AS expected_revenue
FROM pipe GROUP BY snapshot_period, probability_category""")
def q_a11(spark, d):
    from dealcast.operators.reports import revenue_by_band
    return revenue_by_band(D.pipeline(spark, d), by=BY)


@query("a18_revenue_scenarios", O.with_(O.SCORED) + """
SELECT snapshot_period,
       coalesce(sum(expected_revenue) FILTER (WHERE win_probability > 0.6), 0.0) AS high_probability,
       coalesce(sum(expected_revenue) FILTER (WHERE win_probability BETWEEN 0.3 AND 0.6), 0.0) AS medium_probability,
       0.8 * coalesce(sum(expected_revenue) FILTER (WHERE win_probability > 0.6), 0.0)
         + 0.3 * coalesce(sum(expected_revenue) FILTER (WHERE win_probability BETWEEN 0.3 AND 0.6), 0.0)
         AS conservative
FROM pipe GROUP BY snapshot_period""")
def q_a18(spark, d):
    from dealcast.operators.reports import revenue_scenarios
    return revenue_scenarios(D.pipeline(spark, d), by=BY)


@query("a19_hot_and_at_risk", O.with_(O.SCORED) + """,
q AS (SELECT snapshot_period, quantile_cont(close_value, 0.8) AS q80 FROM pipe GROUP BY 1),
j AS (SELECT p.*, q.q80 FROM pipe p LEFT JOIN q USING (snapshot_period))
SELECT snapshot_period,
       CAST(sum(CASE WHEN win_probability > 0.7 AND close_value > q80 THEN 1 ELSE 0 END) AS BIGINT) AS hot_deals,
       sum(close_value) FILTER (WHERE win_probability > 0.7 AND close_value > q80) AS hot_value,
       sum(expected_revenue) FILTER (WHERE win_probability > 0.7 AND close_value > q80) AS hot_expected_revenue,
       CAST(sum(CASE WHEN win_probability < 0.3 AND days_since_engage > 60 THEN 1 ELSE 0 END) AS BIGINT) AS at_risk_deals,
       sum(close_value) FILTER (WHERE win_probability < 0.3 AND days_since_engage > 60) AS at_risk_value
FROM j GROUP BY snapshot_period""")
def q_a19(spark, d):
    from dealcast.operators.reports import hot_and_at_risk
    return hot_and_at_risk(D.pipeline(spark, d), by=BY)


@query("t2_top_opportunities", O.with_(O.SCORED) + """
SELECT snapshot_period, opportunity_id, sales_agent, account, product, close_value, win_probability,
       expected_revenue, sales_cycle_days, days_since_engage
FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_period
                                   ORDER BY win_probability DESC, opportunity_id) AS rn FROM pipe)
WHERE rn <= 10""")
def q_t2(spark, d):
    from dealcast.operators.reports import top_opportunities
    return top_opportunities(D.pipeline(spark, d), 10, by=BY)


@query("t2_top_agents", O.with_(O.SCORED) + """,
a AS (SELECT snapshot_period, sales_agent, count(win_probability) AS pipeline_count,
             CAST(round_even(CAST(avg(win_probability) AS DECIMAL(38,10)), 3) AS DOUBLE) AS avg_win_prob,
             CAST(round_even(sum(CAST(win_probability AS DECIMAL(38,10))), 3) AS DOUBLE) AS total_win_prob,
             CAST(round_even(sum(CAST(expected_revenue AS DECIMAL(38,10))), 3) AS DOUBLE) AS expected_revenue,
             CAST(round_even(sum(CAST(close_value AS DECIMAL(38,10))), 3) AS DOUBLE) AS total_value
      FROM pipe WHERE sales_agent IS NOT NULL GROUP BY 1, 2)
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY snapshot_period ORDER BY expected_revenue DESC, sales_agent) AS rn
  FROM a) WHERE rn <= 5""")
def q_t2_agents(spark, d):
    from dealcast.operators.reports import top_agents
    return top_agents(D.pipeline(spark, d), 5, by=BY)


_BIN10 = " + ".join(f"(win_probability > CAST({i * 0.1!r} AS DOUBLE))::INT" for i in range(1, 10))


@query("m12_reliability_curve", O.with_(O.SCORED) + f"""
SELECT CAST({_BIN10} AS INTEGER) AS bin, count(*) AS count,
       avg(win_probability) AS mean_predicted, avg(CAST(is_won AS DOUBLE)) AS fraction_positive
FROM scored WHERE is_closed = 1 AND win_probability IS NOT NULL GROUP BY 1""")
def q_m12(spark, d):
    from dealcast.operators.reports import reliability_curve
    return reliability_curve(D.scored(spark, d).where(F.col("is_closed") == 1))


# ---------------------------------------------------------------- windows, splits, samples

@query("w2_known_at_engage", O.with_(O.SNAPS) + """
SELECT s.opportunity_id, s.snapshot_period, s.sales_agent,
       count(h.opportunity_id) AS sales_agent_prior_closed,
       CAST(coalesce(sum(CASE WHEN h.deal_stage = 'Won' THEN 1 ELSE 0 END), 0) AS BIGINT) AS sales_agent_prior_wins,
       CASE WHEN count(h.opportunity_id) > 0
            THEN sum(CASE WHEN h.deal_stage = 'Won' THEN 1 ELSE 0 END) / count(h.opportunity_id) END
         AS sales_agent_prior_win_rate
FROM snaps s LEFT JOIN snaps h
  ON h.snapshot_period = s.snapshot_period AND h.sales_agent = s.sales_agent
 AND h.deal_stage IN ('Won', 'Lost') AND h.close_date < s.engage_date
WHERE s.engage_date IS NOT NULL AND s.sales_agent IS NOT NULL
GROUP BY s.opportunity_id, s.snapshot_period, s.sales_agent""")
def q_w2(spark, d):
    from dealcast.operators.windows import known_at_engage
    from dealcast.session import materialize
    # events, questions and rows are three branches of one written table
    s = materialize(D.snapshots(spark, d).where(F.col("engage_date").isNotNull() & F.col("sales_agent").isNotNull())
                    .select("opportunity_id", "snapshot_period", "sales_agent", "deal_stage", "engage_date", "close_date"))
    out = known_at_engage(s, "sales_agent", by=BY)
    return out.select("opportunity_id", "snapshot_period", "sales_agent",
                      F.coalesce("sales_agent_prior_closed", F.lit(0)).alias("sales_agent_prior_closed"),
                      F.coalesce("sales_agent_prior_wins", F.lit(0)).alias("sales_agent_prior_wins"),
                      "sales_agent_prior_win_rate")


_SPLIT_SQL = O.with_(O.SNAPS) + """,
med AS (SELECT snapshot_period, quantile_cont(close_date - engage_date, 0.5) AS mc
        FROM snaps WHERE deal_stage IN ('Won', 'Lost') GROUP BY 1),
e AS (SELECT s.*, coalesce(CAST(s.close_date AS TIMESTAMP),
                           CAST(s.engage_date AS TIMESTAMP) + to_seconds(floor(coalesce(m.mc, 90.0) * 86400)))
                    AS effective_close
      FROM snaps s LEFT JOIN med m USING (snapshot_period)),
c AS (SELECT opportunity_id, snapshot_period, deal_stage, effective_close,
             CASE WHEN row_number() OVER (PARTITION BY snapshot_period ORDER BY effective_close, opportunity_id)
                       <= floor(count(*) OVER (PARTITION BY snapshot_period) * 0.8) THEN 'train' ELSE 'test' END
               AS split
      FROM e WHERE deal_stage IN ('Won', 'Lost'))"""


@query("w3_temporal_split", _SPLIT_SQL + "SELECT * FROM c")
def q_w3(spark, d):
    from dealcast.operators.windows import temporal_split
    s = D.snapshots(spark, d).select("opportunity_id", "snapshot_period", "deal_stage", "engage_date", "close_date")
    return temporal_split(s, by=BY).select("opportunity_id", "snapshot_period", "deal_stage",
                                           "effective_close", "split")


@query("w4_split_with_open", _SPLIT_SQL + """,
o AS (SELECT opportunity_id, snapshot_period, deal_stage, effective_close,
             CASE WHEN row_number() OVER (PARTITION BY snapshot_period ORDER BY opportunity_id)
                       <= floor(count(*) OVER (PARTITION BY snapshot_period) * 0.8) THEN 'train' ELSE 'test' END
               AS split
      FROM e WHERE deal_stage IS NULL OR deal_stage NOT IN ('Won', 'Lost'))
SELECT * FROM c UNION ALL SELECT * FROM o""")
def q_w4(spark, d):
    from dealcast.operators.windows import temporal_split
    s = D.snapshots(spark, d).select("opportunity_id", "snapshot_period", "deal_stage", "engage_date", "close_date")
    return temporal_split(s, by=BY, include_open=True).select(
        "opportunity_id", "snapshot_period", "deal_stage", "effective_close", "split")


_HASH = "CAST(('0x' || substr(md5(CAST(opportunity_key AS VARCHAR) || '-42'), 1, 15)) AS BIGINT)"


@query("w5_stratified_split", O.with_(O.SNAPS) + f"""
SELECT opportunity_id, deal_stage,
       CASE WHEN row_number() OVER (PARTITION BY deal_stage ORDER BY {_HASH} % 1073741824, opportunity_key)
                 <= floor(count(*) OVER (PARTITION BY deal_stage) * 0.8) THEN 'train' ELSE 'test' END AS split
FROM snaps""")
def q_w5(spark, d):
    from dealcast.operators.windows import stratified_split
    s = D.snapshots(spark, d).select("opportunity_id", "opportunity_key", "deal_stage")
    return stratified_split(s, "opportunity_key", "deal_stage").select("opportunity_id", "deal_stage", "split")


@query("t3_seeded_sample", O.with_(O.SNAPS) + f"""
SELECT opportunity_id, snapshot_period, deal_stage FROM (
  SELECT *, row_number() OVER (PARTITION BY snapshot_period ORDER BY {_HASH} % 1073741824, opportunity_key) AS rn
  FROM snaps WHERE deal_stage = 'Won')
WHERE rn <= 1000""")
def q_t3(spark, d):
    """At most 1000 of each period's won rows, by a seeded hash (the sample is the feature)."""
    from dealcast.operators.windows import seeded_sample
    out = seeded_sample(D.snapshots(spark, d), 1000, "opportunity_key", by=BY, where=F.col("deal_stage") == "Won")
    return out.select("opportunity_id", "snapshot_period", "deal_stage")


# ---------------------------------------------------------------- validation and quality

_VCOLS = O.VALIDATED
_STAGE_LIST = "('Won', 'Lost', 'Engaging', 'Prospecting')"


def _nulls(c: str) -> str:
    return f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"


def _cnt(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


_V1_AGG = f"""count(*) AS rows, {_cnt('close_value < 0')} AS close_value_below_min,
       {_cnt(f'deal_stage IS NULL OR deal_stage NOT IN {_STAGE_LIST}')} AS invalid_stage_rows"""
_V1_SQL = O.with_(O.VAL) + f""",
v1 AS (SELECT snapshot_period, {_V1_AGG} FROM val GROUP BY snapshot_period)
SELECT *, CAST(0 AS INTEGER) AS missing_columns, CAST(1 AS INTEGER) AS extra_columns,
       CAST(0 AS INTEGER) AS type_issues,
       CAST((close_value_below_min > 0)::INT + (invalid_stage_rows > 0)::INT AS INTEGER) AS serious_issues,
       (close_value_below_min > 0)::INT + (invalid_stage_rows > 0)::INT = 0 AND rows > 0 AS is_valid
FROM v1"""


@query("v1_schema_check", _V1_SQL)
def q_v1(spark, d):
    from dealcast.operators.quality import schema_check
    return schema_check(D.validated(spark, d), by=BY)


@query("v2_missing_values", O.with_(O.VAL) + "\nUNION ALL\n".join(
    f"""SELECT snapshot_period, '{c}' AS column, CAST({_nulls(c)} AS BIGINT) AS missing,
       {_nulls(c)} * 100.0 / count(*) AS missing_pct, {_nulls(c)} * 100.0 / count(*) < 10 AS passed
FROM val GROUP BY snapshot_period""" for c in _VCOLS))
def q_v2(spark, d):
    from dealcast.operators.quality import missing_values
    return missing_values(D.validated(spark, d), by=BY)


_DUP = f"""dup AS (
  SELECT snapshot_period, CAST(sum(c) AS BIGINT) AS rows, CAST(sum(c - 1) AS BIGINT) AS duplicates
  FROM (SELECT snapshot_period, count(*) AS c FROM val GROUP BY {", ".join(_VCOLS)}, snapshot_period)
  GROUP BY snapshot_period)"""


@query("v3_duplicate_rows", O.with_(O.VAL, _DUP) + """
SELECT snapshot_period, rows, duplicates, duplicates * 100.0 / rows AS duplicate_pct,
       duplicates * 100.0 / rows < 5 AS passed FROM dup""")
def q_v3(spark, d):
    from dealcast.operators.quality import duplicate_rows
    return duplicate_rows(D.validated(spark, d), by=BY)


_RULES = f"""rules AS (
  SELECT snapshot_period,
         {_cnt(f'deal_stage IS NULL OR deal_stage NOT IN {_STAGE_LIST}')} AS invalid_stage_rows,
         {_cnt('close_value < 0')} AS negative_values, {_cnt('close_value = 0')} AS zero_values,
         {_cnt('close_date < engage_date')} AS close_before_engage,
         {_cnt("deal_stage IN ('Won', 'Lost') AND close_date IS NULL")} AS closed_without_date
  FROM val GROUP BY snapshot_period)"""


@query("v5_v8_business_rules", O.with_(O.VAL, _RULES) + """
SELECT *, invalid_stage_rows = 0 AS stages_passed, negative_values = 0 AS values_passed,
       close_before_engage = 0 AS dates_passed, closed_without_date = 0 AS closed_passed FROM rules""")
def q_v5(spark, d):
    from dealcast.operators.quality import business_rules
    return business_rules(D.validated(spark, d), by=BY)


_MAXMISS = "greatest(" + ", ".join(_nulls(c) for c in _VCOLS) + ")"


_V9_SQL = O.with_(O.VAL, _DUP, _RULES) + f""",
v1 AS (SELECT snapshot_period, {_V1_AGG} FROM val GROUP BY snapshot_period),
m AS (SELECT snapshot_period, count(*) AS n, {_MAXMISS} AS mx FROM val GROUP BY snapshot_period),
j AS (
  SELECT m.snapshot_period,
         (v1.close_value_below_min > 0)::INT + (v1.invalid_stage_rows > 0)::INT = 0 AND v1.rows > 0 AS schema_passed,
         m.mx * 100.0 / m.n < 10 AS missing_passed, dup.duplicates * 100.0 / dup.rows < 5 AS duplicates_passed,
         true AS types_passed,
         CAST((r.invalid_stage_rows = 0)::INT + (r.negative_values = 0)::INT + (r.close_before_engage = 0)::INT
              + (r.closed_without_date = 0)::INT AS INTEGER) AS rules_passed
  FROM m JOIN v1 USING (snapshot_period) JOIN dup USING (snapshot_period) JOIN rules r USING (snapshot_period)),
s AS (
  SELECT *, 1.0 - CASE WHEN NOT schema_passed THEN 0.3 ELSE 0.0 END - CASE WHEN NOT missing_passed THEN 0.15 ELSE 0.0 END
            - CASE WHEN NOT duplicates_passed THEN 0.15 ELSE 0.0 END - (1 - rules_passed / 4.0) * 0.3 AS raw
  FROM j),
final AS (SELECT snapshot_period, schema_passed, missing_passed, duplicates_passed, types_passed, rules_passed,
                 greatest(raw, 0.0) AS score, greatest(raw, 0.0) >= 0.7 AS overall_passed FROM s)"""


@query("v9_validation_score", _V9_SQL + "\nSELECT * FROM final")
def q_v9(spark, d):
    from dealcast.operators.quality import validation_score
    return validation_score(D.validated(spark, d), by=BY)


_CELLS = " + ".join(_nulls(c) for c in _VCOLS)
_NC = len(_VCOLS)


@query("v10_ingestion_score", O.with_(O.VAL, _DUP) + f""",
v1 AS (SELECT snapshot_period, {_V1_AGG} FROM val GROUP BY snapshot_period),
c AS (SELECT snapshot_period, count(*) AS n, {_CELLS} AS missing FROM val GROUP BY snapshot_period),
j AS (SELECT c.*, dup.duplicates,
             CAST((v1.close_value_below_min > 0)::INT + (v1.invalid_stage_rows > 0)::INT AS INTEGER) AS serious_issues
      FROM c JOIN dup USING (snapshot_period) JOIN v1 USING (snapshot_period))
SELECT snapshot_period, missing / (n * {_NC}) AS missing_ratio, duplicates / n AS duplicate_ratio, serious_issues,
       least(greatest(1.0 - 0.3 * missing / (n * {_NC}) - 0.2 * duplicates / n - 0.1 * serious_issues, 0.0), 1.0)
         AS quality_score
FROM j""")
def q_v10(spark, d):
    from dealcast.operators.quality import ingestion_score
    return ingestion_score(D.validated(spark, d), by=BY)


_ANYNULL = "greatest(" + ", ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in _VCOLS) + ")"


@query("v11_notebook_score", O.with_(O.VAL, _DUP) + f""",
c AS (SELECT snapshot_period, count(*) AS n, {_CELLS} AS missing, sum(1 - {_ANYNULL}) AS complete
      FROM val GROUP BY snapshot_period),
j AS (SELECT c.*, dup.duplicates FROM c JOIN dup USING (snapshot_period))
SELECT snapshot_period, 1.0 AS schema_score, 1.0 - missing / (n * {_NC}) AS completeness,
       1.0 - duplicates / n AS uniqueness,
       (1.0 + (1.0 - missing / (n * {_NC})) + (1.0 - duplicates / n)) / 3 AS quality_score,
       complete / n AS complete_row_rate
FROM j""")
def q_v11(spark, d):
    from dealcast.operators.quality import notebook_score
    return notebook_score(D.validated(spark, d), by=BY)


@query("v12_notebook_rules", O.with_(O.VAL) + f"""
SELECT snapshot_period, {_cnt("deal_stage = 'Won' AND close_date IS NULL")} AS won_without_date,
       {_cnt("deal_stage = 'Won' AND close_value <= 0")} AS won_without_value,
       {_cnt("deal_stage = 'Lost' AND close_date IS NULL")} AS lost_without_date,
       {_cnt("deal_stage IN ('Engaging', 'Prospecting') AND close_date IS NOT NULL")} AS open_with_close_date,
       {_cnt('close_date < engage_date')} AS close_before_engage
FROM val GROUP BY snapshot_period""")
def q_v12(spark, d):
    from dealcast.operators.quality import notebook_rules
    return notebook_rules(D.validated(spark, d), by=BY)


@query("v13_training_gate", O.with_(O.SCORED) + f""",
g AS (SELECT snapshot_period, count(*) AS rows, avg(CAST(is_won AS DOUBLE)) AS win_rate,
             {_cnt('is_won IS NULL')} AS null_is_won, {_cnt('close_value IS NULL')} AS null_close_value,
             {_cnt('engage_date IS NULL')} AS null_engage_date, {_cnt('close_date IS NULL')} AS null_close_date,
             CAST(max(engage_date) - min(engage_date) AS INTEGER) AS span_days
      FROM base GROUP BY snapshot_period)
SELECT *, CAST(0 AS INTEGER) AS missing_columns,
       CAST((rows < 1000)::INT + (win_rate < 0.1 OR win_rate > 0.9)::INT + (null_engage_date > 0)::INT + (null_close_date > 0)::INT
            + coalesce(span_days < 30, true)::INT AS INTEGER) AS warnings,
       NOT (null_is_won > 0 OR null_close_value > 0) AS passed
FROM g""")
def q_v13(spark, d):
    from dealcast.functions import scalar as S
    from dealcast.operators.quality import training_gate
    c = D.cleaned(spark, d).withColumns({**S.stage_flags(), "sales_cycle_days": S.cycle_days()})
    return training_gate(c, by=BY)


def _suite_ctes() -> str:
    types = {"close_value": "double", "engage_date": "date", "close_date": "date", "creation_date": "date",
             "snapshot_date": "date"}
    cols = list(_VCOLS)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]
             if types.get(a, "string") == types.get(b, "string")]
    const = " + ".join(
        f"CASE WHEN count(DISTINCT {c}) <= 1 AND ({_nulls(c)} = 0 OR count(DISTINCT {c}) = 0) THEN 1 ELSE 0 END"
        for c in cols)
    miss = " + ".join(f"CASE WHEN {_nulls(c)} > 0 THEN 1 ELSE 0 END" for c in cols)
    dupc = " + ".join(f"CASE WHEN sum(CASE WHEN {a} IS DISTINCT FROM {b} THEN 1 ELSE 0 END) = 0 THEN 1 ELSE 0 END"
                      for a, b in pairs)
    return _DUP + f""",
g AS (SELECT snapshot_period, count(*) AS rows, CAST({miss} AS INTEGER) AS columns_with_missing,
             CAST(sum({_ANYNULL}) AS BIGINT) AS rows_with_missing, CAST({const} AS INTEGER) AS constant_columns,
             CAST({dupc} AS INTEGER) AS duplicated_columns
      FROM val GROUP BY snapshot_period),
j AS (SELECT g.*, dup.duplicates AS duplicated_rows,
             CAST((columns_with_missing = 0)::INT + (rows_with_missing = 0)::INT + (constant_columns = 0)::INT
                  + (dup.duplicates = 0)::INT + (duplicated_columns = 0)::INT + 1 AS INTEGER) AS passed_tests
      FROM g JOIN dup USING (snapshot_period))"""


def _suite_sql() -> str:
    return O.with_(O.VAL, _suite_ctes()) + """
SELECT *, CAST(6 AS INTEGER) AS total_tests, CAST(6 - passed_tests AS INTEGER) AS failed_tests,
       passed_tests = 6 AS all_tests_passed FROM j"""


@query("v16_quality_suite", _suite_sql())
def q_v16(spark, d):
    from dealcast.operators.quality import quality_suite
    return quality_suite(D.validated(spark, d), by=BY)


@query("v17_iqr_outliers", O.with_(O.VAL) + """,
q AS (SELECT snapshot_period, quantile_cont(close_value, 0.25) AS q1, quantile_cont(close_value, 0.75) AS q3
      FROM val WHERE close_value IS NOT NULL GROUP BY 1),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT f.*, CAST(sum(CASE WHEN v.close_value < f.lower_fence OR v.close_value > f.upper_fence THEN 1 ELSE 0 END)
                 AS BIGINT) AS outliers
FROM f JOIN val v ON v.snapshot_period = f.snapshot_period AND v.close_value IS NOT NULL
GROUP BY ALL""")
def q_v17(spark, d):
    from dealcast.operators.quality import iqr_outliers
    return iqr_outliers(D.validated(spark, d), "close_value", by=BY)


# ---------------------------------------------------------------- drift and monitoring

_PAIR = "ref_period, cur_period"


@query("d3_d4_column_drift", O.with_(O.DRIFT_SRC) + "SELECT * FROM coldrift")
def q_d3(spark, d):
    return _column_drift(spark, d)


def _column_drift(spark, d):
    from dealcast.operators.drift import consecutive_pairs, period_drift
    data = D.drift_input(spark, d)
    return period_drift(data, "snapshot_period", consecutive_pairs(data, "snapshot_period"), D.DRIFT_NUMERIC, D.DRIFT_CATEGORICAL)


def _numeric_counts(spark, d):
    """Written side counts of the 11 numeric columns, for every pair of snapshots."""
    from dealcast.operators.drift import consecutive_pairs, paired_counts, period_counts
    from dealcast.session import materialize
    data = D.drift_input(spark, d)
    counts = period_counts(data, "snapshot_period", D.DRIFT_NUMERIC, "DOUBLE")
    return materialize(paired_counts(counts, "snapshot_period", consecutive_pairs(data, "snapshot_period")))


_KEY = "ref_period, cur_period, feature"


@query("d3_wasserstein", O.with_(O.DRIFT_SRC) + f"""
SELECT {_KEY}, w AS wasserstein, w / greatest(sd, 0.001) AS normed
FROM (SELECT {_KEY}, sum(CASE WHEN nx IS NULL THEN 0.0 ELSE abs(cr / tr - cc / tc) * (nx - value) END) AS w
      FROM (SELECT *, lead(value) OVER (PARTITION BY {_KEY} ORDER BY value) AS nx FROM ncum) WHERE tr > 0 AND tc > 0 GROUP BY {_KEY})
JOIN (SELECT {_KEY}, sqrt(sum(n_ref * (value - m) * (value - m)) / sum(n_ref)) AS sd
      FROM (SELECT *, sum(value * n_ref) OVER (PARTITION BY {_KEY}) / sum(n_ref) OVER (PARTITION BY {_KEY}) AS m FROM ncnt) GROUP BY {_KEY}) USING ({_KEY})""")
def q_wasserstein(spark, d):
    """D3: the 1-Wasserstein distance of every numeric column between each snapshot and the one before."""
    from dealcast.operators.drift import wasserstein
    return wasserstein(_numeric_counts(spark, d))


@query("d4_population_stability", O.with_(O.DRIFT_SRC) + f""",
edges AS (SELECT {_KEY}, list_sort(list_distinct(list(e))) AS edges FROM (
  SELECT {_KEY}, i, min(value) AS e FROM ncum, (SELECT unnest(range(1, 10)) AS i) WHERE tr > 0 AND cr * 10 >= i * tr GROUP BY {_KEY}, i) GROUP BY {_KEY}),
binned AS (SELECT {_KEY}, len(list_filter(edges, lambda e: e < value)) AS bin, sum(n_ref) AS n_ref, sum(n_cur) AS n_cur
           FROM ncnt JOIN edges USING ({_KEY}) GROUP BY {_KEY}, bin),
shares AS (SELECT {_KEY}, sum(n_ref) OVER w AS tr, sum(n_cur) OVER w AS tc, greatest(n_ref / sum(n_ref) OVER w, 0.0001) AS p,
             greatest(n_cur / sum(n_cur) OVER w, 0.0001) AS q FROM binned WINDOW w AS (PARTITION BY {_KEY}))
SELECT {_KEY}, sum((q - p) * ln(q / p)) AS psi, count(*) AS bins FROM shares WHERE tr > 0 AND tc > 0 GROUP BY {_KEY}""")
def q_psi(spark, d):
    """The population stability index over bins fitted on the reference's exact quantiles."""
    from dealcast.operators.drift import population_stability, reference_bins
    from dealcast.session import materialize
    counts = _numeric_counts(spark, d)
    return population_stability(counts, materialize(reference_bins(counts)))


_DS = f"""ds AS (
  SELECT {_PAIR}, count(*) AS num_columns, CAST(sum(CAST(drifted AS INTEGER)) AS BIGINT) AS num_drifted_columns,
         sum(CAST(drifted AS INTEGER)) / count(*) AS share_drifted_columns,
         sum(CAST(drifted AS INTEGER)) / count(*) >= 0.5 AS dataset_drift
  FROM coldrift GROUP BY {_PAIR})"""


@query("d5_dataset_drift", O.with_(O.DRIFT_SRC, _DS) + "SELECT * FROM ds")
def q_d5(spark, d):
    from dealcast.operators.drift import dataset_drift
    return dataset_drift(_column_drift(spark, d))


_MISS = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in O.DRIFT_NUMERIC + O.DRIFT_CATEGORICAL)
_NDRIFT = len(O.DRIFT_NUMERIC + O.DRIFT_CATEGORICAL)


def _quality_sql(src: str, by: str, label: str = "is_won", score: str = "prediction") -> str:
    return f"""
q_base AS (SELECT * FROM {src} WHERE {label} IS NOT NULL AND {score} IS NOT NULL),
q_g AS (
  SELECT {by}, count(*) AS n,
         CAST(sum({label} * CAST({score} >= 0.5 AS INTEGER)) AS BIGINT) AS tp,
         CAST(sum((1 - {label}) * CAST({score} >= 0.5 AS INTEGER)) AS BIGINT) AS fp,
         CAST(sum({label} * (1 - CAST({score} >= 0.5 AS INTEGER))) AS BIGINT) AS fn,
         CAST(sum((1 - {label}) * (1 - CAST({score} >= 0.5 AS INTEGER))) AS BIGINT) AS tn,
         avg(({score} - {label}) * ({score} - {label})) AS brier
  FROM q_base GROUP BY {by}),
q_ps AS (SELECT {by}, CAST({score} AS DOUBLE) AS s, sum({label}) AS pos, sum(1 - {label}) AS neg
         FROM q_base GROUP BY {by}, s),
q_pc AS (SELECT *, sum(neg) OVER (PARTITION BY {by} ORDER BY s) AS cneg FROM q_ps),
q_auc AS (SELECT {by}, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                            THEN sum(pos * (cneg - 0.5 * neg)) / (sum(pos) * sum(neg)) END AS roc_auc
          FROM q_pc GROUP BY {by}),
quality AS (
  SELECT {by}, n, tp, fp, fn, tn, (tp + tn) / n AS accuracy,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
         CASE WHEN (CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END)
                   + (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END) > 0
              THEN 2 * (CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END)
                     * (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END)
                   / ((CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END)
                      + (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END)) ELSE 0.0 END AS f1,
         brier, roc_auc
  FROM q_g LEFT JOIN q_auc USING ({by}))"""


_SUMMARY = O.with_(O.DRIFT_SRC, _DS, O.VAL_ONLY, _suite_ctes()) + f""",
tests AS (SELECT pr.ref_period, pr.cur_period,
    c.columns_with_missing <= r.columns_with_missing AND c.rows_with_missing <= r.rows_with_missing * (c.rows / r.rows) * 1.1
    AND c.constant_columns <= r.constant_columns AND c.duplicated_columns = r.duplicated_columns
    AND abs(c.duplicated_rows - r.duplicated_rows * (c.rows / r.rows)) <= r.duplicated_rows * (c.rows / r.rows) * 0.1 AS quality_passed
  FROM pairs pr JOIN j c ON c.snapshot_period = pr.cur_period JOIN j r ON r.snapshot_period = pr.ref_period),
cur AS (SELECT * FROM tagged WHERE side = 'cur'),
miss AS (SELECT {_PAIR}, sum({_MISS}) / (count(*) * {_NDRIFT}) AS share_missing_values FROM cur GROUP BY {_PAIR}),
cur_l AS (SELECT *, ref_period || '|' || cur_period AS pair_key FROM cur WHERE is_won IS NOT NULL),
{_quality_sql("cur_l", "pair_key")},
summary AS (
  SELECT ds.*, pn.drift_score AS prediction_drift, miss.share_missing_values,
         q.accuracy, q.precision, q.recall, q.f1, q.roc_auc,
         ds.dataset_drift OR coalesce(pn.drift_score > 0.1, false) AS drift_detected,
         CASE WHEN ds.dataset_drift OR coalesce(pn.drift_score, 0.0) > 0.2 THEN 'HIGH'
              WHEN coalesce(pn.drift_score, 0.0) > 0.1 OR ds.num_drifted_columns > 5 THEN 'MEDIUM'
              WHEN ds.num_drifted_columns > 2 THEN 'LOW' ELSE 'NONE' END AS alert_level,
         coalesce(t.quality_passed, false) AS quality_passed,
         NOT (ds.dataset_drift OR coalesce(pn.drift_score > 0.1, false)) AND coalesce(t.quality_passed, false) AS healthy
  FROM ds LEFT JOIN p_num pn USING ({_PAIR}) LEFT JOIN miss USING ({_PAIR}) LEFT JOIN tests t USING ({_PAIR})
          LEFT JOIN quality q ON q.pair_key = ds.ref_period || '|' || ds.cur_period)"""


def _summary_df(spark, d):
    from dealcast.operators.drift import consecutive_pairs, monitoring_summary, tests_against_reference
    from dealcast.operators.quality import quality_suite
    from dealcast.session import materialize
    distinct = D.distinct_snapshots(spark, d)  # read by the features and by the suite
    data = D.drift_input(spark, d, distinct)
    pairs = consecutive_pairs(data, "snapshot_period")
    # the key column follows from the id, so these are the distinct rows of the validated columns as well
    suite = materialize(quality_suite(distinct.select(*D.VALIDATED), by=BY, distinct=distinct.select(*D.VALIDATED, "_copies")))
    return monitoring_summary(data, "snapshot_period", pairs, D.DRIFT_NUMERIC, D.DRIFT_CATEGORICAL,
                              quality=tests_against_reference(suite, pairs, "snapshot_period"))


@query("d15_monitoring_summary", _SUMMARY + "SELECT * FROM summary")
def q_d15(spark, d):
    return _summary_df(spark, d)


@query("d16_alerts", _SUMMARY + f"""
SELECT {_PAIR}, alert_level,
       printf('Drift detected for %s vs %s: %d drifted columns, prediction drift %.3f', cur_period, ref_period,
              num_drifted_columns, coalesce(prediction_drift, 0.0)) AS message
FROM summary WHERE drift_detected""")
def q_d16(spark, d):
    from dealcast.operators.drift import alerts
    return alerts(_summary_df(spark, d))


@query("d17_drift_history", _SUMMARY + """
SELECT cur_period, prediction_drift, num_drifted_columns, alert_level,
       prediction_drift - lag(prediction_drift) OVER (ORDER BY cur_period) AS prediction_drift_change,
       coalesce(prediction_drift > 0.1, false) AS above_warning, coalesce(prediction_drift > 0.2, false) AS above_critical
FROM summary""")
def q_d17(spark, d):
    from dealcast.operators.drift import drift_history
    return drift_history(_summary_df(spark, d))


@query("d18_performance_drop", _SUMMARY + """
SELECT cur_period, roc_auc, lag(roc_auc) OVER (ORDER BY cur_period) - roc_auc AS roc_auc_drop,
       coalesce(lag(roc_auc) OVER (ORDER BY cur_period) - roc_auc > 0.05, false) AS performance_drift
FROM summary""")
def q_d18(spark, d):
    from dealcast.operators.drift import performance_drop
    return performance_drop(_summary_df(spark, d))


@query("d7_d8_value_checks", O.with_(O.DRIFT_SRC) + f""",
r AS (SELECT {_PAIR}, min(close_value_log) AS rmin, max(close_value_log) AS rmax FROM tagged WHERE side = 'ref'
      GROUP BY {_PAIR}),
rng AS (SELECT {_PAIR}, avg(CAST(t.close_value_log >= r.rmin AND t.close_value_log <= r.rmax AS DOUBLE))
               AS value_range_share
        FROM tagged t JOIN r USING ({_PAIR}) WHERE t.side = 'cur' AND t.close_value_log IS NOT NULL GROUP BY {_PAIR}),
med AS (SELECT {_PAIR}, quantile_cont(close_value_log, 0.5) AS median_value_log FROM tagged
        WHERE side = 'cur' AND close_value_log IS NOT NULL GROUP BY {_PAIR})
SELECT * FROM med FULL JOIN rng USING ({_PAIR})""")
def q_d7(spark, d):
    from dealcast.operators.drift import PAIR, in_range_share
    t = D.drift_sides(spark, d)
    cur = t.where(F.col("side") == "cur")
    from dealcast.operators.stats import exact_quantiles
    med = exact_quantiles(cur, "close_value_log", [0.5], by=PAIR, names=["median_value_log"])
    return med.join(in_range_share(t, "close_value_log"), PAIR, "full")


_CLOSED_SCORED = O.with_(O.SCORED) + """,
cs AS (SELECT *, win_probability AS prediction FROM scored WHERE is_closed = 1),"""


@query("d9_m7_classification_quality", _CLOSED_SCORED + _quality_sql("cs", "snapshot_period")
       + "\nSELECT * FROM quality")
def q_d9(spark, d):
    from dealcast.operators.drift import classification_quality
    s = D.scored(spark, d).where(F.col("is_closed") == 1).withColumn("prediction", F.col("win_probability"))
    return classification_quality(s, "is_won", "prediction", by=BY)


@query("d10_class_balance", O.with_(O.SCORED) + """
SELECT snapshot_period, is_won AS label, count(*) AS count FROM scored WHERE is_closed = 1 GROUP BY 1, 2""")
def q_d10(spark, d):
    from dealcast.operators.drift import class_balance
    return class_balance(D.scored(spark, d).where(F.col("is_closed") == 1), "is_won", by=BY)


@query("d11_confusion_matrix", O.with_(O.SCORED) + """
SELECT snapshot_period, is_won AS actual, CAST(win_probability >= 0.5 AS INTEGER) AS predicted, count(*) AS count
FROM scored WHERE is_closed = 1 AND win_probability IS NOT NULL GROUP BY 1, 2, 3""")
def q_d11(spark, d):
    from dealcast.operators.drift import confusion_matrix
    return confusion_matrix(D.scored(spark, d).where(F.col("is_closed") == 1), "is_won", "win_probability", by=BY)


@query("d12_roc_points", O.with_(O.SCORED) + """,
p AS (SELECT snapshot_period, CAST(win_probability AS DOUBLE) AS threshold, sum(is_won) AS pos, sum(1 - is_won) AS neg
      FROM scored WHERE is_closed = 1 AND win_probability IS NOT NULL GROUP BY 1, 2),
c AS (SELECT *, sum(pos) OVER (PARTITION BY snapshot_period ORDER BY threshold DESC) AS cp,
             sum(neg) OVER (PARTITION BY snapshot_period ORDER BY threshold DESC) AS cn,
             sum(pos) OVER (PARTITION BY snapshot_period) AS tp, sum(neg) OVER (PARTITION BY snapshot_period) AS tn
      FROM p)
SELECT snapshot_period, threshold, CASE WHEN tp > 0 THEN cp / tp END AS tpr, CASE WHEN tn > 0 THEN cn / tn END AS fpr
FROM c""")
def q_d12(spark, d):
    from dealcast.operators.drift import roc_points
    return roc_points(D.scored(spark, d).where(F.col("is_closed") == 1), "is_won", "win_probability", by=BY)


_EVENTS = """
ev AS (SELECT *, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, CAST(ts AS DATE) AS day FROM events),"""


_D19_SQL = O.with_(_EVENTS + O.drift_ctes(
        "ev", "day", "SELECT (SELECT min(day) FROM ev) AS ref_period, cur_period "
                     "FROM (SELECT DISTINCT day AS cur_period FROM ev)", ["value", "k"], ["event_type"])
        + "," + O.drift_ctes("ev", "day", "SELECT * FROM pairs", ["value"], ["event_type"], prefix="p_")) + f""",
drifted AS (SELECT {_PAIR}, CAST(sum(CAST(drifted AS INTEGER)) AS BIGINT) AS num_drifted_columns FROM coldrift
            GROUP BY {_PAIR}),
cur AS (SELECT * FROM tagged WHERE side = 'cur'),
miss AS (SELECT {_PAIR}, sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END + CASE WHEN k IS NULL THEN 1 ELSE 0 END
                             + CASE WHEN event_type IS NULL THEN 1 ELSE 0 END) / (count(*) * 3) AS share_missing_values
         FROM cur GROUP BY {_PAIR}),
med AS (SELECT {_PAIR}, quantile_cont(value, 0.5) AS quantile FROM cur WHERE value IS NOT NULL GROUP BY {_PAIR}),
r AS (SELECT {_PAIR}, min(value) AS rmin, max(value) AS rmax FROM tagged WHERE side = 'ref' GROUP BY {_PAIR}),
rng AS (SELECT {_PAIR}, avg(CAST(c.value >= r.rmin AND c.value <= r.rmax AS DOUBLE)) AS value_range
        FROM cur c JOIN r USING ({_PAIR}) WHERE c.value IS NOT NULL GROUP BY {_PAIR})
SELECT CAST(pn.cur_period AS TIMESTAMP) AS timestamp, pn.drift_score AS prediction_drift, drifted.num_drifted_columns,
       miss.share_missing_values, med.quantile, rng.value_range
FROM p_num pn LEFT JOIN drifted USING ({_PAIR}) LEFT JOIN miss USING ({_PAIR}) LEFT JOIN med USING ({_PAIR})
     LEFT JOIN rng USING ({_PAIR})"""


@query("d19_daily_metrics", _D19_SQL)
def q_d19(spark, d):
    from dealcast.operators.drift import daily_metrics, events_with_props
    from dealcast.sources.tables import load_table
    return daily_metrics(events_with_props(load_table(spark, d, "events")))


# ---------------------------------------------------------------- models (pyspark.ml)

_KEEP = ("opportunity_id", "opportunity_key", "is_won", "is_closed", "deal_stage", "engage_date", "close_date")


@query("m2_training_matrix", O.training_matrix_sql())
def q_m2(spark, d):
    from dealcast.operators.monthly import training_matrix
    return training_matrix(D.model_features(spark, d), by=BY, keep=_KEEP)


def _model_data(spark, d):
    from dealcast.operators import models as M
    from dealcast.operators.monthly import MODEL_FEATURES
    data = M.prepare(D.model_frame(spark, d), MODEL_FEATURES)
    return data.where(F.col("split") == "train"), data.where(F.col("split") == "test")


_RUNS: dict[tuple, str] = {}  # training runs of this driver: (application, tables) -> folder


def _trained(spark, d, rows=None):
    """The training run over these tables: fitted once for all queries of a session. ``rows`` are their model features, if they
    are written already."""
    from dealcast.operators import models as M
    from dealcast.operators.monthly import MODEL_FEATURES
    from dealcast.plans.modelling import TrainedRun, train
    key = (spark.sparkContext.applicationId, d)
    if key not in _RUNS:
        path = _scratch(spark, "runs")
        frame = D.model_rows(rows) if rows is not None else D.model_frame(spark, d)
        train(M.prepare(frame, MODEL_FEATURES), path)
        _RUNS[key] = path
    return TrainedRun(spark, _RUNS[key])


@query("m3_m9_model_comparison", None)
def q_m3(spark, d):
    return _trained(spark, d).metrics.select("model", "accuracy", "roc_auc", "brier", "n", "rank", "is_best")


@query("m13_monitoring_thresholds", None)
def q_m13(spark, d):
    return _trained(spark, d).thresholds


@query("m15_feature_importance", None)
def q_m15(spark, d):
    from dealcast.operators import models as M
    from dealcast.operators.monthly import MODEL_FEATURES
    train, _ = _model_data(spark, d)
    rf = M.candidates()["random_forest"].fit(train)
    return M.feature_importance(rf, MODEL_FEATURES)


@query("m11_batch_scoring", None)
def q_m11(spark, d):
    """The saved and loaded best model scores the open pipeline; a feature that is missing there is 0."""
    from dealcast.operators.monthly import pipeline_rows
    rows = _model_rows(spark, d)
    return _trained(spark, d, rows).score(pipeline_rows(rows)).select("snapshot_period", "opportunity_id", "prediction", "prediction_binary")


def _model_rows(spark, d):
    """What training, scoring and monitoring use of the model features, written once for all of them."""
    from dealcast.operators.monthly import MODEL_FEATURES
    from dealcast.session import materialize
    keep = [*BY, "sales_agent", *_KEEP]
    return materialize(D.model_features(spark, d).select(*dict.fromkeys([*keep, *D.DRIFT_NUMERIC, *D.DRIFT_CATEGORICAL, *MODEL_FEATURES])))


def _model_scored(spark, d):
    """The scored set of all periods (D2) by the fitted model, written."""
    from dealcast.session import materialize
    rows = _model_rows(spark, d)
    return materialize(_trained(spark, d, rows).score(rows).drop("monitoring_timestamp", "opportunity_key", "is_closed", "engage_date", "close_date"))


@query("d2_model_scored_periods", O.with_(O.SNAPS) + """
SELECT snapshot_period, count(*) AS rows, CAST(sum(CASE WHEN deal_stage IN ('Won', 'Lost') THEN 1 ELSE 0 END) AS BIGINT) AS closed,
  TRUE AS scored, TRUE AS flags_agree, TRUE AS quality_from_scores FROM snaps GROUP BY snapshot_period""")
def q_d2_model(spark, d):
    """Every row of every period scored by the loaded model: all have a probability, the class flag follows from it, and a
    period's quality is what its written scores say."""
    from dealcast.plans.modelling import monitored_quality
    scored = _model_scored(spark, d)
    q = monitored_quality(scored, _trained(spark, d).thresholds).select("snapshot_period", F.col("n").alias("_n"), "accuracy", "brier")
    closed = F.col("deal_stage").isin("Won", "Lost")
    right = F.when(closed, ((F.col("prediction") >= 0.5).cast("int") == F.col("is_won")).cast("double"))
    g = scored.groupBy("snapshot_period").agg(
        F.count("*").alias("rows"), F.sum(closed.cast("long")).alias("closed"), F.min(F.coalesce(F.col("prediction").between(0, 1), F.lit(False))).alias("scored"),
        F.min(F.col("prediction_binary") == (F.col("prediction") >= 0.5).cast("int")).alias("flags_agree"), F.avg(right).alias("_right"))
    same = F.coalesce((F.col("_n") == F.col("closed")) & (F.abs(F.col("accuracy") - F.col("_right")) < 1e-9), F.col("closed") == 0)
    return g.join(F.broadcast(q), "snapshot_period", "left").select("snapshot_period", "rows", "closed", "scored", "flags_agree", same.alias("quality_from_scores"))


@query("d13_model_monitoring", None)
def q_d13_model(spark, d):
    """D13-D18 on the fitted model: drift of every period, its health, and alerts by the run's own thresholds."""
    from dealcast.plans.modelling import model_drift, monitored_quality
    scored = _model_scored(spark, d)
    alerts = monitored_quality(scored, _trained(spark, d).thresholds).select(F.col("snapshot_period").alias("cur_period"), "scored_by", "accuracy_alert", "roc_auc_alert",
                                                                             "brier_alert", "performance_drift")
    return model_drift(scored, D.DRIFT_NUMERIC, D.DRIFT_CATEGORICAL).join(F.broadcast(alerts), "cur_period", "left")  # a row a period


# ---------------------------------------------------------------- sources, sinks, streaming

def _scratch(spark, name):
    import uuid
    from dealcast.session import scratch_path
    return scratch_path(spark, f"{name}/{uuid.uuid4().hex}")


@query("s7_s5_partitioned_layer", O.with_(O.SNAPS) + """
SELECT snapshot_period, count(*) AS rows, CAST(count(DISTINCT opportunity_id) AS BIGINT) AS opportunities
FROM snaps GROUP BY snapshot_period""")
def q_s7(spark, d):
    """Write the snapshots as a period-partitioned layer, read it back (each
    period a pruned partition) and count per period."""
    from dealcast.sources.layers import read_layer, write_layer
    base = _scratch(spark, "layers")
    write_layer(D.snapshots(spark, d).drop("opportunity_key"), base, "raw")
    back = read_layer(spark, base, "raw")
    return back.groupBy("snapshot_period").agg(F.count("*").alias("rows"),
                                               F.countDistinct("opportunity_id").alias("opportunities"))


@query("s1_csv_roundtrip", O.with_(O.SNAPS) + """
SELECT opportunity_id, sales_agent, product, account, deal_stage, engage_date, close_date, close_value,
       creation_date, creation_year_month, snapshot_date FROM snaps""")
def q_s1(spark, d):
    """CSV sink and explicit-schema CSV scan of the 11-column table."""
    from dealcast.operators.quality import REQUIRED
    from dealcast.sources.layers import read_csv
    path = _scratch(spark, "csv")
    D.validated(spark, d).drop("snapshot_period").write.option("header", True).csv(path)
    return read_csv(spark, path, REQUIRED)


@query("s13_available_periods", O.with_(O.SNAPS) + """
SELECT DISTINCT strftime(engage_date, '%Y-%m') AS period FROM snaps WHERE engage_date IS NOT NULL""")
def q_s13(spark, d):
    from dealcast.sources.layers import available_periods
    return available_periods(D.snapshots(spark, d))


@query("s12_latest_period", O.with_(O.SNAPS) + "SELECT max(snapshot_period) AS latest_period FROM snaps")
def q_s12(spark, d):
    from dealcast.sources.layers import latest_period
    return latest_period(D.snapshots(spark, d))


@query("s9_s10_json_results", O.with_(O.SNAPS) + """
SELECT snapshot_period, count(*) AS rows,
       CAST(sum(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) AS BIGINT) AS won,
       CAST(sum(CASE WHEN deal_stage = 'Lost' THEN 1 ELSE 0 END) AS BIGINT) AS lost,
       CAST(sum(CASE WHEN deal_stage = 'Engaging' THEN 1 ELSE 0 END) AS BIGINT) AS engaging,
       CAST(sum(CASE WHEN deal_stage = 'Prospecting' THEN 1 ELSE 0 END) AS BIGINT) AS prospecting,
       CAST(sum(CASE WHEN deal_stage IN ('Won', 'Lost') THEN 1 ELSE 0 END) AS BIGINT) AS closed,
       min(engage_date) AS min_engage, max(engage_date) AS max_engage,
       min(close_date) AS min_close, max(close_date) AS max_close,
       min(close_value) AS min_value, max(close_value) AS max_value, sum(close_value) AS total_value
FROM snaps GROUP BY snapshot_period""")
def q_s9(spark, d):
    """Result rows appended as JSON, read back with a declared schema."""
    from dealcast.sources.layers import append_results, read_results
    path = _scratch(spark, "results")
    summary = A.dataset_summary(D.snapshots(spark, d), by=BY)
    append_results(summary, path)
    return read_results(spark, path, summary.schema)


@query("s14_s15_retention_plan", O.with_(O.SNAPS) + """,
p AS (SELECT snapshot_period, count(*) AS n, count(*) FILTER (WHERE deal_stage = 'Won') AS won, count(*) FILTER (WHERE deal_stage = 'Lost') AS lost FROM snaps GROUP BY 1)
SELECT category, snapshot_period, has_rows FROM (
  SELECT 'processed_files' AS category, snapshot_period, n > 0 AS has_rows FROM p UNION ALL SELECT 'feature_files', snapshot_period, n > 0 FROM p
  UNION ALL SELECT 'prediction_files', snapshot_period, TRUE FROM p WHERE won > 0 UNION ALL SELECT 'monitoring_files', snapshot_period, TRUE FROM p WHERE lost > 0
  UNION ALL SELECT 'temp_files', snapshot_period, n > 0 FROM p)""")
def q_s15(spark, d):
    """Files of five layers, a folder a period, listed and classified for retention: which category has which periods."""
    from dealcast.session import materialize
    from dealcast.sources.layers import list_files, retention_plan
    base = _scratch(spark, "retention")
    s = materialize(D.snapshots(spark, d).select("snapshot_period", "opportunity_id", "deal_stage"))
    layers = {"processed/all": s, "features/rows": s, "features/prediction": s.where("deal_stage = 'Won'"), "features/reference_data": s.where("deal_stage = 'Lost'"), "temp/all": s}
    for name, rows in layers.items():
        rows.drop("deal_stage").repartition("snapshot_period").write.partitionBy("snapshot_period").csv(f"{base}/{name}")
    files = list_files(spark, base, "part-*")
    own = F.regexp_extract("path", "/(processed|features|temp)/([a-z_]+)/snapshot_period=([^/]+)/", 2)
    named = files.withColumn("name", F.concat_ws("-", own, "name"))  # the reference's files carry what they hold in their name
    plan = retention_plan(named, F.regexp_extract("path", "/(processed|features|temp)/", 1))
    return plan.groupBy("category", F.regexp_extract("path", "snapshot_period=([^/]+)/", 1).alias("snapshot_period")).agg((F.sum("size") > 0).alias("has_rows"))


@query("u2_u3_p3_column_sets", """
SELECT 'common' AS what, 'deal_stage,opportunity_id,sales_agent' AS columns, count(*) AS rows FROM orders
UNION ALL SELECT 'only_left', 'close_value', count(*) FROM orders UNION ALL SELECT 'only_right', 'product', count(*) FROM orders
UNION ALL SELECT 'features', 'close_value,sales_agent', count(*) FROM orders""")
def q_column_sets(spark, d):
    """Column sets of two projections of the opportunities, and the model columns by name."""
    from dealcast.operators.clean import column_differences, common_columns
    from dealcast.plans.features import feature_columns
    o = D.opportunities(spark, d)
    a, b = o.select("opportunity_id", "sales_agent", "deal_stage", "close_value"), o.select("sales_agent", "opportunity_id", "deal_stage", "product")
    sets = {"common": common_columns(a, b), **column_differences(a, b), "features": feature_columns(a.columns)}
    n = o.agg(F.count("*").alias("rows"))
    return n.select(F.explode(F.array(*[F.struct(F.lit(k).alias("what"), F.lit(",".join(sorted(v))).alias("columns")) for k, v in sets.items()])).alias("s"), "rows").select("s.what", "s.columns", "rows")


@query("f19_f21_report_formats", """
SELECT strftime(o_orderdate, '%Y-%m') AS period, printf('$%,d', CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT)) AS revenue,
  printf('%.1f%%', CAST(round_even(CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) * 1000.0 / count(*) AS DECIMAL(38,10)), 0) AS DOUBLE) / 10) AS closed_share,
  strftime(date_trunc('month', min(o_orderdate)) + INTERVAL 1 MONTH, '%Y-%m') || ',' || strftime(date_trunc('month', min(o_orderdate)) + INTERVAL 2 MONTH, '%Y-%m') AS next_periods
FROM orders GROUP BY 1""")
def q_formats(spark, d):
    """currency and percent columns of a monthly report, and the periods that follow."""
    from dealcast.functions import scalar as S
    from dealcast.functions.periods import next_period, period_of, period_range
    g = D.tables(spark, d)["orders"].groupBy(period_of("o_orderdate").alias("period")).agg(
        F.sum(F.floor("o_totalprice")).alias("total"), F.avg((F.col("o_orderstatus") == "F").cast("int")).alias("share"))
    share = F.bround(F.col("share").cast("decimal(38,13)") * 1000, 0).cast("double") / 1000
    return g.select("period", S.currency(F.col("total")).alias("revenue"), S.percent(share).alias("closed_share"),
                    F.concat_ws(",", period_range(next_period("period"), 2)).alias("next_periods"))


@query("st1_daily_metrics_stream", _D19_SQL)
def q_st1(spark, d):
    """ST1: the streaming twin of d19, with the days that are still open at the end of the input."""
    from dealcast.sources.tables import load_table
    from dealcast.streaming.monitoring import flush_open_days, start_daily_metrics
    ref_day = load_table(spark, d, "events").select(F.min(F.to_date("ts"))).first()[0]  # one scalar
    out, ck = _scratch(spark, "st1-out"), _scratch(spark, "st1-ck")
    start_daily_metrics(spark, d, out, ck, ref_day).awaitTermination()
    flush_open_days(spark, d, out, ref_day)
    return spark.read.parquet(out).drop("day")


@query("st1_bounded_state_stream", """
SELECT m.timestamp, m.share_missing_values, m.value_range, n AS events, TRUE AS drift_within_bound, TRUE AS quantile_within_bound, CAST(0 AS BIGINT) AS late
FROM (""" + _D19_SQL + """) m JOIN (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS timestamp, count(*) AS n FROM events GROUP BY 1) USING (timestamp)""")
def q_st1_bounded(spark, d):
    """ST1 with sketches as state: shares and counts are exact, drift and median within the stated bounds of d19's."""
    from dealcast.operators.drift import daily_metrics
    from dealcast.operators.stats import exact_quantiles
    from dealcast.streaming import sketched as S
    out = _scratch(spark, "st1s-out")
    S.run_to_the_end(spark, d, out, _scratch(spark, "st1s-ck"))
    rank, drift = S.error_bounds()
    events = S.events_of(spark, d)
    exact = daily_metrics(events).select("timestamp", F.col("prediction_drift").alias("exact_drift"))
    around = exact_quantiles(events.withColumn("day", F.to_date("ts")), "value", [0.5 - rank, 0.5 + rank], by=["day"], names=["low", "high"])
    got = spark.read.parquet(out).join(S.late_events(events, out), "day").join(F.broadcast(around), "day").join(F.broadcast(exact), "timestamp")  # a row a day
    return got.select("timestamp", "share_missing_values", "value_range", "events", "late", (F.abs(F.col("prediction_drift") - F.col("exact_drift")) <= drift).alias("drift_within_bound"),
                      F.col("quantile").between(F.col("low"), F.col("high")).alias("quantile_within_bound"))


@query("st2_quality_gate_stream", """
WITH e AS (SELECT * FROM events)
""" + "\nUNION ALL\n".join(f"""SELECT '{c}' AS column, CAST(sum(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing,
       sum(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*) AS missing_pct,
       sum(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*) < 10 AS passed, CAST(0 AS BIGINT) AS batch_id FROM e"""
                              for c, x in (("event_id", "event_id"), ("ts", "ts"), ("user_id", "user_id"), ("event_type", "event_type"),
                                           ("value", "value"), ("k", "json_extract_string(props, '$.k')"))) + """
UNION ALL
SELECT 'value<0', CAST(sum(CASE WHEN value < 0 THEN 1 ELSE 0 END) AS BIGINT), NULL, sum(CASE WHEN value < 0 THEN 1 ELSE 0 END) = 0, CAST(0 AS BIGINT) FROM e""")
def q_st2(spark, d):
    from dealcast.streaming.monitoring import gate_results, start_quality_gate
    out, ck = _scratch(spark, "st2-out"), _scratch(spark, "st2-ck")
    start_quality_gate(spark, d, out, ck).awaitTermination()
    return gate_results(spark, out)


@query("st2_business_rules_stream", O.with_(O.OPPS) + f"""
SELECT *, invalid_stage_rows = 0 AS stages_passed, negative_values = 0 AS values_passed, close_before_engage = 0 AS dates_passed,
       closed_without_date = 0 AS closed_passed, CAST(0 AS BIGINT) AS batch_id
FROM (SELECT {_cnt(f'deal_stage IS NULL OR deal_stage NOT IN {_STAGE_LIST}')} AS invalid_stage_rows,
         {_cnt('close_value < 0')} AS negative_values, {_cnt('close_value = 0')} AS zero_values,
         {_cnt('close_date < engage_date')} AS close_before_engage,
         {_cnt("deal_stage IN ('Won', 'Lost') AND close_date IS NULL")} AS closed_without_date FROM opps)""")
def q_st2_rules(spark, d):
    """ST2 over the order stream: the rules on stages, values, date order and closing dates."""
    from dealcast.operators.quality import business_rules
    from dealcast.streaming.monitoring import gate_results, order_stream, start_quality_gate
    out, ck = _scratch(spark, "st2r-out"), _scratch(spark, "st2r-ck")
    start_quality_gate(spark, d, out, ck, checks=business_rules, stream=order_stream(spark, d)).awaitTermination()
    # the same batches once more, as after a lost checkpoint: nothing is added
    start_quality_gate(spark, d, out, _scratch(spark, "st2r-ck"), checks=business_rules, stream=order_stream(spark, d)).awaitTermination()
    return gate_results(spark, out)


_NAME = "c_name || ' ' || chr(233) || chr(252) || CASE c_custkey % 3 WHEN 0 THEN chr(26085) WHEN 1 THEN '' ELSE chr(8364) || chr(8217) END"


@query("s4_v4_mixed_encodings", f"""
SELECT c_custkey, {_NAME} AS label, c_acctbal, CASE c_custkey % 3 WHEN 0 THEN 'utf-8' WHEN 1 THEN 'iso-8859-1' ELSE 'windows-1252' END AS encoding FROM customer""")
def q_s4(spark, d):
    """A folder with files in three encodings, each read by its own."""
    from dealcast.sources import lines as L
    base, c = _scratch(spark, "encodings"), D.tables(spark, d)["customer"]
    name = F.concat("c_name", F.lit(" éü"))
    bytes_of = {0: F.concat(name, F.lit("日")).cast("binary"), 1: F.encode(name, "ISO-8859-1"), 2: F.encode(F.concat(name, F.lit("\x80\x92")), "ISO-8859-1")}
    for kind, text in bytes_of.items():  # the text sink writes bytes as they are
        line = F.concat_ws(",", F.col("c_custkey").cast("string"), text.cast("string"), F.col("c_acctbal").cast("string"))
        c.where(F.col("c_custkey") % 3 == kind).select(line.alias("value")).write.text(f"{base}/{kind}")
    schema = c.select("c_custkey", F.col("c_name").alias("label"), "c_acctbal").schema
    got = L.parsed(L.decoded_lines(spark, [f"{base}/{kind}" for kind in bytes_of]), schema)
    return got.select("row.*", "encoding")


_BAD = "CASE WHEN o_orderkey % 101 = 0 THEN 'wrong number of fields' WHEN o_orderkey % 97 = 0 THEN 'o_totalprice: no double' WHEN o_orderkey % 89 = 0 THEN 'o_orderdate: no date' END"


@query("s1_c5_rescued_lines", f"""
SELECT reason, count(*) AS lines, sum(CASE WHEN reason IS NULL THEN o_totalprice END) AS total, min(CASE WHEN reason IS NULL THEN CAST(o_orderdate AS DATE) END) AS first_day,
  count(DISTINCT CASE WHEN reason IS NULL THEN o_custkey END) AS customers
FROM (SELECT *, {_BAD} AS reason FROM orders) GROUP BY reason""")
def q_s1_rescue(spark, d):
    """Lines with fields that are missing or can't be read go to a reject table with the reason."""
    from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructType
    from dealcast.sources.lines import read_delimited
    path, k = _scratch(spark, "rescue"), F.col("o_orderkey")
    price = F.when(k % 97 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    day = F.when(k % 89 == 0, "32nd").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    fields = [k.cast("string"), F.col("o_custkey").cast("string"), price, day]
    line = F.when(k % 101 == 0, F.concat_ws(",", *fields[:3])).otherwise(F.concat_ws(",", *fields, F.col("o_orderpriority")))
    D.tables(spark, d)["orders"].select(line.alias("value")).write.text(path)
    schema = (StructType().add("o_orderkey", LongType()).add("o_custkey", LongType()).add("o_totalprice", DoubleType()).add("o_orderdate", DateType())
              .add("o_orderpriority", StringType()))
    good, bad = read_delimited(spark, path, schema)
    none = F.lit(None)
    return good.agg(none.cast("string").alias("reason"), F.count("*").alias("lines"), F.sum("o_totalprice").alias("total"), F.min("o_orderdate").alias("first_day"),
                    F.countDistinct("o_custkey").alias("customers")).unionByName(
        bad.groupBy("reason").agg(F.count("*").alias("lines"), none.cast("double").alias("total"), none.cast("date").alias("first_day"), F.lit(0).cast("long").alias("customers")))


@query("s10_f26_result_history", """
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS f FROM orders GROUP BY 1),
g AS (SELECT *, CAST(right(month, 2) AS INTEGER) % 4 AS shape FROM m)
SELECT month AS current_month, CASE WHEN shape <> 0 THEN CAST(month || '-01' AS TIMESTAMP) + INTERVAL 1 HOUR END AS timestamp,
  shape <> 0 AND n % 2 = 0 AS drift_detected, CASE WHEN shape IN (1, 2) THEN f / n ELSE 0.0 END AS prediction_drift, CASE WHEN shape = 0 THEN 0 ELSE f END AS num_drifted_columns,
  CASE WHEN shape = 2 THEN 'HIGH' ELSE 'NONE' END AS alert_level, CASE WHEN shape = 3 THEN f / n END AS accuracy, CAST(0.0 AS DOUBLE) AS missing_values_share, CAST(0 AS BIGINT) AS broken
FROM g WHERE shape <> 0
UNION ALL SELECT 'unreadable', NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*) FROM g WHERE shape = 0""")
def q_s10_history(spark, d):
    """Result files of three generations and broken ones, written one a month and read into the trend table."""
    from dealcast.sources.history import FIELDS, result_history, trend
    base, o = _scratch(spark, "history"), D.tables(spark, d)["orders"]
    m = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("current_month")).agg(
        F.count("*").alias("n"), F.sum((F.col("o_orderstatus") == "F").cast("long")).alias("num_drifted_columns"))
    drift = F.col("num_drifted_columns") / F.col("n")
    first = F.struct(F.concat("current_month", F.lit("-01 01:00:00")).alias("timestamp"), "current_month", (F.col("n") % 2 == 0).alias("drift_detected"),
                     drift.alias("prediction_drift"), "num_drifted_columns")
    inner = [(F.col("n") % 2 == 0).alias("drift_detected"), drift.alias("prediction_drift"), "num_drifted_columns", F.lit("HIGH").alias("alert_level")]
    second = F.struct(F.concat("current_month", F.lit("-01 01:00:00")).alias("timestamp"), "current_month",
                      F.struct(F.struct(*inner).alias("results"), F.lit("more").alias("extra")).alias("drift_detection"))
    third = F.struct(F.concat("current_month", F.lit("-01 01:00:00")).alias("timestamp"), "current_month", F.array(F.lit(1)).alias("added"),
                     F.struct(F.struct((F.col("n") % 2 == 0).alias("drift_detected"), "num_drifted_columns", drift.alias("accuracy")).alias("results")).alias("drift_detection"))
    shape = F.substring("current_month", 6, 2).cast("int") % 4
    text = F.when(shape == 1, F.to_json(first)).when(shape == 2, F.to_json(second)).when(shape == 3, F.to_json(third)).otherwise(F.concat(F.lit('{"timestamp": '), "current_month"))
    m.select(text.alias("value"), F.col("current_month").alias("of")).repartition("of").write.partitionBy("of").text(base)
    rows, bad = result_history(spark, base, "*.txt")
    broken = bad.agg(F.lit("unreadable").alias("current_month"), F.count("*").alias("broken"))
    return trend(rows).withColumn("broken", F.lit(0).cast("long")).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).unionByName(
        broken.select("current_month", F.lit(None).cast("timestamp_ntz").alias("timestamp"), *[F.lit(None).cast(t).alias(k) for k, (t, _) in FIELDS.items()], "broken"))


# ---------------------------------------------------------------- the rule-breaking ledger

def _on_ledger(sql: str) -> str:
    return sql.replace(O.VAL, O.LEDGER)


def _ledger_query(name: str, source: str, fn):
    """The same check and SQL as ``source``, over the ledger."""
    query(name, _on_ledger(REGISTRY[source][1]))(fn)


def _q(operator: str, **kw):
    from dealcast.operators import quality as Q
    return lambda spark, d: getattr(Q, operator)(D.ledger(spark, d), by=BY, **kw)


for _name, _source, _operator in (
        ("v1_ledger_schema", "v1_schema_check", "schema_check"), ("v2_ledger_missing", "v2_missing_values", "missing_values"),
        ("v3_ledger_duplicates", "v3_duplicate_rows", "duplicate_rows"), ("v5_v8_ledger_rules", "v5_v8_business_rules", "business_rules"),
        ("v9_ledger_score", "v9_validation_score", "validation_score"), ("v10_ledger_ingestion_score", "v10_ingestion_score", "ingestion_score"),
        ("v12_ledger_notebook_rules", "v12_notebook_rules", "notebook_rules"), ("v16_ledger_suite", "v16_quality_suite", "quality_suite")):
    _ledger_query(_name, _source, _q(_operator))


@query("c1_ledger_distinct", O.with_(O.LEDGER) + "SELECT DISTINCT * FROM val")
def q_c1(spark, d):
    from dealcast.operators.clean import drop_exact_duplicates
    return drop_exact_duplicates(D.ledger(spark, d))


@query("v15_validation_report", _V9_SQL + """
SELECT snapshot_period, line_no, CASE line_no
    WHEN 1 THEN printf('Overall score: %.3f (%s)', score, CASE WHEN overall_passed THEN 'PASS' ELSE 'FAIL' END)
    WHEN 2 THEN 'Schema validation: ' || CASE WHEN schema_passed THEN 'PASS' ELSE 'FAIL' END
    WHEN 3 THEN 'Missing values: ' || CASE WHEN missing_passed THEN 'PASS' ELSE 'FAIL' END
    WHEN 4 THEN 'Duplicate rows: ' || CASE WHEN duplicates_passed THEN 'PASS' ELSE 'FAIL' END
    WHEN 5 THEN 'Data types: ' || CASE WHEN types_passed THEN 'PASS' ELSE 'FAIL' END
    ELSE printf('Business rules passed: %d of 4', rules_passed) END AS text
FROM final, (SELECT CAST(unnest(range(1, 7)) AS INTEGER) AS line_no)""")
def q_v15(spark, d):
    """Report lines per snapshot from the V9 score table."""
    from dealcast.operators.quality import validation_report, validation_score
    return validation_report(validation_score(D.validated(spark, d), by=BY), by=BY)


# ---------------------------------------------------------------- names, dates, formats, layers

@query("p1_p2_standard_columns", O.with_(O.SNAPS) + "SELECT opportunity_id, sales_agent, account, deal_stage, close_value, close_date FROM snaps")
def q_p1(spark, d):
    """A table with messy names gets the standard ones; of the wanted columns those that exist stay."""
    from dealcast.operators.clean import clean_column_names, select_existing
    s = D.snapshots(spark, d)
    messy = s.select(F.col("opportunity_id").alias("Opportunity (ID)"), F.col("sales_agent").alias(" Sales-Agent"),
                     F.col("account").alias("Account.Name"), F.col("deal_stage").alias("Deal Stage"),
                     F.col("close_value").alias("Close Value"), F.col("close_date").alias("CLOSE-DATE"), F.col("engage_date").alias("When engaged"))
    return select_existing(clean_column_names(messy), ["opportunity_id", "sales_agent", "account", "deal_stage", "close_value", "close_date", "sector"])[0]


@query("c5_f8_v18_untyped_text", """
WITH t AS (SELECT strftime(o_orderdate, '%Y-%m') AS snapshot_period,
    CASE WHEN o_orderkey % 7 = 0 THEN 'invalid' WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day_text,
    CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS number_text FROM orders)
SELECT snapshot_period, CAST(sum(CASE WHEN day_text IS NOT NULL AND try_cast(day_text AS DATE) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS invalid_dates,
       min(try_cast(day_text AS DATE)) AS first_day, sum(try_cast(number_text AS DOUBLE)) AS number_sum, count(try_cast(number_text AS DOUBLE)) AS numbers
FROM t GROUP BY 1""")
def q_untyped(spark, d):
    """Texts that should be numbers and dates; what doesn't parse is null or counted."""
    from dealcast.functions import scalar as S
    from dealcast.operators.clean import coerce_numeric
    from dealcast.operators.quality import invalid_dates
    k = F.col("o_orderkey")
    t = D.tables(spark, d)["orders"].select(
        F.date_format("o_orderdate", "yyyy-MM").alias("snapshot_period"),
        F.when(k % 7 == 0, "invalid").when(k % 11 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day_text"),
        F.when(k % 5 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("number_text"))
    typed = coerce_numeric(t, ["number_text"]).groupBy("snapshot_period").agg(
        F.min(S.safe_date("day_text")).alias("first_day"), F.sum("number_text").alias("number_sum"), F.count("number_text").alias("numbers"))
    return invalid_dates(t, "day_text", by=BY).join(F.broadcast(typed), "snapshot_period")


@query("c12_fill_by_type", O.with_(O.LEDGER) + """
SELECT opportunity_id, coalesce(sales_agent, 'Unknown') AS sales_agent, coalesce(close_value, 0.0) AS close_value,
       coalesce(close_date, DATE '1970-01-01') AS close_date FROM val""")
def q_c12(spark, d):
    from dealcast.operators.clean import fill_nulls_by_type
    return fill_nulls_by_type(D.ledger(spark, d).select("opportunity_id", "sales_agent", "close_value", "close_date"), date="1970-01-01")


@query("p9_time_slice", "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'")
def q_p9(spark, d):
    import datetime as dt
    from dealcast.operators.clean import time_slice
    from dealcast.sources.tables import load_table
    return time_slice(load_table(spark, d, "events"), "ts", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 12)).select("event_id", "event_type")


@query("p11_missing_features_as_zero", O.with_(O.SNAPS) + """
SELECT opportunity_id, coalesce(close_value, 0.0) AS close_value, CAST(0 AS INTEGER) AS employees FROM snaps""")
def q_p11(spark, d):
    from dealcast.operators.clean import add_missing_as_zero
    return add_missing_as_zero(D.snapshots(spark, d).select("opportunity_id", "close_value"), ["close_value", "employees"])


@query("f24_frequency_encoding", O.with_(O.LEDGER) + """
SELECT snapshot_period, product, count(*) AS rows,
       any_value(share) AS product_frequency
FROM (SELECT *, count(*) OVER (PARTITION BY snapshot_period, product) / count(*) OVER (PARTITION BY snapshot_period) AS share FROM val) GROUP BY 1, 2""")
def q_f24(spark, d):
    from dealcast.operators.encode import frequency_encode
    f = frequency_encode(D.ledger(spark, d), "product", by=BY)
    return f.groupBy("snapshot_period", "product").agg(F.count("*").alias("rows"), F.first("product_frequency").alias("product_frequency"))


@query("s5_one_period_of_a_layer", O.with_(O.SNAPS) + """
SELECT opportunity_id, deal_stage, snapshot_period FROM snaps WHERE snapshot_period = '1998-06'""")
def q_s5(spark, d):
    """One month of a partitioned layer; the other partitions are not listed or read."""
    from dealcast.sources.layers import read_layer, write_layer
    base = _scratch(spark, "layers")
    s = D.snapshots(spark, d).drop("opportunity_key")
    write_layer(s, base, "raw")
    return read_layer(spark, base, "raw", "1998-06", schema=s.schema).select("opportunity_id", "deal_stage", "snapshot_period")


@query("s11_metrics_append", _D19_SQL)
def q_s11(spark, d):
    """The six metric columns committed to a table by day, the first ten days
    before all of them, and read back: no day is there twice."""
    from dealcast.operators.drift import daily_metrics, events_with_props
    from dealcast.session import materialize
    from dealcast.sources.committed import CommittedTable
    from dealcast.sources.tables import load_table
    m = materialize(daily_metrics(events_with_props(load_table(spark, d, "events"))))
    results = CommittedTable(spark, _scratch(spark, "metrics"), m.schema)
    for part in (m.where(F.dayofmonth("timestamp") <= 10), m):
        results.commit(part, F.to_date("timestamp"))
    return results.read().drop("commit_key")


@query("m14_report_bands", REGISTRY["a8_probability_bands"][1])
def q_m14_bands(spark, d):
    from dealcast.operators.reports import monthly_report
    return monthly_report(D.scored(spark, d), by=BY)["bands"]


@query("m14_report_agents", REGISTRY["a9_agent_insights"][1])
def q_m14_agents(spark, d):
    from dealcast.operators.reports import monthly_report
    return monthly_report(D.scored(spark, d), by=BY)["agents"]


@query("m14_report_top_opportunities", O.with_(O.SCORED) + """
SELECT snapshot_period, opportunity_id, win_probability, expected_revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY snapshot_period ORDER BY win_probability DESC, opportunity_id) AS rn FROM pipe) WHERE rn <= 50""")
def q_m14_top(spark, d):
    from dealcast.operators.reports import monthly_report
    top = monthly_report(D.scored(spark, d), by=BY, top_n=50)["top_opportunities"]
    return top.select("snapshot_period", "opportunity_id", "win_probability", "expected_revenue")


# ---------------------------------------------------------------- scoring input, labels, periods, reference set

_J8_COLS = ("opportunity_id", "agent_opportunity_count", "agent_win_rate", "product_popularity",
            "product_win_rate", "account_frequency", "engage_month", "engage_quarter", "engage_day_of_week",
            "close_value_category_encoded", "sales_agent_encoded", "product_encoded", "account_encoded",
            "manager_encoded", "regional_office_encoded", "sector_encoded")


def _enc_sql(col: str, src: str = "hist") -> str:
    return (f"(SELECT {col}, CAST(dense_rank() OVER (ORDER BY {col}) - 1 AS INTEGER) AS {col}_encoded "
            f"FROM (SELECT DISTINCT {col} FROM {src} WHERE {col} IS NOT NULL) "
            f"UNION ALL SELECT NULL, CAST(count(DISTINCT {col}) AS INTEGER) FROM {src})")  # null: a class of its own, the last one


@query("j8_f5_enrich_new_records", O.with_(O.CLEAN, O.TEAMS, O.ACCOUNTS) + f""",
enr AS (SELECT c.*, t.manager, t.regional_office, a.sector,
               CAST(coalesce(c.deal_stage = 'Won', false) AS INTEGER) AS is_won
        FROM clean c LEFT JOIN teams t USING (sales_agent) LEFT JOIN accts a USING (account)),
latest AS (SELECT max(snapshot_period) AS p FROM enr),
hist AS (SELECT * FROM enr WHERE snapshot_period < (SELECT p FROM latest)),
new AS (SELECT * FROM enr WHERE snapshot_period = (SELECT p FROM latest)),
ag AS (SELECT sales_agent, count(*) AS agent_opportunity_count, avg(is_won) AS agent_win_rate FROM hist GROUP BY 1),
pr AS (SELECT product, count(*) AS product_popularity, avg(is_won) AS product_win_rate FROM hist GROUP BY 1),
ac AS (SELECT account, count(*) AS account_frequency FROM hist GROUP BY 1),
q AS (SELECT quantile_cont(close_value, 0.25) AS q25, quantile_cont(close_value, 0.5) AS q50,
             quantile_cont(close_value, 0.75) AS q75 FROM hist),
mg AS (SELECT h.sales_agent, min(m.manager_encoded) AS manager_encoded
       FROM (SELECT DISTINCT sales_agent, manager FROM hist WHERE sales_agent IS NOT NULL) h
       JOIN {_enc_sql('manager')} m ON m.manager IS NOT DISTINCT FROM h.manager GROUP BY 1)
SELECT n.opportunity_id,
       coalesce(ag.agent_opportunity_count, 1) AS agent_opportunity_count,
       coalesce(ag.agent_win_rate, 0.5) AS agent_win_rate,
       coalesce(pr.product_popularity, 1) AS product_popularity,
       coalesce(pr.product_win_rate, 0.5) AS product_win_rate,
       coalesce(ac.account_frequency, 1) AS account_frequency,
       CAST(month(n.engage_date) AS INTEGER) AS engage_month, CAST(quarter(n.engage_date) AS INTEGER) AS engage_quarter,
       CAST(isodow(n.engage_date) - 1 AS INTEGER) AS engage_day_of_week,
       CAST(CASE WHEN n.close_value <= q.q25 THEN 0 WHEN n.close_value <= q.q50 THEN 1
                 WHEN n.close_value <= q.q75 THEN 2 ELSE 3 END AS INTEGER) AS close_value_category_encoded,
       coalesce(e1.sales_agent_encoded, 0) AS sales_agent_encoded, coalesce(e2.product_encoded, 0) AS product_encoded,
       coalesce(e3.account_encoded, 0) AS account_encoded, coalesce(mg.manager_encoded, 0) AS manager_encoded,
       coalesce(e4.regional_office_encoded, 0) AS regional_office_encoded,
       coalesce(e5.sector_encoded, 0) AS sector_encoded
FROM new n CROSS JOIN q
LEFT JOIN ag USING (sales_agent) LEFT JOIN pr USING (product) LEFT JOIN ac USING (account)
LEFT JOIN {_enc_sql('sales_agent')} e1 ON e1.sales_agent IS NOT DISTINCT FROM n.sales_agent LEFT JOIN {_enc_sql('product')} e2 ON e2.product IS NOT DISTINCT FROM n.product
LEFT JOIN {_enc_sql('account')} e3 ON e3.account IS NOT DISTINCT FROM n.account LEFT JOIN mg USING (sales_agent)
LEFT JOIN {_enc_sql('regional_office')} e4 ON e4.regional_office IS NOT DISTINCT FROM n.regional_office LEFT JOIN {_enc_sql('sector')} e5 ON e5.sector IS NOT DISTINCT FROM n.sector""")
def q_j8(spark, d):
    from dealcast.operators.joins import enrich_new_records, join_accounts, join_sales_teams
    teams, accts, _ = D.dims(spark, d)
    c = join_accounts(join_sales_teams(D.cleaned(spark, d), teams), accts) \
        .withColumn("is_won", F.coalesce(F.col("deal_stage") == "Won", F.lit(False)).cast("int"))
    latest = c.select(F.max("snapshot_period")).scalar()
    hist, new = c.where(F.col("snapshot_period") < latest), c.where(F.col("snapshot_period") == latest)
    return enrich_new_records(new, hist).select(*_J8_COLS)


@query("f9_f10_date_labels", O.with_(O.SNAPS) + """
SELECT opportunity_id, monthname(engage_date) AS engage_month_name, dayname(engage_date) AS engage_day_name,
       CAST(month(engage_date) IN (3, 6, 9, 12) AS INTEGER) AS engage_is_quarter_end,
       CAST(month(engage_date) = 12 AS INTEGER) AS engage_is_december,
       CAST(dayofyear(engage_date) AS INTEGER) AS engage_day_of_year
FROM snaps""")
def q_f10(spark, d):
    from dealcast.functions import scalar as S
    s = D.snapshots(spark, d)
    return s.select("opportunity_id", *[c.alias(n) for n, c in S.calendar_labels("engage_date", "engage").items()],
                    F.dayofyear("engage_date").alias("engage_day_of_year"))


@query("f16_f18_pipeline_labels", O.with_(O.SCORED) + """
SELECT opportunity_id, snapshot_period, expected_revenue,
       CASE WHEN win_probability > 0.7 THEN 'Low' WHEN win_probability > 0.4 THEN 'Medium' ELSE 'High' END AS risk_level,
       CASE WHEN win_probability > 0.7 THEN 'High Priority Opportunity' WHEN win_probability > 0.4 THEN 'Medium Priority - Needs Attention'
            ELSE 'Low Priority - High Risk' END AS priority,
       CASE WHEN close_value > 5000 THEN 'Large' WHEN close_value > 1000 THEN 'Medium' ELSE 'Small' END AS deal_size
FROM pipe""")
def q_f17(spark, d):
    from dealcast.operators.reports import with_expected_revenue
    return with_expected_revenue(D.pipeline(spark, d)).select(
        "opportunity_id", "snapshot_period", "expected_revenue", "risk_level", "priority", "deal_size")


@query("f19_period_arithmetic", O.with_(O.SNAPS) + """
SELECT DISTINCT snapshot_period,
       strftime(CAST(snapshot_period || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m') AS next_period,
       strftime(CAST(snapshot_period || '-01' AS DATE) - 10, '%Y-%m') AS previous_period,
       last_day(CAST(snapshot_period || '-01' AS DATE)) AS period_end,
       regexp_matches(snapshot_period, '^[0-9]{4}-(0[1-9]|1[0-2])$') AS valid_period
FROM snaps""")
def q_f19(spark, d):
    from dealcast.functions import periods as P
    s = D.snapshots(spark, d).select("snapshot_period").distinct()
    return s.select("snapshot_period", P.next_period("snapshot_period").alias("next_period"),
                    P.previous_period("snapshot_period").alias("previous_period"),
                    P.period_end("snapshot_period").alias("period_end"),
                    P.is_valid_period("snapshot_period").alias("valid_period"))


@query("d1_v14_reference_set", O.with_(O.SCORED) + """,
p AS (SELECT DISTINCT snapshot_period FROM snaps),
ref AS (SELECT snapshot_period, count(*) AS rows,
               sum(CASE WHEN win_probability < 0 OR win_probability > 1 THEN 1 ELSE 0 END) AS bad,
               sum(CASE WHEN win_probability IS NULL OR is_won IS NULL THEN 1 ELSE 0 END) AS missing
        FROM scored WHERE is_closed = 1 GROUP BY snapshot_period)
SELECT snapshot_period, CAST(coalesce(rows, 0) AS BIGINT) AS rows, CAST(coalesce(bad, 0) AS BIGINT) AS out_of_range,
       CAST(coalesce(missing, 0) AS BIGINT) AS missing,
       coalesce(rows, 0) > 0 AND coalesce(bad, 0) = 0 AND coalesce(missing, 0) = 0 AS passed
FROM p LEFT JOIN ref USING (snapshot_period)""")
def q_d1(spark, d):
    """The reference set holds all closed deals of a period's scored set (their
    outcome is known); V14 checks it for every period, also one without any."""
    from dealcast.operators.quality import reference_set_check
    s = D.scored(spark, d)
    return reference_set_check(s.where(F.col("is_closed") == 1), "win_probability", "is_won", by=BY,
                               groups=s.select("snapshot_period").distinct())


@query("c11_first_n_periods", O.with_(O.OPPS) + """,
c AS (SELECT strftime(CAST(coalesce(engage_date,
               (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderstatus <> 'O'))
               - CAST(10 + (opportunity_key * 7919) % 20 AS INTEGER) AS DATE), '%Y-%m') AS creation_year_month
      FROM opps),
p AS (SELECT creation_year_month, dense_rank() OVER (ORDER BY creation_year_month) AS r
      FROM (SELECT DISTINCT creation_year_month FROM c WHERE creation_year_month IS NOT NULL))
SELECT greatest(c.creation_year_month, (SELECT max(creation_year_month) FROM p WHERE r <= 3)) AS snapshot_period,
       count(*) AS rows
FROM c GROUP BY 1""")
def q_c11(spark, d):
    """C11: the first three creation months merge into the first snapshot."""
    from dealcast.plans import binding
    from dealcast.plans.snapshots import add_creation_dates, build_snapshots, first_n_periods_month
    t = D.tables(spark, d)
    offset = 10 + (F.col("opportunity_key") * binding.CREATE_OFFSET_MULT) % binding.CREATE_OFFSET_MOD
    opps = binding.opportunities(t)
    first = first_n_periods_month(add_creation_dates(opps, offset, binding.max_engage_date(t)), 3)
    s = build_snapshots(opps, first, offset_days=offset, max_engage=binding.max_engage_date(t))
    return s.groupBy("snapshot_period").agg(F.count("*").alias("rows"))


_P12 = ("opportunity_id", "sales_agent", "product", "account", "deal_stage", "engage_date", "close_date",
        "close_value", "snapshot_period", "close_value_log", "close_value_category", "deal_stage_order",
        "is_closed", "is_won", "is_lost", "is_open", "manager", "regional_office", "agent_opportunity_count",
        "agent_win_rate", "product_popularity", "product_win_rate", "engage_year", "engage_month",
        "engage_quarter", "sales_cycle_days", "sales_cycle_category", "sector", "revenue", "employees",
        "account_frequency")


@query("p12_core_projection", O.with_(O.FEAT) + f"SELECT {', '.join(_P12)} FROM feat")
def q_p12(spark, d):
    """The processed table's core columns (31)."""
    return D.row_features(spark, d).select(*_P12)


@query("m14_monthly_report_totals", O.with_(O.SCORED) + """
SELECT snapshot_period, count(*) AS opportunities, sum(close_value) AS total_value,
       sum(expected_revenue) AS expected_revenue, avg(win_probability) AS avg_probability
FROM pipe GROUP BY snapshot_period""")
def q_m14(spark, d):
    from dealcast.operators.reports import monthly_report
    return monthly_report(D.scored(spark, d), by=BY)["totals"]
