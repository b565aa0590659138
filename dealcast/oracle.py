"""Independent ANSI SQL (DuckDB dialect) for every registered query.

The Spark operators are DataFrame code; these strings re-state the same
semantics in SQL over the raw test tables, so a bug in one is unlikely to be
repeated in the other. Shared CTEs are the SQL twins of the binding and the
snapshot assembly.
"""

from __future__ import annotations

from dealcast.operators.monthly import CATEGORICAL_DRIFT as DRIFT_CATEGORICAL, MODEL_FEATURES, NUMERIC_DRIFT as DRIFT_NUMERIC

FIRST_MONTH = "1995-12"

_WON = "o.o_orderstatus = 'F' AND substr(o.o_orderpriority, 1, 1) IN ('1', '2', '3')"

OPPS = f"""
first_line AS (
  SELECT l_orderkey,
         min_by(l_suppkey, (l_linenumber, l_suppkey, l_partkey)) AS supp,
         min_by(l_partkey, (l_linenumber, l_suppkey, l_partkey)) AS part
  FROM lineitem GROUP BY l_orderkey),
opps AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS opportunity_id,
         s.s_name AS sales_agent, p.p_brand AS product, c.c_name AS account,
         CASE WHEN {_WON} THEN 'Won' WHEN o.o_orderstatus = 'F' THEN 'Lost'
              WHEN o.o_orderstatus = 'P' THEN 'Engaging' ELSE 'Prospecting' END AS deal_stage,
         CASE WHEN o.o_orderstatus <> 'O' THEN CAST(o.o_orderdate AS DATE) END AS engage_date,
         CASE WHEN o.o_orderstatus = 'F'
              THEN CAST(o.o_orderdate AS DATE) + CAST(1 + (o.o_orderkey * 31) % 200 AS INTEGER) END AS close_date,
         CASE WHEN {_WON} THEN o.o_totalprice WHEN o.o_orderstatus = 'F' THEN 0.0 END AS close_value,
         o.o_orderkey AS opportunity_key
  FROM orders o
  LEFT JOIN first_line fl ON fl.l_orderkey = o.o_orderkey
  LEFT JOIN supplier s ON s.s_suppkey = fl.supp
  LEFT JOIN part p ON p.p_partkey = fl.part
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey)"""

SNAPS = OPPS + f""",
snap_created AS (
  SELECT *, strftime(creation_date, '%Y-%m') AS creation_year_month
  FROM (SELECT *, CAST(coalesce(engage_date,
                   (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderstatus <> 'O'))
                   - CAST(10 + (opportunity_key * 7919) % 20 AS INTEGER) AS DATE) AS creation_date
        FROM opps)),
snap_dated AS (
  SELECT *, greatest(creation_year_month, '{FIRST_MONTH}') AS snapshot_period,
         last_day(CAST(greatest(creation_year_month, '{FIRST_MONTH}') || '-01' AS DATE)) AS sd
  FROM snap_created),
snaps AS (
  SELECT opportunity_id, sales_agent, product, account,
         CASE WHEN engage_date > sd THEN 'Prospecting' WHEN close_date > sd THEN 'Engaging'
              ELSE deal_stage END AS deal_stage,
         CASE WHEN engage_date > sd THEN NULL ELSE engage_date END AS engage_date,
         CASE WHEN close_date > sd THEN NULL ELSE close_date END AS close_date,
         close_value, opportunity_key, creation_date, creation_year_month,
         snapshot_period, sd AS snapshot_date
  FROM snap_dated)"""

TEAMS = """
teams AS (
  SELECT s.s_name AS sales_agent, n.n_name AS manager, r.r_name AS regional_office
  FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey)"""

ACCOUNTS = """
accts AS (
  SELECT c_name AS account, c_mktsegment AS sector, c_acctbal AS revenue,
         CAST(10 + c_custkey % 991 AS BIGINT) AS employees
  FROM customer)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"

CLEAN = SNAPS + """,
snap_med AS (
  SELECT snapshot_period,
         quantile_cont(close_value, 0.5) FILTER (WHERE deal_stage IN ('Won', 'Lost')) AS med
  FROM snaps GROUP BY snapshot_period),
clean AS (
  SELECT opportunity_id, coalesce(sales_agent, 'Unknown') AS sales_agent,
         coalesce(product, 'Unknown') AS product, coalesce(account, 'Unknown') AS account,
         coalesce(deal_stage, 'Unknown') AS deal_stage, engage_date, close_date,
         coalesce(close_value, m.med) AS close_value, opportunity_key, creation_date,
         coalesce(creation_year_month, 'Unknown') AS creation_year_month,
         snapshot_period, snapshot_date
  FROM (SELECT DISTINCT * FROM snaps) s LEFT JOIN snap_med m USING (snapshot_period))"""


def band_sql(x: str, edges, labels, include_lowest=True, last_open=True) -> str:
    bounds = list(edges) + ([None] if last_open else [])
    parts = []
    for i, lab in enumerate(labels):
        lo, hi = bounds[i], bounds[i + 1]
        cond = f"{x} >= {lo}" if (i == 0 and include_lowest) else f"{x} > {lo}"
        if hi is not None:
            cond += f" AND {x} <= {hi}"
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


VALUE_BAND = band_sql("close_value", (0, 1000, 5000, 10000, 50000),
                      ("Small", "Medium", "Large", "Very Large", "Enterprise"))
CYCLE_BAND = band_sql("(close_date - engage_date)", (0, 30, 90, 180, 365),
                      ("Quick", "Short", "Medium", "Long", "Very Long"))

FEAT = CLEAN + "," + TEAMS + "," + ACCOUNTS + f""",
f0 AS (
  SELECT c.*, ln(1 + close_value) AS close_value_log,
         {VALUE_BAND} AS close_value_category,
         CASE deal_stage WHEN 'Prospecting' THEN 1 WHEN 'Engaging' THEN 2 WHEN 'Won' THEN 4
                         WHEN 'Lost' THEN 0 END AS deal_stage_order,
         CAST(coalesce(deal_stage IN ('Won', 'Lost'), false) AS INTEGER) AS is_closed,
         CAST(coalesce(deal_stage = 'Won', false) AS INTEGER) AS is_won,
         CAST(coalesce(deal_stage = 'Lost', false) AS INTEGER) AS is_lost,
         1 - CAST(coalesce(deal_stage IN ('Won', 'Lost'), false) AS INTEGER) AS is_open
  FROM clean c),
f1 AS (SELECT f0.*, t.manager, t.regional_office FROM f0 LEFT JOIN teams t USING (sales_agent)),
agent_s AS (
  SELECT snapshot_period, sales_agent, count(*) AS agent_opportunity_count,
         CAST(round_even(CAST(avg(CASE WHEN is_closed = 1 THEN is_won END) AS DECIMAL(38,10)), 3) AS DOUBLE) AS agent_win_rate
  FROM f1 GROUP BY snapshot_period, sales_agent),
product_s AS (
  SELECT snapshot_period, product, count(*) AS product_popularity,
         CAST(round_even(CAST(avg(CASE WHEN is_closed = 1 THEN is_won END) AS DECIMAL(38,10)), 3) AS DOUBLE) AS product_win_rate
  FROM f1 GROUP BY snapshot_period, product),
f2 AS (
  SELECT f1.*, a.agent_opportunity_count, a.agent_win_rate, p.product_popularity, p.product_win_rate,
         CAST(year(engage_date) AS INTEGER) AS engage_year, CAST(month(engage_date) AS INTEGER) AS engage_month,
         CAST(quarter(engage_date) AS INTEGER) AS engage_quarter,
         CAST(isodow(engage_date) - 1 AS INTEGER) AS engage_day_of_week,
         CAST(dayofyear(engage_date) AS INTEGER) AS engage_day_of_year,
         CAST(year(close_date) AS INTEGER) AS close_year, CAST(month(close_date) AS INTEGER) AS close_month,
         CAST(quarter(close_date) AS INTEGER) AS close_quarter,
         CAST(isodow(close_date) - 1 AS INTEGER) AS close_day_of_week,
         CAST(close_date - engage_date AS INTEGER) AS sales_cycle_days,
         {CYCLE_BAND} AS sales_cycle_category
  FROM f1 LEFT JOIN agent_s a USING (snapshot_period, sales_agent)
          LEFT JOIN product_s p USING (snapshot_period, product)),
f3 AS (SELECT f2.*, a.sector, a.revenue, a.employees FROM f2 LEFT JOIN accts a USING (account)),
account_s AS (SELECT snapshot_period, account, count(*) AS account_frequency FROM f3 GROUP BY 1, 2),
feat AS (
  SELECT f3.*, s.account_frequency,
         CAST(coalesce(s.account_frequency > 1, false) AS INTEGER) AS is_repeat_account
  FROM f3 LEFT JOIN account_s s USING (snapshot_period, account))"""

ENCODED = ("opportunity_id", "sales_agent", "product", "account", "creation_year_month",
           "close_value_category", "sales_cycle_category", "manager", "regional_office", "sector")
SCALED = ("close_value", "close_value_log", "deal_stage_order", "is_closed", "is_won", "is_lost",
          "is_open", "agent_opportunity_count", "agent_win_rate", "product_popularity",
          "product_win_rate", "engage_year", "engage_month", "engage_quarter", "engage_day_of_week",
          "engage_day_of_year", "close_year", "close_month", "close_quarter", "close_day_of_week",
          "sales_cycle_days", "revenue", "employees", "account_frequency", "is_repeat_account",
          "sales_agent_encoded", "product_encoded", "account_encoded", "creation_year_month_encoded",
          "close_value_category_encoded", "sales_cycle_category_encoded", "manager_encoded",
          "regional_office_encoded", "sector_encoded")


def _enc(c: str) -> str:
    # null is a class of its own, after all values
    return (f"CAST(dense_rank() OVER (PARTITION BY snapshot_period ORDER BY {c} NULLS LAST) - 1 AS INTEGER) "
            f"AS {c}_encoded")


def _scaled(c: str) -> str:
    w = "OVER (PARTITION BY snapshot_period)"
    return (f"({c} - avg({c}) {w}) / CASE WHEN stddev_pop({c}) {w} = 0 THEN 1.0 "
            f"ELSE stddev_pop({c}) {w} END AS {c}_scaled")


FEATURE_TABLE = FEAT + f""",
enc AS (SELECT feat.*, {", ".join(_enc(c) for c in ENCODED)} FROM feat),
scaled AS (SELECT enc.*, {", ".join(_scaled(c) for c in SCALED)} FROM enc),
features AS (
  SELECT scaled.*, CAST(coalesce(deal_stage = 'Won', false) AS INTEGER) AS target_binary,
         CAST(dense_rank() OVER (PARTITION BY snapshot_period ORDER BY deal_stage) - 1 AS INTEGER)
           AS target_multiclass
  FROM scaled)"""

def monthly_sql(src: str) -> str:
    """M1 over a source CTE that has is_closed, sales_cycle_days, close_value,
    engage_date, snapshot_date, snapshot_period; defines ``monthly``."""
    return f"""
gstat AS (
  SELECT snapshot_period, max(snapshot_date) + 30 AS as_of_date,
         CASE WHEN max(is_closed) = 1
              THEN quantile_cont(sales_cycle_days, 0.5) FILTER (WHERE is_closed = 1) ELSE 90.0 END AS med_cycle,
         quantile_cont(close_value, 0.8) AS q80v, quantile_cont(sales_cycle_days, 0.8) AS q80c
  FROM {src} GROUP BY snapshot_period),
monthly0 AS (
  SELECT b.*, g.as_of_date, CAST(g.as_of_date - b.engage_date AS INTEGER) AS days_since_engage,
         CAST(b.engage_date AS TIMESTAMP) + to_seconds(g.med_cycle * 86400) AS expected_close_date,
         CAST((b.engage_date - g.as_of_date) + floor(g.med_cycle) AS INTEGER) AS days_to_expected_close,
         g.q80v, g.q80c
  FROM {src} b LEFT JOIN gstat g USING (snapshot_period)),
monthly AS (
  SELECT * EXCLUDE (q80v, q80c),
         CAST(coalesce(days_to_expected_close BETWEEN -15 AND 45, false) AS INTEGER) AS should_close_next_month,
         CAST(coalesce(days_to_expected_close < -30, false) AS INTEGER) AS is_overdue,
         CAST(coalesce(days_to_expected_close > 60, false) AS INTEGER) AS is_early_stage,
         CASE WHEN sales_cycle_days > 0 THEN close_value / sales_cycle_days ELSE 0.0 END AS sales_velocity,
         CAST(coalesce(close_value > q80v, false) AS INTEGER) AS high_value_deal,
         CAST(coalesce(sales_cycle_days > q80c, false) AS INTEGER) AS long_sales_cycle
  FROM monthly0)"""


SCORED = CLEAN + """,
base AS (
  SELECT c.*, CAST(coalesce(deal_stage IN ('Won', 'Lost'), false) AS INTEGER) AS is_closed,
         CAST(coalesce(deal_stage = 'Won', false) AS INTEGER) AS is_won,
         CAST(close_date - engage_date AS INTEGER) AS sales_cycle_days
  FROM clean c),""" + monthly_sql("base") + """,
prob AS (
  SELECT snapshot_period, sales_agent,
         (sum(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) + 1)
           / (sum(CASE WHEN deal_stage IN ('Won', 'Lost') THEN 1 ELSE 0 END) + 2) AS win_probability
  FROM base GROUP BY snapshot_period, sales_agent),
scored AS (
  SELECT m.*, coalesce(p.win_probability, 0.5) AS win_probability
  FROM monthly m LEFT JOIN prob p USING (snapshot_period, sales_agent)),
pipe AS (
  SELECT *, close_value * win_probability AS expected_revenue,
         CASE WHEN win_probability > 0 AND win_probability <= 0.3 THEN 'Low (0-30%)'
              WHEN win_probability > 0.3 AND win_probability <= 0.6 THEN 'Medium (30-60%)'
              WHEN win_probability > 0.6 AND win_probability <= 0.8 THEN 'High (60-80%)'
              WHEN win_probability > 0.8 AND win_probability <= 1.0 THEN 'Very High (80%+)' END
           AS probability_category
  FROM scored WHERE is_closed = 0 OR should_close_next_month = 1)"""

VALIDATED = ("opportunity_id", "sales_agent", "product", "account", "deal_stage", "engage_date",
             "close_date", "close_value", "creation_date", "creation_year_month", "snapshot_date")
VAL_ONLY = f"""
val AS (SELECT {", ".join(VALIDATED)}, snapshot_period FROM snaps)"""
VAL = SNAPS + "," + VAL_ONLY
# A table that breaks the rules, under the same name.
LEDGER = f"""
led AS (
  SELECT l.*, o.*, c.c_name, c.c_acctbal, CAST(o_orderdate AS DATE) AS day, month(o_orderdate) % 2 = 1 AS odd
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey),
val AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS opportunity_id,
         CASE WHEN NOT odd OR l_quantity < 44 THEN 'Agent-' || (l_suppkey % 3) END AS sales_agent,
         'Part-' || (l_partkey % 2) AS product, c_name AS account,
         CASE WHEN odd AND month(day) % 3 = 0 AND l_returnflag = 'R' THEN 'Returned' WHEN {_WON.replace('o.', '')} THEN 'Won'
              WHEN o_orderstatus = 'F' THEN 'Lost' WHEN o_orderstatus = 'P' THEN 'Engaging' ELSE 'Prospecting' END AS deal_stage,
         day AS engage_date,
         CASE WHEN o_orderstatus = 'F' AND NOT odd THEN day + 5
              WHEN o_orderstatus = 'F' AND l_discount < 0.09 THEN CAST(date_trunc('month', l_shipdate) AS DATE) END AS close_date,
         CASE WHEN o_orderstatus = 'F' THEN CASE WHEN odd THEN c_acctbal ELSE abs(c_acctbal) END END AS close_value,
         day - 15 AS creation_date, strftime(day - 15, '%Y-%m') AS creation_year_month, last_day(day) AS snapshot_date,
         strftime(day, '%Y-%m') AS snapshot_period
  FROM led)"""

def drift_ctes(src: str, period: str, pairs_sql: str, numeric, categorical, prefix: str = "") -> str:
    """Tagged sides, KS per numeric column, JS per categorical column."""
    nl = " UNION ALL ".join(f"SELECT ref_period, cur_period, side, '{c}' AS feature, CAST({c} AS DOUBLE) AS value "
                            f"FROM {prefix}tagged" for c in numeric)
    cl = " UNION ALL ".join(f"SELECT ref_period, cur_period, side, '{c}' AS feature, CAST({c} AS VARCHAR) AS value "
                            f"FROM {prefix}tagged" for c in categorical)
    k = "ref_period, cur_period, feature"
    return f"""
{prefix}pairs AS ({pairs_sql}),
{prefix}tagged AS (
  SELECT d.*, p.ref_period, p.cur_period, 'ref' AS side FROM {src} d JOIN {prefix}pairs p ON d.{period} = p.ref_period
  UNION ALL
  SELECT d.*, p.ref_period, p.cur_period, 'cur' AS side FROM {src} d JOIN {prefix}pairs p ON d.{period} = p.cur_period),
{prefix}ncnt AS (
  SELECT {k}, value, sum(CASE WHEN side = 'ref' THEN 1 ELSE 0 END) AS n_ref,
         sum(CASE WHEN side = 'cur' THEN 1 ELSE 0 END) AS n_cur
  FROM ({nl}) WHERE value IS NOT NULL GROUP BY {k}, value),
{prefix}ncum AS (
  SELECT *, sum(n_ref) OVER (PARTITION BY {k} ORDER BY value) AS cr, sum(n_cur) OVER (PARTITION BY {k} ORDER BY value) AS cc,
         sum(n_ref) OVER (PARTITION BY {k}) AS tr, sum(n_cur) OVER (PARTITION BY {k}) AS tc FROM {prefix}ncnt),
{prefix}num AS (
  SELECT {k}, max(CASE WHEN tr > 0 AND tc > 0 THEN abs(cr / tr - cc / tc) END) AS drift_score, 'ks' AS stattest
  FROM {prefix}ncum GROUP BY {k}),
{prefix}ccnt AS (
  SELECT {k}, value, sum(CASE WHEN side = 'ref' THEN 1 ELSE 0 END) AS n_ref,
         sum(CASE WHEN side = 'cur' THEN 1 ELSE 0 END) AS n_cur
  FROM ({cl}) WHERE value IS NOT NULL GROUP BY {k}, value),
{prefix}cj AS (
  SELECT *, n_ref / sum(n_ref) OVER (PARTITION BY {k}) AS p, n_cur / sum(n_cur) OVER (PARTITION BY {k}) AS q,
         sum(n_ref) OVER (PARTITION BY {k}) AS tr, sum(n_cur) OVER (PARTITION BY {k}) AS tc FROM {prefix}ccnt),
{prefix}cat AS (
  SELECT {k}, sqrt(greatest(sum(CASE WHEN p > 0 THEN 0.5 * p * ln(p / ((p + q) / 2)) ELSE 0.0 END
                               + CASE WHEN q > 0 THEN 0.5 * q * ln(q / ((p + q) / 2)) ELSE 0.0 END), 0.0))
           AS drift_score, 'jensenshannon' AS stattest
  FROM {prefix}cj WHERE tr > 0 AND tc > 0 GROUP BY {k}),
{prefix}coldrift AS (
  SELECT *, coalesce(drift_score >= 0.1, false) AS drifted FROM {prefix}num
  UNION ALL SELECT *, coalesce(drift_score >= 0.1, false) AS drifted FROM {prefix}cat)"""


DRIFT_SRC = FEATURE_TABLE + "," + monthly_sql("features") + """,
prob AS (
  SELECT snapshot_period, sales_agent,
         (sum(CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END) + 1)
           / (sum(CASE WHEN deal_stage IN ('Won', 'Lost') THEN 1 ELSE 0 END) + 2) AS prediction
  FROM features GROUP BY snapshot_period, sales_agent),
dr AS (SELECT m.*, coalesce(p.prediction, 0.5) AS prediction FROM monthly m LEFT JOIN prob p USING (snapshot_period, sales_agent)),""" + drift_ctes(
    "dr", "snapshot_period",
    "SELECT * FROM (SELECT lag(cur_period) OVER (ORDER BY cur_period) AS ref_period, cur_period "
    "FROM (SELECT DISTINCT snapshot_period AS cur_period FROM dr)) WHERE ref_period IS NOT NULL",
    DRIFT_NUMERIC, DRIFT_CATEGORICAL) + "," + drift_ctes(
    "dr", "snapshot_period", "SELECT * FROM pairs", ["prediction"], ["is_overdue"], prefix="p_")

def training_matrix_sql() -> str:
    meds = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}" for c in MODEL_FEATURES)
    cols = ", ".join(f"coalesce(CAST(t.{c} AS DOUBLE), m.m_{c}) AS {c}" for c in MODEL_FEATURES)
    return "WITH " + FEATURE_TABLE.strip() + "," + monthly_sql("features") + f""",
tr AS (SELECT * FROM monthly WHERE is_closed = 1 OR should_close_next_month = 1),
med AS (SELECT snapshot_period, {meds} FROM tr GROUP BY snapshot_period)
SELECT t.snapshot_period, t.opportunity_id, t.opportunity_key, t.is_won, t.is_closed, t.deal_stage,
       t.engage_date, t.close_date, {cols}
FROM tr t LEFT JOIN med m USING (snapshot_period)"""
