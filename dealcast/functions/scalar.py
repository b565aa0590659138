"""Scalar column expressions (F1-F21). All are built-in Spark expressions,
so they run inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Band edges and labels, stage order, thresholds.
VALUE_BAND_EDGES = (0, 1000, 5000, 10000, 50000)
VALUE_BAND_LABELS = ("Small", "Medium", "Large", "Very Large", "Enterprise")
CYCLE_BAND_EDGES = (0, 30, 90, 180, 365)
CYCLE_BAND_LABELS = ("Quick", "Short", "Medium", "Long", "Very Long")
PROB_BAND_EDGES = (0.0, 0.3, 0.6, 0.8, 1.0)
PROB_BAND_LABELS = ("Low (0-30%)", "Medium (30-60%)", "High (60-80%)", "Very High (80%+)")
STAGE_ORDER = {"Prospecting": 1, "Engaging": 2, "Won": 4, "Lost": 0}
RISK_LEVELS = ((0.7, "Low"), (0.4, "Medium"))          # p > 0.7 Low, p > 0.4 Medium, else High
PRIORITIES = ((0.7, "High Priority Opportunity"), (0.4, "Medium Priority - Needs Attention"))
LOW_PRIORITY = "Low Priority - High Risk"
DEAL_SIZES = ((5000, "Large"), (1000, "Medium"))        # value > 5000 Large, > 1000 Medium, else Small
QUARTER_END_MONTHS = (3, 6, 9, 12)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cut(x, edges, labels, include_lowest: bool = True, last_open: bool = True) -> Column:
    """Right-closed binning ``(e[i-1], e[i]]``; with ``include_lowest`` the first
    bin also takes ``e[0]``. ``last_open`` makes the last bin ``(e[-1], inf)``.
    Values outside every bin, and nulls, give null."""
    x = _col(x)
    bounds = list(edges) + ([None] if last_open else [])
    expr = None
    for i, label in enumerate(labels):
        lo, hi = bounds[i], bounds[i + 1]
        lower = (x >= lo) if (i == 0 and include_lowest) else (x > lo)
        cond = lower if hi is None else lower & (x <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def value_band(x) -> Column:
    """close value band, bins 0, 1k, 5k, 10k, 50k, inf (lowest included)."""
    return cut(x, VALUE_BAND_EDGES, VALUE_BAND_LABELS)


def cycle_band(x) -> Column:
    """sales-cycle band, 0, 30, 90, 180, 365, inf days (lowest included)."""
    return cut(x, CYCLE_BAND_EDGES, CYCLE_BAND_LABELS)


def probability_band(p) -> Column:
    """probability band; the lowest edge is *not* included (p = 0 -> null)."""
    return cut(p, PROB_BAND_EDGES, PROB_BAND_LABELS, include_lowest=False, last_open=False)


def log_value(x) -> Column:
    """log(1 + x)."""
    return F.log1p(_col(x))


def stage_flags(stage="deal_stage") -> dict[str, Column]:
    """0/1 flags."""
    s = _col(stage)
    closed = s.isin("Won", "Lost")
    return {"is_closed": F.coalesce(closed, F.lit(False)).cast("int"),
            "is_won": F.coalesce(s == "Won", F.lit(False)).cast("int"),
            "is_lost": F.coalesce(s == "Lost", F.lit(False)).cast("int"),
            "is_open": (1 - F.coalesce(closed, F.lit(False)).cast("int"))}


def stage_order(stage="deal_stage") -> Column:
    """Dictionary lookup stage -> progression order (unknown -> null)."""
    s = _col(stage)
    expr = None
    for k, v in STAGE_ORDER.items():
        expr = F.when(s == k, F.lit(v)) if expr is None else expr.when(s == k, F.lit(v))
    return expr


def safe_date(x) -> Column:
    """F8: date parse with bad values -> null (strings) or pass-through (dates)."""
    return F.to_date(F.try_to_timestamp(_col(x).cast("string")))


def date_parts(d, prefix: str) -> dict[str, Column]:
    """year, month, quarter, weekday (Monday = 0), day of year."""
    d = _col(d)
    return {f"{prefix}_year": F.year(d), f"{prefix}_month": F.month(d),
            f"{prefix}_quarter": F.quarter(d), f"{prefix}_day_of_week": F.weekday(d),
            f"{prefix}_day_of_year": F.dayofyear(d)}


def calendar_labels(d, prefix: str) -> dict[str, Column]:
    """month name, day name, quarter-end-month and December flags."""
    d = _col(d)
    return {f"{prefix}_month_name": F.date_format(d, "MMMM"),
            f"{prefix}_day_name": F.date_format(d, "EEEE"),
            f"{prefix}_is_quarter_end": F.month(d).isin(*QUARTER_END_MONTHS).cast("int"),
            f"{prefix}_is_december": (F.month(d) == 12).cast("int")}


def cycle_days(engage="engage_date", close="close_date") -> Column:
    """whole days from engage to close (null unless both known)."""
    return F.datediff(_col(close), _col(engage))


def safe_ratio(num, den, default=None) -> Column:
    """num / den with a null or non-positive denominator -> ``default``
    (ANSI-safe: never divides by zero)."""
    num, den = _col(num), _col(den)
    d = F.lit(default) if default is not None else F.lit(None)
    return F.when(den.isNotNull() & (den > 0), num / den).otherwise(d)


def expected_revenue(value="close_value", p="win_probability") -> Column:
    """F16."""
    return _col(value) * _col(p)


def risk_level(p) -> Column:
    """> .7 Low, > .4 Medium, else High (null p -> High, as a failed > is)."""
    p = _col(p)
    (t1, l1), (t2, l2) = RISK_LEVELS
    return F.when(p > t1, l1).when(p > t2, l2).otherwise("High")


def priority(p) -> Column:
    """recommendation heading by win probability (> .7, > .4, else; a
    null probability is low, as a failed > is)."""
    p = _col(p)
    (t1, l1), (t2, l2) = PRIORITIES
    return F.when(p > t1, l1).when(p > t2, l2).otherwise(LOW_PRIORITY)


def deal_size(value) -> Column:
    """F18."""
    v = _col(value)
    (t1, l1), (t2, l2) = DEAL_SIZES
    return F.when(v > t1, l1).when(v > t2, l2).otherwise("Small")


EXACT = "decimal(38,10)"


def rounded_sum(x, digits: int) -> Column:
    """Half-even rounded sum that does not depend on summation order: the
    terms are summed as exact decimals (a double sum can land an ulp either
    side of a half-way value, and Spark's row order varies between runs)."""
    return F.bround(F.sum(_col(x).cast(EXACT)), digits).cast("double")


def rounded_avg(x, digits: int) -> Column:
    """Half-even rounded mean; the mean is fixed to 10 decimals first so
    summation-order noise cannot decide a half-way case."""
    return F.bround(F.avg(_col(x)).cast(EXACT), digits).cast("double")


def round_half_even(x, digits: int) -> Column:
    """half-to-even rounding."""
    return F.bround(_col(x), digits)


def currency(x) -> Column:
    """``$1,234`` style (no decimals)."""
    return F.concat(F.lit("$"), F.format_number(F.bround(_col(x), 0), 0))


def percent(x, digits: int = 1) -> Column:
    """``12.3%`` style from a 0-1 share."""
    return F.concat(F.format_number(_col(x) * 100, digits), F.lit("%"))
