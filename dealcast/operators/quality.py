"""Validation and data-quality checks.

Every check is a one-pass aggregation (per ``by`` group) whose output is a
small table of counts, flags and scores; schema checks read only the
DataFrame's schema (no data pass). Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (DateType, DoubleType, LongType, IntegerType, StringType,
                               NumericType, StructField, StructType)

from dealcast.operators.stats import attach_stats, exact_quantiles

# The opportunity schema and validation thresholds.
STAGES = ("Won", "Lost", "Engaging", "Prospecting")
REQUIRED = StructType([
    StructField("opportunity_id", StringType()), StructField("sales_agent", StringType()),
    StructField("product", StringType()), StructField("account", StringType()),
    StructField("deal_stage", StringType()), StructField("engage_date", DateType()),
    StructField("close_date", DateType()), StructField("close_value", DoubleType()),
    StructField("creation_date", DateType()), StructField("creation_year_month", StringType()),
    StructField("snapshot_date", DateType()),
])
VALUE_RANGES = {"close_value": (0.0, None)}
MISSING_FAIL_PCT = 10.0
DUPLICATE_FAIL_PCT = 5.0
PASS_SCORE = 0.7
WEIGHTS = {"schema": 0.3, "missing": 0.15, "duplicates": 0.15, "types": 0.10, "rules": 0.3}


def _flag(c: Column, weight: Column | None = None) -> Column:
    """Rows that satisfy ``c`` (``weight``: rows that each input row stands for)."""
    return F.sum(F.when(c, weight if weight is not None else F.lit(1)).otherwise(0))


def _distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows with ``_copies``. The scores that need duplicates and other
    counts take all of them from here: one scan, and a repeated row is collapsed
    before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))


def _copies() -> Column:
    return F.col("_copies")


def schema_issues(df: DataFrame, schema: StructType = REQUIRED) -> dict[str, list[str]]:
    """V1 / V4 / U3 (metadata only): missing, extra and mistyped columns.
    A ``long`` or ``int`` column is accepted where a double is expected."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    missing = [c for c in want if c not in have]
    extra = [c for c in have if c not in want]
    bad = []
    for c, t in want.items():
        if c in have and have[c] != t and not (isinstance(t, DoubleType)
                                               and isinstance(have[c], (LongType, IntegerType))):
            bad.append(c)
    return {"missing": missing, "extra": extra, "types": bad}


def _range_counts(columns: Sequence[str], weight: Column | None = None) -> list[Column]:
    out = []
    for c, (lo, hi) in VALUE_RANGES.items():
        if c in columns:
            out += [_flag(F.col(c) < lo, weight).alias(f"{c}_below_min")] if lo is not None else []
            out += [_flag(F.col(c) > hi, weight).alias(f"{c}_above_max")] if hi is not None else []
    return out


def _invalid_stage(stage: str, weight: Column | None = None) -> Column:
    # membership: P5; a null stage is no valid stage
    return _flag(F.col(stage).isNull() | ~F.col(stage).isin(*STAGES), weight).alias("invalid_stage_rows")


def _schema_flags(g: DataFrame, df: DataFrame, schema: StructType) -> DataFrame:
    """The schema check's flags from its counts."""
    iss = schema_issues(df, schema)
    counts = [c for c in g.columns if c.endswith(("_below_min", "_above_max")) or c == "invalid_stage_rows"]
    issues = F.lit(len(iss["missing"]) > 0).cast("int") + F.lit(len(iss["types"]))
    for c in counts:
        issues = issues + (F.col(c) > 0).cast("int")
    return g.withColumns({"missing_columns": F.lit(len(iss["missing"])), "extra_columns": F.lit(len(iss["extra"])),
                          "type_issues": F.lit(len(iss["types"])), "serious_issues": issues,
                          "is_valid": (issues == 0) & (F.col("rows") > 0)})


def schema_check(df: DataFrame, by: Sequence[str] = (), schema: StructType = REQUIRED,
                 stage: str = "deal_stage") -> DataFrame:
    """V1: one row per group - counts of rows, missing/extra/mistyped columns,
    rows below a column's minimum or above its maximum, invalid stages; and
    ``is_valid`` (extra columns only warn; an empty table is invalid)."""
    stages = [_invalid_stage(stage)] if stage in df.columns else []
    return _schema_flags(df.groupBy(*by).agg(F.count("*").alias("rows"), *_range_counts(df.columns), *stages), df, schema)


def missing_values(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """V2: per group and column - missing count, percent, and passed (< 10 %).
    One aggregation, then ``stack`` to one row per column."""
    by = list(by)
    cols = [c for c in (cols or df.columns) if c not in by]
    g = df.groupBy(*by).agg(F.count("*").alias("_rows"),
                            *[_flag(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', `_m{i}`" for i, c in enumerate(cols))
    long = g.select(*by, "_rows", F.expr(f"stack({len(cols)}, {pairs}) AS (column, missing)"))
    return long.select(*by, "column", F.col("missing").cast("long").alias("missing"),
                       (F.col("missing") * 100.0 / F.col("_rows")).alias("missing_pct"),
                       (F.col("missing") * 100.0 / F.col("_rows") < MISSING_FAIL_PCT).alias("passed"))


def duplicate_rows(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """V3: rows minus distinct rows (null-safe: nulls group together), percent,
    passed (< 5 %). Partial aggregation collapses a repeated row map-side."""
    by = list(by)
    per_row = df.groupBy(*df.columns).agg(F.count("*").alias("_c"))
    g = per_row.groupBy(*by).agg(F.sum("_c").alias("rows"), F.sum(F.col("_c") - 1).alias("duplicates"))
    return g.select(*by, "rows", F.col("duplicates").cast("long").alias("duplicates"),
                    (F.col("duplicates") * 100.0 / F.col("rows")).alias("duplicate_pct"),
                    (F.col("duplicates") * 100.0 / F.col("rows") < DUPLICATE_FAIL_PCT).alias("passed"))


def _rule_counts(weight: Column | None = None) -> list[Column]:
    st, v = F.col("deal_stage"), F.col("close_value")
    return [_invalid_stage("deal_stage", weight), _flag(v < 0, weight).alias("negative_values"),
            _flag(v == 0, weight).alias("zero_values"),
            _flag(F.col("close_date") < F.col("engage_date"), weight).alias("close_before_engage"),
            _flag(st.isin("Won", "Lost") & F.col("close_date").isNull(), weight).alias("closed_without_date")]


def _rule_flags(g: DataFrame) -> DataFrame:
    return g.withColumns({
        "stages_passed": F.col("invalid_stage_rows") == 0,
        "values_passed": F.col("negative_values") == 0,
        "dates_passed": F.col("close_before_engage") == 0,
        "closed_passed": F.col("closed_without_date") == 0})


def business_rules(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """V5-V8: invalid stages, negative and zero values (V6), close before engage (V7),
    closed deals without a close date; each with its pass flag."""
    return _rule_flags(df.groupBy(*by).agg(*_rule_counts()))


def _greatest(cols: list[Column]) -> Column:
    return F.greatest(*cols) if len(cols) > 1 else cols[0]


def validation_score(df: DataFrame, by: Sequence[str] = (), schema: StructType = REQUIRED) -> DataFrame:
    """V9: weighted score - schema .3, missing .15, duplicates .15, types .1,
    business rules .3 by failed share; passed at >= 0.7. All counts come from one
    pass over the distinct rows."""
    by = list(by)
    cols = [c for c in df.columns if c not in by]
    n = _copies()
    g = _distinct_rows(df).groupBy(*by).agg(
        F.sum(n).alias("rows"), F.sum(n - 1).alias("_duplicates"),
        _greatest([_flag(F.col(c).isNull(), n) for c in cols]).alias("_max_missing"),
        *_range_counts(df.columns, n), *_rule_counts(n))
    j = _rule_flags(_schema_flags(g, df, schema))
    missing_passed = F.col("_max_missing") * 100.0 / F.col("rows") < MISSING_FAIL_PCT
    duplicates_passed = F.col("_duplicates") * 100.0 / F.col("rows") < DUPLICATE_FAIL_PCT
    rules_passed = (F.col("stages_passed").cast("int") + F.col("values_passed").cast("int")
                    + F.col("dates_passed").cast("int") + F.col("closed_passed").cast("int"))
    w = WEIGHTS
    score = (F.lit(1.0) - F.when(~F.col("is_valid"), w["schema"]).otherwise(0.0)
             - F.when(~missing_passed, w["missing"]).otherwise(0.0)
             - F.when(~duplicates_passed, w["duplicates"]).otherwise(0.0)
             - F.when(F.col("type_issues") > 0, w["types"]).otherwise(0.0)
             - (1 - rules_passed / 4.0) * w["rules"])
    return j.select(*by, F.col("is_valid").alias("schema_passed"), missing_passed.alias("missing_passed"),
                    duplicates_passed.alias("duplicates_passed"), (F.col("type_issues") == 0).alias("types_passed"),
                    rules_passed.alias("rules_passed"), F.greatest(score, F.lit(0.0)).alias("score"),
                    (F.greatest(score, F.lit(0.0)) >= PASS_SCORE).alias("overall_passed"))


def ingestion_score(df: DataFrame, by: Sequence[str] = (), schema: StructType = REQUIRED) -> DataFrame:
    """1 - .3 x missing-cell ratio - .2 x duplicate-row ratio - .1 per
    serious schema issue, clamped to [0, 1]. One pass over the distinct rows."""
    by = list(by)
    cols = [c for c in df.columns if c not in by]
    n = _copies()
    stages = [_invalid_stage("deal_stage", n)] if "deal_stage" in df.columns else []
    g = _distinct_rows(df).groupBy(*by).agg(
        F.sum(n).alias("rows"), F.sum(n - 1).alias("_duplicates"),
        sum((_flag(F.col(c).isNull(), n) for c in cols), F.lit(0)).alias("_missing"), *_range_counts(df.columns, n), *stages)
    j = _schema_flags(g, df, schema)
    missing, repeated = F.col("_missing") / (F.col("rows") * len(cols)), F.col("_duplicates") / F.col("rows")
    raw = 1.0 - 0.3 * F.col("_missing") / (F.col("rows") * len(cols)) - 0.2 * F.col("_duplicates") / F.col("rows") \
        - 0.1 * F.col("serious_issues")
    return j.select(*by, missing.alias("missing_ratio"), repeated.alias("duplicate_ratio"), "serious_issues",
                    F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)).alias("quality_score"))


def notebook_score(df: DataFrame, by: Sequence[str] = (), schema: StructType = REQUIRED) -> DataFrame:
    """Mean of schema (share of required columns present), completeness
    (1 - missing-cell ratio) and uniqueness (1 - duplicate ratio); plus the
    share of complete rows. One pass over the distinct rows."""
    by = list(by)
    cols = [c for c in df.columns if c not in by]
    present = sum(1 for f in schema.fields if f.name in df.columns) / len(schema.fields)
    any_null = _greatest([F.col(c).isNull().cast("int") for c in cols])
    n = _copies()
    j = _distinct_rows(df).groupBy(*by).agg(
        F.sum(n).alias("_rows"), F.sum(n - 1).alias("_duplicates"),
        sum((_flag(F.col(c).isNull(), n) for c in cols), F.lit(0)).alias("_missing"),
        F.sum((1 - any_null) * n).alias("_complete"))
    completeness = 1.0 - F.col("_missing") / (F.col("_rows") * len(cols))
    uniqueness = 1.0 - F.col("_duplicates") / F.col("_rows")
    return j.select(*by, F.lit(present).alias("schema_score"), completeness.alias("completeness"),
                    uniqueness.alias("uniqueness"),
                    ((F.lit(present) + completeness + uniqueness) / 3).alias("quality_score"),
                    (F.col("_complete") / F.col("_rows")).alias("complete_row_rate"))


def notebook_rules(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Won without date or with value <= 0; lost without date; open with
    a close date; close before engage."""
    st = F.col("deal_stage")
    return df.groupBy(*by).agg(
        _flag((st == "Won") & F.col("close_date").isNull()).alias("won_without_date"),
        _flag((st == "Won") & (F.col("close_value") <= 0)).alias("won_without_value"),
        _flag((st == "Lost") & F.col("close_date").isNull()).alias("lost_without_date"),
        _flag(st.isin("Engaging", "Prospecting") & F.col("close_date").isNotNull()).alias("open_with_close_date"),
        _flag(F.col("close_date") < F.col("engage_date")).alias("close_before_engage"))


def training_gate(df: DataFrame, by: Sequence[str] = (), min_rows: int = 1000,
                  min_span_days: int = 30) -> DataFrame:
    """Fails on missing required columns (is_won, is_closed,
    sales_cycle_days, close_value) or nulls in is_won or close_value; warns on few
    rows, an extreme win rate, null engage or close dates and a short or absent
    span of engage dates. A missing column is a result, not an error."""
    need = ["is_won", "is_closed", "sales_cycle_days", "close_value"]
    missing = [c for c in need if c not in df.columns]
    aggs = [F.count("*").alias("rows")]
    fail, warns = F.lit(len(missing) > 0), F.when(F.col("rows") < min_rows, 1).otherwise(0)
    if "is_won" in df.columns:
        aggs.append(F.avg(F.col("is_won").cast("double")).alias("win_rate"))
        warns = warns + F.when((F.col("win_rate") < 0.1) | (F.col("win_rate") > 0.9), 1).otherwise(0)
    for c in ("is_won", "close_value"):
        if c in df.columns:
            aggs.append(_flag(F.col(c).isNull()).alias(f"null_{c}"))
            fail = fail | (F.col(f"null_{c}") > 0)
    for c in ("engage_date", "close_date"):
        if c in df.columns:
            aggs.append(_flag(F.col(c).isNull()).alias(f"null_{c}"))
            warns = warns + F.when(F.col(f"null_{c}") > 0, 1).otherwise(0)
    if "engage_date" in df.columns:
        aggs.append(F.datediff(F.max("engage_date"), F.min("engage_date")).alias("span_days"))
        warns = warns + F.when(F.col("span_days") >= min_span_days, 0).otherwise(1)
    g = df.groupBy(*by).agg(*aggs)
    return g.withColumns({"missing_columns": F.lit(len(missing)), "warnings": warns, "passed": ~fail})


def reference_set_check(df: DataFrame, prediction: str = "prediction", target: str = "is_won",
                        by: Sequence[str] = (), groups: DataFrame | None = None) -> DataFrame:
    """Prediction and target present, predictions within [0, 1], no
    missing values in them, at least one row. ``groups`` lists the groups that
    must have a reference set: one without rows fails instead of vanishing."""
    by = list(by)
    has = prediction in df.columns and target in df.columns
    p = F.col(prediction) if has else F.lit(None).cast("double")
    t = F.col(target) if has else F.lit(None).cast("int")
    g = df.groupBy(*by).agg(F.count("*").alias("rows"), _flag((p < 0) | (p > 1)).alias("out_of_range"),
                            _flag(p.isNull() | t.isNull()).alias("missing"))
    if groups is not None:
        g = groups.select(*by).join(g, by, "left").fillna(0, subset=["rows", "out_of_range", "missing"])
    return g.withColumn("passed", F.lit(has) & (F.col("rows") > 0) & (F.col("out_of_range") == 0) & (F.col("missing") == 0))


def quality_suite(df: DataFrame, by: Sequence[str] = (), distinct: DataFrame | None = None) -> DataFrame:
    """Columns with missing values, rows with missing values, constant
    columns, duplicated rows, duplicated columns; tests passed / failed.

    All counts come from one pass over the distinct rows. Duplicate columns:
    for every pair of columns of the same type a mismatch count (null-safe) is
    aggregated; a pair with zero mismatches is a duplicate. A count must be 0 to
    pass; the sixth test (column types) is the schema check's and always passes
    here, where a table is its own reference. Constant = at most one distinct
    non-null value and no mix of null and non-null (from min/max). ``distinct``
    is the distinct rows with ``_copies``, if they are written already.
    """
    by = list(by)
    cols = [c for c in df.columns if c not in by]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:] if types[a] == types[b]]
    any_null = _greatest([F.col(c).isNull().cast("int") for c in cols])
    n = _copies()
    aggs = [F.sum(n).alias("rows"), F.sum(any_null * n).alias("rows_with_missing"), F.sum(n - 1).alias("duplicated_rows")]
    aggs += [_flag(F.col(c).isNull(), n).alias(f"_n{i}") for i, c in enumerate(cols)]
    # constant: one non-null value (min = max) and no null, or only nulls -
    # plain min/max, since several distinct counts would make Spark expand
    # every row once per column before the shuffle
    aggs += [F.min(F.col(c)).alias(f"_lo{i}") for i, c in enumerate(cols)]
    aggs += [F.max(F.col(c)).alias(f"_hi{i}") for i, c in enumerate(cols)]
    aggs += [_flag(~F.col(a).eqNullSafe(F.col(b))).alias(f"_p{k}") for k, (a, b) in enumerate(pairs)]
    g = (distinct if distinct is not None else _distinct_rows(df)).groupBy(*by).agg(*aggs)
    cols_missing = sum(((F.col(f"_n{i}") > 0).cast("int") for i in range(len(cols))), F.lit(0))
    constant = sum(((F.col(f"_n{i}") == F.col("rows"))
                    | ((F.col(f"_n{i}") == 0) & F.col(f"_lo{i}").eqNullSafe(F.col(f"_hi{i}")))).cast("int")
                   for i in range(len(cols)))
    dup_cols = sum(((F.col(f"_p{k}") == 0).cast("int") for k in range(len(pairs))), F.lit(0))
    out = g.select(*by, "rows", cols_missing.alias("columns_with_missing"),
                   F.col("rows_with_missing").cast("long").alias("rows_with_missing"),
                   constant.alias("constant_columns"), dup_cols.alias("duplicated_columns"), "duplicated_rows")
    tests = [F.col("columns_with_missing") == 0, F.col("rows_with_missing") == 0,
             F.col("constant_columns") == 0, F.col("duplicated_rows") == 0,
             F.col("duplicated_columns") == 0, F.lit(True)]  # column types: checked by schema
    passed = sum((t.cast("int") for t in tests), F.lit(0))
    return out.withColumns({"total_tests": F.lit(len(tests)), "passed_tests": passed,
                            "failed_tests": F.lit(len(tests)) - passed,
                            "all_tests_passed": passed == len(tests)})


def iqr_outliers(df: DataFrame, value: str, by: Sequence[str] = (), k: float = 1.5) -> DataFrame:
    """Exact quartiles, fences q1 - k*IQR and q3 + k*IQR, outlier count."""
    by = list(by)
    q = exact_quantiles(df, value, [0.25, 0.75], by=by, names=["q1", "q3"])
    q = q.withColumns({"iqr": F.col("q3") - F.col("q1")})
    q = q.withColumns({"lower_fence": F.col("q1") - k * F.col("iqr"),
                       "upper_fence": F.col("q3") + k * F.col("iqr")})
    j = attach_stats(df.where(F.col(value).isNotNull()), q, by)
    v = F.col(value)
    cnt = j.groupBy(*by).agg(_flag((v < F.col("lower_fence")) | (v > F.col("upper_fence"))).alias("outliers"))
    return q.join(cnt, by, "inner") if by else attach_stats(q, cnt, by)


def invalid_dates(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Non-null values that do not parse as a date."""
    s = F.col(col).cast("string")
    return df.groupBy(*by).agg(_flag(s.isNotNull() & F.try_to_timestamp(s).isNull()).alias("invalid_dates"))


def validation_report(score: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The human-readable validation report as rows (one line per check
    and group), built from the small score table with ``format_string`` -
    nothing is collected."""
    by = list(by)
    mark = lambda c: F.when(F.col(c), F.lit("PASS")).otherwise(F.lit("FAIL"))
    lines = [
        (1, F.format_string("Overall score: %.3f (%s)", F.col("score"), mark("overall_passed"))),
        (2, F.format_string("Schema validation: %s", mark("schema_passed"))),
        (3, F.format_string("Missing values: %s", mark("missing_passed"))),
        (4, F.format_string("Duplicate rows: %s", mark("duplicates_passed"))),
        (5, F.format_string("Data types: %s", mark("types_passed"))),
        (6, F.format_string("Business rules passed: %d of 4", F.col("rules_passed"))),
    ]
    arr = F.array(*[F.struct(F.lit(i).alias("line_no"), t.alias("text")) for i, t in lines])
    return score.select(*by, F.inline(arr))
