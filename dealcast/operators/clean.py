"""Cleaning, projection and schema-shape operators."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (DateType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

from dealcast.operators.stats import attach_stats, exact_quantiles
from dealcast.session import materialize

CLOSED = ("Won", "Lost")

# Column-name standardisation; the first rule whose words are all
# in the name gives the canonical name.
NAME_RULES = ((("opportunity", "id"), "opportunity_id"), (("sales", "agent"), "sales_agent"),
              (("account",), "account"), (("deal", "stage"), "deal_stage"),
              (("close", "value"), "close_value"), (("close", "date"), "close_date"),
              (("engage", "date"), "engage_date"), (("product",), "product"))


def text_columns(df: DataFrame) -> list[str]:
    """String columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def date_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))]


def standard_name(name: str, rules=NAME_RULES) -> str:
    """Lower-case, strip, ``' ', '-', '.'`` -> ``_``, drop parentheses, then
    the canonical name of the first rule whose words are all in the name."""
    n = re.sub(r"[()]", "", re.sub(r"[ \-.]", "_", name.lower().strip()))
    return next((canon for words, canon in rules if all(w in n for w in words)), n)


def clean_column_names(df: DataFrame, rules=NAME_RULES) -> DataFrame:
    """P1 (metadata only, no data pass). Two columns with one canonical name
    are an error: a table can't hold both."""
    names = [standard_name(c, rules) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"several columns become {', '.join(twice)}: {df.columns}")
    return df.toDF(*names)


def select_existing(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Keep the wanted columns that exist; report the missing ones."""
    have = [c for c in wanted if c in df.columns]
    return df.select(*have), [c for c in wanted if c not in df.columns]


def add_missing_as_zero(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Add absent feature columns as 0, then null -> 0 on the wanted set."""
    add = {c: F.lit(0) for c in wanted if c not in df.columns}
    return df.withColumns(add).fillna(0, subset=list(wanted))


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Hash aggregation on all columns (partial per partition, so a row
    repeated many times is collapsed map-side before the shuffle)."""
    return df.dropDuplicates()


def fill_text_unknown(df: DataFrame, value: str = "Unknown",
                      subset: Sequence[str] | None = None) -> DataFrame:
    """Null text -> ``'Unknown'``. Date columns are typed dates here, so
    they are not text and stay null (the reference filled them too)."""
    cols = list(subset) if subset is not None else text_columns(df)
    return df.fillna(value, subset=cols) if cols else df


def fill_numeric_median(df: DataFrame, cols: Sequence[str] | None = None,
                        by: Sequence[str] = (), stage: str = "deal_stage",
                        only_closed: bool = True) -> DataFrame:
    """Null numerics -> exact median of the column (over closed
    deals when ``only_closed``), computed per ``by`` group.

    Each median is one distributed exact-quantile job whose result is one row
    per group (periods: few); it is written and broadcast back, so the rows
    themselves are neither gathered nor shuffled.
    """
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=by)
    if not cols:
        return df
    base = df.where(F.col(stage).isin(*CLOSED)) if only_closed else df
    out = df
    for c in cols:
        med = exact_quantiles(base, c, [0.5], by=by, names=[f"_med_{c}"])
        if by:
            out = attach_stats(out, materialize(med), by)
        else:
            out = out.withColumn(f"_med_{c}", med.select(f"_med_{c}").scalar())
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_med_{c}").cast(df.schema[c].dataType)))
        out = out.drop(f"_med_{c}")
    return out.select(*df.columns)


def fill_open_value_zero(df: DataFrame, value: str = "close_value",
                         stage: str = "deal_stage") -> DataFrame:
    """C4: open deals with no value get 0."""
    open_ = ~F.coalesce(F.col(stage).isin(*CLOSED), F.lit(False))
    return df.withColumn(value, F.when(open_ & F.col(value).isNull(), F.lit(0.0))
                         .otherwise(F.col(value)))


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text -> double with unparsable values -> null (ANSI-safe)."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in cols})


def fill_nulls_by_type(df: DataFrame, text: str = "Unknown", number: float = 0.0,
                       date: str | None = None) -> DataFrame:
    """Type-directed null handling (text, numbers, optionally dates)."""
    out = df.fillna(text, subset=text_columns(df)) if text_columns(df) else df
    nums = numeric_columns(out)
    out = out.fillna(number, subset=nums) if nums else out
    if date is not None:
        out = out.withColumns({c: F.coalesce(F.col(c), F.to_date(F.lit(date)))
                               for c in date_columns(out)})
    return out


def clean_opportunities(df: DataFrame, by: Sequence[str] = (),
                        numeric: Sequence[str] | None = None, distinct: DataFrame | None = None) -> DataFrame:
    """C1 -> C2 -> C3 as the reference's ``clean_data``. ``numeric`` limits the
    median fill to columns known to hold nulls (each fill is one job). The
    distinct rows are written once, for the medians and for the rows; ``distinct`` is
    them, if they are written already."""
    out = fill_text_unknown(distinct if distinct is not None else materialize(drop_exact_duplicates(df)))
    nums = list(numeric) if numeric is not None else [c for c in numeric_columns(out) if c not in by]
    return fill_numeric_median(out, nums, by=by)


def time_slice(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Half-open time slice ``start <= ts < end`` (pushed to the scan)."""
    return df.where((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns present in both tables, in ``a``'s order (metadata only)."""
    return [c for c in a.columns if c in set(b.columns)]


def column_differences(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    """Columns only in ``a`` and only in ``b``."""
    return {"only_left": [c for c in a.columns if c not in b.columns],
            "only_right": [c for c in b.columns if c not in a.columns]}
