"""Monthly period arithmetic (F19). A period is a ``yyyy-MM`` string."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PERIOD_PATTERN = r"^[0-9]{4}-(0[1-9]|1[0-2])$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_of(d) -> Column:
    """``yyyy-MM`` of a date."""
    return F.date_format(_col(d), "yyyy-MM")


def period_start(p) -> Column:
    """First day of the period; a malformed period gives null (ANSI-safe)."""
    return F.concat(_col(p), F.lit("-01")).try_cast("date")


def period_end(p) -> Column:
    """Last day of the period (snapshot date)."""
    return F.last_day(period_start(p))


def is_valid_period(p) -> Column:
    return F.coalesce(_col(p).rlike(PERIOD_PATTERN), F.lit(False))


def next_period(p, n: int = 1) -> Column:
    return period_of(F.add_months(period_start(p), n))


def previous_period(p) -> Column:
    """Default reference month: first day of the month minus 10 days."""
    return period_of(F.date_sub(period_start(p), 10))


def period_range(p, n: int) -> Column:
    """Array of ``n`` consecutive periods starting at ``p``."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: period_of(F.add_months(period_start(p), i)))
