"""Order-insensitive comparison of two result tables (test helper)."""

from __future__ import annotations

import math

import pandas as pd


def _norm(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int, float)):
        return v
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    s = str(v)
    return s[:10] if len(s) >= 19 and s[10:] in (" 00:00:00", "T00:00:00") else s


def _key(v):
    if v is None:
        return (1, "")
    if isinstance(v, float):
        return (0, f"{v:.4g}")
    return (0, str(v))


def canonical(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda t: tuple(_key(x) for x in t))


def same_value(a, b, rel: float = 1e-9, abs_: float = 1e-9) -> bool:
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return math.isclose(float(a), float(b), rel_tol=rel, abs_tol=abs_)
    return a == b


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when equal (floats within 1e-9), else a short reason."""
    c1, r1 = canonical(got)
    c2, r2 = canonical(want)
    if c1 != c2:
        return f"columns differ: only here {set(c1) - set(c2)}, only there {set(c2) - set(c1)}"
    if len(r1) != len(r2):
        return f"row counts {len(r1)} vs {len(r2)}"
    for a, b in zip(r1, r2):
        if not all(same_value(x, y) for x, y in zip(a, b)):
            return f"first differing row {a} vs {b}"
    return None
