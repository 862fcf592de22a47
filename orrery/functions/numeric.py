"""Numeric column expressions: guarded ratios, percent change, anomaly flag, scaling, price envelope."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / nullif(den, 0)``: NULL instead of an ANSI divide-by-zero error."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def pct_change(value: str | Column, prev: str | Column, scale: int | None = 4,
               use_abs: bool = True) -> Column:
    """``round((v - prev) / |prev| * 100, scale)``; NULL when prev is NULL or 0.

    ``use_abs=False`` divides by the signed previous value (seed variant).
    """
    v, p = _c(value), _c(prev)
    den = F.abs(p) if use_abs else p
    e = safe_ratio(v - p, den) * 100
    return F.round(e, scale) if scale is not None else e


def anomaly_flag(change: str | Column, threshold: float = 200.0) -> Column:
    """``|change| > threshold``; NULL when the change is NULL (three-valued)."""
    return F.abs(_c(change)) > F.lit(threshold)


def scaled(col: str | Column, factor: float) -> Column:
    """Unit scaling, e.g. ``1e-9`` for USD -> billions."""
    return _c(col) * F.lit(factor)


def money(col: str | Column, scale: int = 2, precision: int = 18) -> Column:
    """Cast a money value to a decimal so sums are exact and order-independent."""
    return _c(col).cast(f"decimal({precision},{scale})")


def cents(col: str | Column, decimals: int = 2) -> Column:
    """Money as an exact integer count of the smallest unit (``10**-decimals``).

    For values with at most ``decimals`` decimals (prices, rates in percent
    points) ``rint(x * 10**decimals)`` is exact and stays in primitive
    arithmetic, so sums run on longs instead of wide decimals (about 20x less
    CPU than summing ``decimal(18,2)``, whose sum buffer is a 28-digit decimal).
    """
    return F.rint(_c(col) * F.lit(float(10 ** decimals))).cast("long")


def from_cents(col: str | Column, decimals: int = 2) -> Column:
    """An integer amount of ``10**-decimals`` units back to an exact decimal."""
    return (_c(col).cast("decimal(38,0)") / F.lit(10 ** decimals)).cast(f"decimal(38,{decimals})")


def envelope_high(open_: str | Column, close: str | Column, pad: float = 0.005, scale: int = 2) -> Column:
    return F.round(F.greatest(_c(open_), _c(close)) * F.lit(1 + pad), scale)


def envelope_low(open_: str | Column, close: str | Column, pad: float = 0.005, scale: int = 2) -> Column:
    return F.round(F.least(_c(open_), _c(close)) * F.lit(1 - pad), scale)
