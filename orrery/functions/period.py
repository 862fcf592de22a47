"""Reporting-period parsing: period text -> year, quarter, month, period-end date key.

Two modes:

* ``strict``   accepts ``YYYY`` and ``YYYYQn`` only. ``YYYY-Qn`` and ``YYYY-MM``
  give NULL year and date key. A quarter digit outside 1-4 (``2023Q7``) keeps
  its value and falls back to the year-end key.
* ``extended`` also accepts ``YYYY-Qn`` and ``YYYY-MM`` (month-end key).

One pattern per mode has the year and, as optional groups, the quarter and the month; a
group that is not there is the empty text, which ``try_cast`` makes NULL, so no cast sees
malformed text (safe under ANSI mode).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted forms; groups: year, quarter digit, month.
FORMS = {"strict": r"^(\d{4})(?:Q(\d))?$", "extended": r"^(\d{4})(?:-?Q(\d)|-(0[1-9]|1[0-2]))?$"}


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def period_parts(period: str | Column, mode: str = "strict") -> Column:
    """Struct of ``year``, ``quarter`` and ``month`` (integers, NULL where the form has none); a month implies its quarter."""
    def group(n: int) -> Column:
        return F.regexp_extract(_c(period), FORMS[mode], n).try_cast("int")

    month = group(3) if mode == "extended" else F.lit(None).cast("int")
    return F.struct(group(1).alias("year"), F.coalesce(group(2), F.ceil(month / 3).cast("int")).alias("quarter"), month.alias("month"))


def period_year(period: str | Column, mode: str = "strict") -> Column:
    return period_parts(period, mode)["year"]


def period_quarter(period: str | Column, mode: str = "strict") -> Column:
    return period_parts(period, mode)["quarter"]


def period_month(period: str | Column, mode: str = "strict") -> Column:
    """Month number; only the extended ``YYYY-MM`` form carries one."""
    return period_parts(period, mode)["month"]


def month_end_key(year: Column, month: Column) -> Column:
    """``YYYYMMDD`` int of the last day of a month (years from 0000 to 9999)."""
    day = F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))
    return (year * 10000 + month * 100 + day).cast("int")


def period_end_key(year: Column, quarter: Column, month: Column | None = None) -> Column:
    """``YYYYMMDD`` int of the period's last day: that of its month if it has one, else of
    the last month of its quarter, else of December (also for a quarter digit outside 1-4)."""
    last_month = F.when(quarter.between(1, 4), quarter * 3).otherwise(12)
    if month is not None:
        last_month = F.coalesce(month, last_month)
    return month_end_key(year, last_month)


def quarter_end_key(year: str | Column, quarter: str | Column) -> Column:
    """Quarter-end key from numeric (year, quarter); same as the strict text rule for 1-4."""
    return month_end_key(_c(year), _c(quarter) * 3)


def date_key(d: str | Column) -> Column:
    """``YYYYMMDD`` int of a date or timestamp."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def key_to_date(key: str | Column) -> Column:
    return F.to_date(_c(key).cast("string"), "yyyyMMdd")


def frequency(quarter: Column, month: Column | None = None) -> Column:
    """``A``, ``Q`` or ``M``: an annual and a fourth-quarter value end on the same day and are told apart by this."""
    f = F.when(quarter.isNotNull(), F.lit("Q")).otherwise(F.lit("A"))
    return f if month is None else F.when(month.isNotNull(), F.lit("M")).otherwise(f)


def parse_period(df, col: str = "period", mode: str = "strict"):
    """Add ``year``, ``quarter``, ``month`` (extended only) and ``date_key``."""
    df = df.withColumn("__parts", period_parts(col, mode))
    y, q, m = (F.col(f"__parts.{c}") for c in ("year", "quarter", "month"))
    out = {"year": y, "quarter": q, "date_key": period_end_key(y, q, m)}
    return df.withColumns({**out, "month": m} if mode == "extended" else out).drop("__parts")
