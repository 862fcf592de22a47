"""Country-code standardisation (alpha-2 -> alpha-3) and payload code choice."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The alpha-2 -> alpha-3 pairs the pipeline resolves by default.
ISO2_TO_ISO3 = {
    "US": "USA", "CN": "CHN", "IN": "IND", "DE": "DEU", "GB": "GBR", "JP": "JPN",
    "FR": "FRA", "BR": "BRA", "CA": "CAN", "AU": "AUS", "KR": "KOR", "MX": "MEX",
    "ID": "IDN", "SA": "SAU", "ZA": "ZAF", "RU": "RUS", "TR": "TUR", "AR": "ARG",
    "SG": "SGP", "NL": "NLD",
}


def map_literal(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def standard_code(code: str | Column, mapping: dict[str, str] | None = None) -> Column:
    """Three-letter codes pass through; others resolve through ``mapping``; unknown -> NULL.

    ``try_element_at`` keeps a missing or NULL key NULL under ANSI mode.
    """
    c = F.col(code) if isinstance(code, str) else code
    m = map_literal(ISO2_TO_ISO3 if mapping is None else mapping)
    return F.when(F.length(c) == 3, c).otherwise(F.try_element_at(m, c))


def standardise_country(df: DataFrame, col: str = "country_code_2", out: str = "country_iso3",
                        mapping: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """Add the standard code and drop rows whose code does not resolve (F-02).

    ``mapping`` may be a dict (inlined as a map literal, so for code lists) or a
    two-column DataFrame ``(code_2, code_3)`` of any size, left-joined; the planner
    broadcasts it if its size allows. A code that the frame maps twice takes the
    smaller target.
    """
    return with_standard_code(df, col, out, mapping).filter(F.col(out).isNotNull())


def with_standard_code(df: DataFrame, col: str = "country_code_2", out: str = "country_iso3",
                       mapping: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """As ``standardise_country``, but rows that do not resolve stay, with a NULL code."""
    if isinstance(mapping, DataFrame):
        src, dst = mapping.columns[:2]
        m = mapping.groupBy(F.col(src).alias("__code2")).agg(F.min(dst).alias("__code3"))
        joined = df.join(m, df[col] == m["__code2"], "left")
        return joined.withColumn(out, F.when(F.length(col) == 3, F.col(col)).otherwise(F.col("__code3"))).drop("__code2", "__code3")
    return df.withColumn(out, standard_code(col, mapping))


def payload_code(iso3: str | Column, fallback_id: str | Column) -> Column:
    """First three characters of the payload's alpha-3 code, or ``country.id`` when empty."""
    a = F.col(iso3) if isinstance(iso3, str) else iso3
    b = F.col(fallback_id) if isinstance(fallback_id, str) else fallback_id
    return F.coalesce(F.nullif(F.substring(a, 1, 3), F.lit("")), b)
