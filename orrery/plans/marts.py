"""The five analytic marts over the star schema (M-01..M-05).

Each mart takes fact and dimension frames and returns a lazy DataFrame.
Only the calendar (bounded by its date span) carries a broadcast hint; other
dimensions are broadcast by the planner's size estimate or by AQE once their
runtime size is known, and stay sort-merge joins when they are large. Facts
are never broadcast.
Predicates on dimensions (code, country list, year) are applied before the
joins so Catalyst can push what it can into the scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.operators.joins import bounded
from orrery.operators.reshape import kpi_record

# The reference's KPI, trend and map codes (defaults only).
KPI_CODES = {
    "gdp": "NY.GDP.MKTP.CD",
    "gdp_growth": "NY.GDP.MKTP.KD.ZG",
    "inflation": "FP.CPI.TOTL.ZG",
    "unemployment": "SL.UEM.TOTL.ZS",
    "trade_balance": "BN.CAB.XOKA.CD",
}
MAP_CODES = {
    "gdp": "NY.GDP.MKTP.CD",
    "gdp_growth": "NY.GDP.MKTP.KD.ZG",
    "inflation": "FP.CPI.TOTL.ZG",
    "unemployment": "SL.UEM.TOTL.ZS",
}
TREND_CODE = "NY.GDP.MKTP.CD"
TREND_COUNTRIES = ("USA", "CHN", "IND", "DEU", "GBR")


def _star(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame, dim_indicator: DataFrame) -> DataFrame:
    """fact x date x country x indicator, inner equi-joins on surrogate keys (J-01).
    Only the calendar is hinted; the others are left to the size-based planner and AQE."""
    return (fact.join(bounded(dim_date), "date_key")
                .join(dim_country, "country_key")
                .join(dim_indicator, "indicator_key"))


def kpi_latest(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame, dim_indicator: DataFrame,
               country: str = "USA", codes: Sequence[str] = tuple(KPI_CODES.values())) -> DataFrame:
    """Latest ``(indicator_code, value, yoy_change)`` per code for one country (M-01).

    ``row_number`` with a full tie-break (date, then fact key); the optimiser
    turns ``rn = 1`` into a partial top-1 before the shuffle (WindowGroupLimit).
    """
    d = dim_date.select("date_key", "full_date")
    c = dim_country.filter(F.col("country_code") == country).select("country_key")
    i = dim_indicator.filter(F.col("indicator_code").isin(*codes)).select("indicator_key", "indicator_code")
    j = _star(fact.select("date_key", "country_key", "indicator_key", "value", "yoy_change"), d, c, i)
    w = Window.partitionBy("indicator_code").orderBy(F.col("full_date").desc(), F.col("value").desc(),
                                                    F.col("yoy_change").desc())
    return (j.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1)
             .select("indicator_code", "value", "yoy_change"))


def kpi_summary(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame, dim_indicator: DataFrame,
                country: str = "USA", named_codes: dict[str, str] | None = None,
                last_updated: Column | None = None) -> DataFrame:
    """One-row KPI record: ``{name: {value, change}}`` per code, of NULLs where it is missing (A-07)."""
    named = named_codes or KPI_CODES
    latest = kpi_latest(fact, dim_date, dim_country, dim_indicator, country, tuple(named.values()))
    rec = kpi_record(latest, "indicator_code", named, {"value": "value", "change": "yoy_change"})
    stamp = last_updated if last_updated is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm 'UTC'")
    return rec.withColumn("last_updated", stamp)


def gdp_trend(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame, dim_indicator: DataFrame,
              year_start: int = 2015, countries: Sequence[str] = TREND_COUNTRIES,
              code: str = TREND_CODE) -> DataFrame:
    """Yearly value and change of one indicator for a country list (M-02)."""
    d = dim_date.filter(F.col("year") >= year_start).select("date_key", F.col("year").cast("int").alias("year"))
    c = dim_country.filter(F.col("country_code").isin(*countries)).select("country_key", "country_code",
                                                                          "country_name")
    i = dim_indicator.filter(F.col("indicator_code") == code).select("indicator_key")
    f = fact.filter(F.col("year") >= year_start) if "year" in fact.columns else fact  # prunes a stored fact's partitions
    f = f.filter(F.col("value").isNotNull()).select("date_key", "country_key", "indicator_key", "value", "yoy_change")
    j = _star(f, d, c, i)
    return (j.select("country_code", "country_name", "year", F.col("value").alias("gdp"),
                     F.col("yoy_change").alias("growth"))
             .orderBy(F.col("country_code").asc_nulls_last(), F.col("year").asc_nulls_last()))


def sector_heatmap(market: DataFrame, dim_date: DataFrame, dim_sector: DataFrame,
                   year_start: int = 2020, scale: int = 6) -> DataFrame:
    """Average return and P/E per sector and quarter (M-03, A-01, A-02).

    Return is ``avg(close / nullif(open, 0) - 1) * 100``; a zero open price
    gives NULL for that row, which ``avg`` skips.
    """
    d = dim_date.filter(F.col("year") >= year_start).select(
        "date_key", F.col("year").cast("int").alias("year"), F.col("quarter").cast("int").alias("quarter"))
    s = dim_sector.select("sector_key", "sector_name")
    market = market.filter(F.col("year") >= year_start).drop("year") if "year" in market.columns else market
    j = market.join(bounded(d), "date_key").join(s, "sector_key")
    close, opened = F.col("close_price").cast("double"), F.col("open_price").cast("double")
    ratio = F.try_divide(close, F.nullif(opened, F.lit(0.0))) - 1
    g = j.groupBy("sector_name", "year", "quarter").agg(
        F.round(F.avg(ratio) * 100, scale).alias("return_pct"),
        F.round(F.avg(F.col("pe_ratio").cast("double")), 4).alias("pe_ratio"))
    return g.orderBy(F.col("year").desc_nulls_first(), F.col("quarter").desc_nulls_first(),
                     F.col("sector_name").asc())


def country_map(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame, dim_indicator: DataFrame,
                as_of: Column | None = None, columns: dict[str, str] | None = None,
                latest_with_data: bool = False) -> DataFrame:
    """One row per country with one column per code for a single year (M-04).

    The year is ``max(year)`` of the calendar up to ``as_of`` (default today),
    computed once as a scalar subquery; ``latest_with_data`` uses the latest
    year that has facts instead. The pivot is one conditional-max aggregate.
    """
    cols = columns or MAP_CODES
    as_of = as_of if as_of is not None else F.current_date()
    i = dim_indicator.filter(F.col("indicator_code").isin(*cols.values())).select("indicator_key", "indicator_code")
    if latest_with_data:
        with_data = fact.join(bounded(dim_date.select("date_key", "year")), "date_key")
        year = with_data.filter(F.col("year") <= F.year(as_of)).agg(F.max("year")).scalar()
    else:
        year = dim_date.filter(F.col("full_date") <= as_of).agg(F.max("year")).scalar()
    d = dim_date.filter(F.col("year") == year).select("date_key")
    c = dim_country.select("country_key", "country_name", "country_code", "latitude", "longitude", "region")
    j = _star(fact.select("date_key", "country_key", "indicator_key", "value"), d, c, i)
    aggs = [F.max(F.when(F.col("indicator_code") == code, F.col("value"))).alias(name) for name, code in cols.items()]
    return j.groupBy("country_name", "country_code", "latitude", "longitude", "region").agg(*aggs)


def trade_flows(trade: DataFrame, dim_date: DataFrame, dim_country: DataFrame, dim_sector: DataFrame,
                year_start: int = 2020, k: int = 100) -> DataFrame:
    """Top-``k`` exporter/importer/sector/year flows by export value in billions (M-05).

    The country dimension plays two roles (exporter, importer). Sums are exact
    decimals, scaled once to billions as double. Ties are broken on every
    output key so the top-k is deterministic; the limit becomes a
    TakeOrderedAndProject (per-partition top-k, then a k-row merge).
    """
    d = dim_date.filter(F.col("year") >= year_start).select("date_key", F.col("year").cast("int").alias("year"))
    ce = dim_country.select(F.col("country_key").alias("exporter_key"), F.col("country_name").alias("exporter"))
    ci = dim_country.select(F.col("country_key").alias("importer_key"), F.col("country_name").alias("importer"))
    s = dim_sector.select("sector_key", "sector_name")
    trade = trade.filter(F.col("year") >= year_start).drop("year") if "year" in trade.columns else trade
    j = (trade.join(bounded(d), "date_key").join(ce, "exporter_key")
              .join(ci, "importer_key").join(s, "sector_key"))
    g = j.groupBy("exporter", "importer", "sector_name", "year").agg(
        (F.sum("export_value_usd").cast("double") / 1e9).alias("export_bn"),
        (F.sum("import_value_usd").cast("double") / 1e9).alias("import_bn"),
        F.round(F.sum("yoy_growth").cast("double") / F.count("yoy_growth"), 4).alias("growth_pct"),
    )
    return g.orderBy(F.col("export_bn").desc_nulls_first(), "exporter", "importer", "sector_name",
                     "year").limit(k)
