"""Literal dimension seeds (S-10).

Fixed values: the dimension rows the warehouse is seeded with (countries,
indicators, sectors, sources), in their original order. Keys are assigned
at load time in this order, starting at 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Countries (code, name, region, sub-region, income group, currency, latitude, longitude, G20).
COUNTRIES = [
    ("USA", "United States", "Americas", "Northern America", "High income", "USD", 37.09, -95.71, True),
    ("CHN", "China", "Asia", "Eastern Asia", "Upper middle income", "CNY", 35.86, 104.19, True),
    ("IND", "India", "Asia", "Southern Asia", "Lower middle income", "INR", 20.59, 78.96, True),
    ("DEU", "Germany", "Europe", "Western Europe", "High income", "EUR", 51.17, 10.45, True),
    ("GBR", "United Kingdom", "Europe", "Northern Europe", "High income", "GBP", 55.38, -3.44, True),
    ("JPN", "Japan", "Asia", "Eastern Asia", "High income", "JPY", 36.20, 138.25, True),
    ("FRA", "France", "Europe", "Western Europe", "High income", "EUR", 46.23, 2.21, True),
    ("BRA", "Brazil", "Americas", "South America", "Upper middle income", "BRL", -14.24, -51.93, True),
    ("CAN", "Canada", "Americas", "Northern America", "High income", "CAD", 56.13, -106.35, True),
    ("AUS", "Australia", "Oceania", "Australia/NZ", "High income", "AUD", -25.27, 133.78, True),
    ("KOR", "South Korea", "Asia", "Eastern Asia", "High income", "KRW", 35.91, 127.77, True),
    ("MEX", "Mexico", "Americas", "Central America", "Upper middle income", "MXN", 23.63, -102.55, True),
    ("IDN", "Indonesia", "Asia", "South-eastern Asia", "Lower middle income", "IDR", -0.79, 113.92, True),
    ("SAU", "Saudi Arabia", "Asia", "Western Asia", "High income", "SAR", 23.88, 45.08, True),
    ("ZAF", "South Africa", "Africa", "Sub-Saharan Africa", "Upper middle income", "ZAR", -30.56, 22.94, True),
    ("RUS", "Russia", "Europe", "Eastern Europe", "Upper middle income", "RUB", 61.52, 105.32, True),
    ("TUR", "Türkiye", "Asia", "Western Asia", "Upper middle income", "TRY", 38.96, 35.24, True),
    ("ARG", "Argentina", "Americas", "South America", "Upper middle income", "ARS", -38.42, -63.62, True),
    ("SGP", "Singapore", "Asia", "South-eastern Asia", "High income", "SGD", 1.35, 103.82, False),
    ("NLD", "Netherlands", "Europe", "Western Europe", "High income", "EUR", 52.13, 5.29, False),
]

# Indicators (code, name, category, sub-category, unit, source, frequency).
INDICATORS = [
    ("NY.GDP.MKTP.CD", "GDP (current USD)", "Macroeconomic", "Output & Growth", "USD Billion", "World Bank", "Annual"),
    ("NY.GDP.MKTP.KD.ZG", "GDP Growth Rate", "Macroeconomic", "Output & Growth", "%", "World Bank", "Annual"),
    ("FP.CPI.TOTL.ZG", "Inflation (CPI)", "Macroeconomic", "Prices", "%", "World Bank", "Annual"),
    ("SL.UEM.TOTL.ZS", "Unemployment Rate", "Labor", "Employment", "%", "World Bank", "Annual"),
    ("BN.CAB.XOKA.CD", "Current Account Balance", "Trade", "Balance of Payments", "USD Billion", "World Bank",
     "Annual"),
    ("NE.EXP.GNFS.ZS", "Exports (% of GDP)", "Trade", "External Sector", "%", "World Bank", "Annual"),
    ("NE.IMP.GNFS.ZS", "Imports (% of GDP)", "Trade", "External Sector", "%", "World Bank", "Annual"),
    ("GC.DOD.TOTL.GD.ZS", "Government Debt (% of GDP)", "Fiscal", "Public Finance", "%", "World Bank", "Annual"),
    ("FR.INR.RINR", "Real Interest Rate", "Monetary", "Interest Rates", "%", "World Bank", "Annual"),
    ("SP.POP.TOTL", "Total Population", "Demographic", "Population", "Millions", "World Bank", "Annual"),
    ("NY.GNP.PCAP.CD", "GNI per Capita", "Macroeconomic", "Income", "USD", "World Bank", "Annual"),
    ("EG.USE.PCAP.KG.OE", "Energy Use per Capita", "Environment", "Energy", "kg oil equiv", "World Bank", "Annual"),
    ("IT.NET.USER.ZS", "Internet Users (% of population)", "Technology", "Digital", "%", "World Bank", "Annual"),
    ("SE.XPD.TOTL.GD.ZS", "Education Spending (% of GDP)", "Social", "Education", "%", "World Bank", "Annual"),
]

# Sectors (code, name, GICS code).
SECTORS = [
    ("ENERGY", "Energy", "10"),
    ("MATERIALS", "Materials", "15"),
    ("INDUSTRIAL", "Industrials", "20"),
    ("CONS_DISC", "Consumer Discretionary", "25"),
    ("CONS_STAP", "Consumer Staples", "30"),
    ("HEALTH", "Health Care", "35"),
    ("FINANCIAL", "Financials", "40"),
    ("IT", "Information Technology", "45"),
    ("COMMS", "Communication Services", "50"),
    ("UTILITIES", "Utilities", "55"),
    ("REAL_EST", "Real Estate", "60"),
]

# Sources (name, URL, reliability).
SOURCES = [
    ("World Bank", "https://data.worldbank.org", 9),
    ("FRED", "https://fred.stlouisfed.org", 10),
    ("Yahoo Finance", "https://finance.yahoo.com", 7),
    ("UN Comtrade", "https://comtradeplus.un.org", 8),
]


def countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        COUNTRIES, "country_code string, country_name string, region string, sub_region string, "
                   "income_group string, currency_code string, latitude double, longitude double, is_g20 boolean")


def indicators(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        INDICATORS, "indicator_code string, indicator_name string, category string, sub_category string, "
                    "unit string, source string, frequency string")


def sectors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SECTORS, "sector_code string, sector_name string, gics_code string")


def sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCES, "source_name string, source_url string, reliability int")
