"""Mart semantics on literal frames: Q9 year choice, top-k tie-break, trend filters."""

from pyspark.sql import functions as F

from orrery.operators.dims import calendar
from orrery.plans import marts

FACT = "date_key int, country_key int, indicator_key int, value double, yoy_change double"


def _dims(spark):
    cal = calendar(spark, "2020-01-01", "2023-12-31")
    country = spark.createDataFrame([(1, "USA", "United States", "Americas", 37.09, -95.71)],
                                    "country_key int, country_code string, country_name string, region string, "
                                    "latitude double, longitude double")
    ind = spark.createDataFrame([(1, "NY.GDP.MKTP.CD"), (2, "FP.CPI.TOTL.ZG")], "indicator_key int, indicator_code string")
    return cal, country, ind


def test_country_map_year_rule(spark):
    cal, country, ind = _dims(spark)
    fact = spark.createDataFrame([(20201231, 1, 1, 10.0, None), (20211231, 1, 1, 11.0, 10.0),
                                  (20211231, 1, 2, 2.5, None)], FACT)
    as_of = F.to_date(F.lit("2023-06-01"))
    assert marts.country_map(fact, cal, country, ind, as_of).count() == 0  # calendar year 2023 has no facts
    r = marts.country_map(fact, cal, country, ind, as_of, latest_with_data=True).first()
    assert (r.gdp, r.inflation, r.gdp_growth) == (11.0, 2.5, None)


def test_kpi_latest_and_record(spark):
    cal, country, ind = _dims(spark)
    fact = spark.createDataFrame([(20201231, 1, 1, 10.0, None), (20211231, 1, 1, 11.0, 10.0)], FACT)
    latest = marts.kpi_latest(fact, cal, country, ind, "USA")
    assert [(r.indicator_code, r.value, r.yoy_change) for r in latest.collect()] == [("NY.GDP.MKTP.CD", 11.0, 10.0)]
    rec = marts.kpi_summary(fact, cal, country, ind, "USA", last_updated=F.lit("now")).first()
    assert rec.gdp.value == 11.0 and rec.gdp.change == 10.0 and rec.inflation.asDict() == {"value": None, "change": None} and rec.last_updated == "now"


def test_gdp_trend_filters(spark):
    cal, country, ind = _dims(spark)
    fact = spark.createDataFrame([(20201231, 1, 1, 10.0, None), (20211231, 1, 1, None, None),
                                  (20221231, 1, 1, 12.0, 20.0), (20221231, 1, 2, 3.0, None)], FACT)
    got = [(r.year, r.gdp) for r in marts.gdp_trend(fact, cal, country, ind, 2021, ["USA"]).collect()]
    assert got == [(2022, 12.0)]


def test_trade_flows_top_k_tie_break(spark):
    cal, country, _ = _dims(spark)
    country = country.unionByName(spark.createDataFrame(
        [(2, "CHN", "China", "Asia", 0.0, 0.0)], country.schema))
    sector = spark.createDataFrame([(1, "Energy")], "sector_key int, sector_name string")
    trade = spark.createDataFrame([
        (20210131, 1, 2, 1, 5e9, 4e9, 10.0), (20210131, 2, 1, 1, 5e9, 4e9, 20.0), (20220131, 1, 2, 1, 1e9, 1e9, None),
    ], "date_key int, exporter_key int, importer_key int, sector_key int, export_value_usd double, "
       "import_value_usd double, yoy_growth double")
    top = marts.trade_flows(trade, cal, country, sector, 2021, 2).collect()
    assert [(r.exporter, r.year, r.export_bn) for r in top] == [("China", 2021, 5.0), ("United States", 2021, 5.0)]
