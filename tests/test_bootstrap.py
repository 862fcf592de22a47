"""Warehouse bootstrap and seed-style fact builders."""

import os

from pyspark.sql import functions as F

from orrery.plans.bootstrap import bootstrap, facts_from_arrays, market_grid


def test_bootstrap_counts_and_idempotence(spark, tmp_dir):
    wh = os.path.join(tmp_dir, "wh")
    first = bootstrap(spark, wh)
    assert first == {"dim_country": 20, "dim_indicator": 14, "dim_sector": 11, "dim_source": 4}
    assert spark.read.parquet(f"{wh}/dim_date").count() == 5844
    second = bootstrap(spark, wh)
    assert set(second.values()) == {0}
    c = spark.read.parquet(f"{wh}/dim_country")
    assert c.count() == 20 and c.filter("country_code = 'USA'").first().country_key == 1
    assert sorted(r.source_key for r in spark.read.parquet(f"{wh}/dim_source").collect()) == [1, 2, 3, 4]
    assert {r.is_active for r in spark.read.parquet(f"{wh}/dim_indicator").collect()} == {True}
    assert c.filter("country_code = 'NLD'").first().is_eu is False
    from orrery.schemas import TABLES
    for table in ("dim_date", "dim_country", "dim_indicator", "dim_sector", "dim_source"):
        written = spark.read.parquet(f"{wh}/{table}").schema
        assert [(f.name, f.dataType) for f in written] == [(f.name, f.dataType) for f in TABLES[table].fields]
    assert c.filter("created_at IS NULL").count() == 0 and c.filter("population IS NOT NULL").count() == 0


def test_facts_from_arrays(spark):
    series = spark.createDataFrame([("USA", [18.7, 19.5, 0.0, 21.4], [0.1, 1.3, 2.1, None])],
                                   "country_code string, gdp array<double>, inflation array<double>")
    f = facts_from_arrays(series, "country_code", {"gdp": "NY.GDP.MKTP.CD", "inflation": "FP.CPI.TOTL.ZG"}, 2016,
                          {"gdp": 1e9}, change_for=["gdp"])
    gdp = {r.year: (r.value, r.yoy_change) for r in f.filter(F.col("indicator_code") == "NY.GDP.MKTP.CD").collect()}
    assert gdp[2016] == (18.7e9, None) and gdp[2017][1] == 4.28
    assert 2018 not in gdp  # zero GDP is treated as missing
    assert gdp[2019][1] is None  # the previous position (2018) is missing, so no change
    assert f.filter(F.col("indicator_code") == "FP.CPI.TOTL.ZG").count() == 3


def test_market_grid(spark):
    sectors = spark.createDataFrame([(k,) for k in range(1, 12)], "sector_key int")
    g = market_grid(F.sequence(F.lit(2016), F.lit(2024)), sectors, F.array(*[F.lit(k) for k in range(1, 6)]))
    assert g.count() == 9 * 4 * 11 * 5
    r = g.filter("year = 2020 and quarter = 2 and sector_key = 3 and country_key = 4").first()
    assert (r.date_key, r.index_name) == (20200630, "IDX_4_3")
