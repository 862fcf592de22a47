"""Calendar and surrogate keys."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from orrery.operators.dims import calendar, sequential_keys
from orrery.plans.oracle import ORACLE_SQL
from orrery.plans.registry import QUERIES


def test_calendar_rows_and_fixtures(spark):
    cal = calendar(spark)
    assert cal.count() == 5844
    r = cal.filter(F.col("date_key") == 20160101).first()
    assert (r.week, r.is_weekend, r.day_name, r.month_name) == (53, False, "Friday", "January")
    r = cal.filter(F.col("date_key") == 20220507).first()
    assert (r.week, r.is_weekend) == (18, True)
    assert r.fiscal_year == 2022 and r.fiscal_quarter == 2


def test_calendar_fiscal_shift(spark):
    cal = calendar(spark, "2023-10-01", "2023-10-01", fiscal_shift_months=3)
    r = cal.first()
    assert (r.year, r.fiscal_year, r.fiscal_quarter) == (2023, 2024, 1)


def test_calendar_query_holds_its_range_and_every_date(spark, tmp_dir):
    """No day of the fixed range goes, and neither do order or ship dates outside it."""
    day = lambda *d: dt.datetime(*d)
    for ordered, shipped, first, last in (([day(1996, 5, 1)], [day(1997, 2, 1)], dt.date(1990, 1, 1), dt.date(2004, 12, 31)),
                                          ([day(2011, 3, 4), None], [day(1987, 6, 7)], dt.date(1987, 1, 1), dt.date(2011, 12, 31)),
                                          ([], [], dt.date(1990, 1, 1), dt.date(2004, 12, 31))):
        path = f"{tmp_dir}/{len(ordered)}{first}"
        for table, key, column, dates in (("orders", "o_orderkey", "o_orderdate", ordered), ("lineitem", "l_orderkey", "l_shipdate", shipped)):
            spark.createDataFrame([(i, d) for i, d in enumerate(dates)], f"{key} long, {column} timestamp_ntz").write.parquet(f"{path}/{table}.parquet")
        got = sorted(r.full_date for r in QUERIES["calendar_dim"](spark, path).select("full_date").collect())
        assert (got[0], got[-1], len(got), len(set(got))) == (first, last, (last - first).days + 1, (last - first).days + 1)
        con = duckdb.connect()
        for table in ("orders", "lineitem"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}/{table}.parquet/*.parquet')")
        assert sorted(r[0] for r in con.execute(f"SELECT full_date FROM ({ORACLE_SQL['calendar_dim']})").fetchall()) == got


def test_sequential_keys_do_not_depend_on_partitions(spark):
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select("c_custkey", "c_nationkey")
    small = sequential_keys(c, ["c_nationkey", "c_custkey"], "k", start=1)
    big = sequential_keys(c.repartition(3), ["c_nationkey", "c_custkey"], "k", start=1)
    assert sequential_keys(c.limit(0), ["c_custkey"], "k").count() == 0
    a = {(r.c_custkey, r.k) for r in small.collect()}
    b = {(r.c_custkey, r.k) for r in big.collect()}
    n = c.count()
    assert a == b and {k for _, k in a} == set(range(1, n + 1))
