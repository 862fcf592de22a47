"""Literal unit fixtures: period parsing, country codes, change maths."""

from pyspark.sql import functions as F

from orrery.functions.country import standardise_country, payload_code
from orrery.functions.numeric import envelope_high, envelope_low, pct_change, safe_ratio
from orrery.functions.period import parse_period, quarter_end_key


def test_period_strict(spark):
    rows = [("2023",), ("2023Q2",), ("2023Q7",), ("2023-Q1",), ("2023-01",), ("",), (None,)]
    df = parse_period(spark.createDataFrame(rows, "period string"), "period", "strict")
    got = {r.period: (r.year, r.quarter, r.date_key) for r in df.collect()}
    assert got["2023"] == (2023, None, 20231231)
    assert got["2023Q2"] == (2023, 2, 20230630)
    assert got["2023Q7"] == (2023, 7, 20231231)
    for p in ("2023-Q1", "2023-01", "", None):
        assert got[p] == (None, None, None)


def test_period_extended(spark):
    rows = [("2023-Q1",), ("2023-02",), ("2023-13",), ("2024",)]
    df = parse_period(spark.createDataFrame(rows, "period string"), "period", "extended")
    got = {r.period: (r.year, r.quarter, r.month, r.date_key) for r in df.collect()}
    assert got["2023-Q1"] == (2023, 1, None, 20230331)
    assert got["2023-02"] == (2023, 1, 2, 20230228)
    assert got["2023-13"] == (None, None, None, None)
    assert got["2024"] == (2024, None, None, 20241231)


def test_quarter_end_key(spark):
    df = spark.createDataFrame([(2023, q) for q in range(1, 5)], "y int, q int")
    keys = [r.k for r in df.select(quarter_end_key("y", "q").alias("k")).orderBy("k").collect()]
    assert keys == [20230331, 20230630, 20230930, 20231231]


def test_country_standardise(spark):
    df = spark.createDataFrame([("USA",), ("US",), ("ZZ",), (None,)], "country_code_2 string")
    got = sorted(r.country_iso3 for r in standardise_country(df).collect())
    assert got == ["USA", "USA"]


def test_country_standardise_with_table(spark):
    df = spark.createDataFrame([("USA",), ("US",), ("ZZ",)], "country_code_2 string")
    m = spark.createDataFrame([("US", "USA")], "a string, b string")
    assert sorted(r.country_iso3 for r in standardise_country(df, mapping=m).collect()) == ["USA", "USA"]


def test_payload_code(spark):
    df = spark.createDataFrame([("USA", "US"), ("", "CN"), (None, "IN"), ("DEUX", "DE")], "a string, b string")
    assert [r.c for r in df.select(payload_code("a", "b").alias("c")).collect()] == ["USA", "CN", "IN", "DEU"]


def test_pct_change_and_guards(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 0.0), (3.0, None), (-1.0, -2.0)], "v double, p double")
    got = [r.c for r in df.select(pct_change("v", "p").alias("c")).collect()]
    assert got == [100.0, None, None, 50.0]
    signed = [r.c for r in df.select(pct_change("v", "p", 2, use_abs=False).alias("c")).collect()]
    assert signed[3] == -50.0
    assert df.select(safe_ratio("v", "p").alias("r")).collect()[1].r is None


def test_envelope(spark):
    df = spark.createDataFrame([(100.0, 110.0)], "o double, c double")
    r = df.select(envelope_high("o", "c").alias("h"), envelope_low("o", "c").alias("l")).first()
    assert (r.h, r.l) == (110.55, 99.5)


def test_with_defaults(spark):
    from orrery.functions.keys import with_defaults
    df = spark.createDataFrame([("a", None), ("b", 3)], "k string, reliability int")
    out = with_defaults(df, {"reliability": 5, "is_active": True})
    assert [(r.k, r.reliability, r.is_active) for r in out.orderBy("k").collect()] == [("a", 5, True), ("b", 3, True)]


def test_lineage_run_id_and_key_to_date(spark):
    from orrery.functions.keys import run_id_of, with_lineage
    from orrery.functions.period import key_to_date
    df = spark.createDataFrame([(20240229,)], "k int")
    r = with_lineage(df, "World Bank", "20240101_000000").select(
        "source", "pipeline_run_id", key_to_date("k").alias("d"),
        run_id_of(F.lit("2024-01-02 03:04:05").cast("timestamp")).alias("rid")).first()
    assert (r.source, r.pipeline_run_id, str(r.d), r.rid) == ("World Bank", "20240101_000000", "2024-02-29",
                                                                "20240102_030405")
