"""Change windows, anomaly gate, calendar-aware change, revision flag."""

from pyspark.sql import functions as F

from orrery.operators.change import anomaly_gate, calendar_change, flag_anomalies, pct_change_prev, revision_flag


def _series(spark):
    rows = [("USA", "X", y, v) for y, v in zip(range(2016, 2021), [1.0, 2.0, 9.0, 0.0, 5.0])]
    return spark.createDataFrame(rows, "c string, i string, year int, value double")


def test_change_series(spark):
    df = pct_change_prev(_series(spark), ["c", "i"], ["year"], "value", "yoy_change")
    got = [r.yoy_change for r in df.orderBy("year").collect()]
    assert got == [None, 100.0, 350.0, -100.0, None]


def test_gate_drops_anomalies_and_unscored(spark):
    df = flag_anomalies(pct_change_prev(_series(spark), ["c", "i"], ["year"], "value", "yoy_change"))
    kept = sorted(r.yoy_change for r in anomaly_gate(df).collect())
    assert kept == [-100.0, 100.0]
    with_unscored = anomaly_gate(df, keep_unscored=True).count()
    assert with_unscored == 4


def test_null_order_sorts_first(spark):
    rows = [("A", "X", 2020, None, 5.0), ("A", "X", 2020, 1, 10.0)]
    df = spark.createDataFrame(rows, "c string, i string, year int, quarter int, value double")
    got = pct_change_prev(df, ["c", "i"], ["year", "quarter"], "value", "ch").orderBy(F.col("quarter").asc_nulls_first())
    assert [r.ch for r in got.collect()] == [None, 100.0]


def test_calendar_change_gap(spark):
    rows = [("A", i, float(v)) for i, v in [(10, 1), (11, 2), (13, 4), (22, 8), (23, 3)]]
    df = spark.createDataFrame(rows, "k string, idx int, value double")
    mom = {r.idx: r.ch for r in calendar_change(df, ["k"], "idx", "value", 1, "ch").collect()}
    assert mom == {10: None, 11: 100.0, 13: None, 22: None, 23: -62.5}
    yoy = {r.idx: r.ch for r in calendar_change(df, ["k"], "idx", "value", 12, "ch").collect()}
    assert yoy[22] == 700.0 and yoy[23] == 50.0 and yoy[13] is None


def test_revision_flag_bucketed_equals_plain(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plain = revision_flag(e, ["user_id", "event_type"], ["ts", "event_id"])
    split = revision_flag(e, ["user_id", "event_type"], ["ts", "event_id"], bucket=F.to_date("ts"))
    a = {(r.event_id, r.is_revised) for r in plain.select("event_id", "is_revised").collect()}
    b = {(r.event_id, r.is_revised) for r in split.select("event_id", "is_revised").collect()}
    assert a == b and len(a) == e.count()
