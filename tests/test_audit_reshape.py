"""Audits and reshapes."""

from pyspark.sql import functions as F

from orrery.operators.audit import completeness_gap, expected_grid, fk_audit, null_audit, quarantine_split, unique_audit
from orrery.operators.reshape import arrays_to_long, kpi_record, series_to_arrays, unpivot


def test_fk_unique_null(spark):
    fact = spark.createDataFrame([(1, 10), (2, 10), (3, None)], "k int, d int")
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    r = fk_audit(fact, [("k", "k", dim, "k")]).first()
    assert (r.fk_name, r.orphan_rows, r.orphan_keys) == ("k", 1, 1)
    assert [(x.d, x.n) for x in unique_audit(fact, ["d"]).collect()] == [(10, 2)]
    got = {x.column_name: x.null_count for x in null_audit(fact).collect()}
    assert got == {"k": 0, "d": 1}


def test_completeness(spark):
    base = spark.createDataFrame([("A",), ("B",)], "c string")
    grid = expected_grid(base, {"y": F.sequence(F.lit(2020), F.lit(2021))})
    present = spark.createDataFrame([("A", 2020), ("B", 2021)], "c string, y int")
    assert sorted((r.c, r.y) for r in completeness_gap(grid, present, ["c", "y"]).collect()) == [("A", 2021), ("B", 2020)]


def test_quarantine(spark):
    st = spark.createDataFrame([("1.5", "2020"), ("abc", "2020"), (None, "bad")], "raw_value string, period string")
    good, bad = quarantine_split(st, checks=[(F.col("period").rlike(r"^\d{4}$"), "bad period")])
    assert [r.value for r in good.collect()] == [1.5]
    assert sorted(r.error_message for r in bad.collect()) == ["bad period", "value not double"]


def test_arrays_roundtrip_and_gaps(spark):
    long_in = spark.createDataFrame([("A", 2016, 1.0), ("A", 2018, 3.0), ("B", 2017, 0.0)], "k string, y int, v double")
    wide = series_to_arrays(long_in, ["k"], "y", ["v"])
    got = {r.k: (r.base_year, r.v) for r in wide.collect()}
    assert got == {"A": (2016, [1.0, None, 3.0]), "B": (2017, [0.0])}
    back = arrays_to_long(wide, ["k"], ["v"], "base_year", "y", drop_falsy=["v"])
    assert sorted((r.k, r.y, r.v) for r in back.collect() if r.v is not None) == [("A", 2016, 1.0), ("A", 2018, 3.0)]
    assert back.count() == 4


def test_unpivot_and_kpi_record(spark):
    wide = spark.createDataFrame([("A", 1.0, 2.0)], "k string, x double, y double")
    long = unpivot(wide, ["k"], {"x": "X", "y": "Y"}, "code", "value")
    assert sorted((r.code, r.value) for r in long.collect()) == [("X", 1.0), ("Y", 2.0)]
    rec = kpi_record(long.withColumn("ch", F.lit(None).cast("double")), "code", {"x": "X", "missing": "Z"},
                     {"value": "value", "change": "ch"}).first()
    assert rec.x.value == 1.0 and rec.missing.asDict() == {"value": None, "change": None}
