"""Versioned tables, fact revisions, and the pipeline at the cost of a run."""

import pytest
from pyspark.sql import functions as F

from orrery.operators.history import as_of, revise
from orrery.plans import pipeline
from orrery.plans import standins as si
from orrery.plans.incremental import Warehouse
from orrery.sources import raw_zone
from orrery.sources.versions import VersionedTable


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_versions_replace_partitions_and_readers_see_whole_ones(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t")
    assert t.head() is None and t.read() is None and t.vacuum() == []
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert t.publish(df, "k", [], "first") == 1
    assert t.publish(spark.createDataFrame([(2, "e"), (3, "f")], "k int, v string"), "k", [2, 3], "second") == 2
    assert rows(t.read(), "v") == [("a",), ("b",), ("d",), ("e",), ("f",)]
    assert rows(t.read(number=1), "v") == [("a",), ("b",), ("c",), ("d",)]
    assert rows(t.read([None, 3]), "v") == [("d",), ("f",)] and t.read([7]) is None
    assert t.head()["label"] == "second"
    # a partition that a version empties is gone; a write that fails leaves the version before
    t.publish(df.limit(0), "k", [1], "third")
    assert rows(t.read(), "v") == [("d",), ("e",), ("f",)]
    broken = df.withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        t.publish(broken, "k", [2], "fourth")
    assert t.head()["label"] == "third" and rows(t.read(), "v") == [("d",), ("e",), ("f",)]


def test_vacuum_keeps_what_kept_versions_name(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t")
    for n in range(4):
        t.publish(spark.createDataFrame([(n % 2, n)], "k int, v int"), "k", [n % 2], str(n))
    assert len(t.vacuum(keep=1)) == 2 and t._numbers() == [4]
    assert rows(t.read(), "k", "v") == [(0, 2), (1, 3)]
    assert t.vacuum(keep=1) == []


def test_two_writers_of_one_number(spark, tmp_dir, monkeypatch):
    a, b = VersionedTable(spark, f"{tmp_dir}/t"), VersionedTable(spark, f"{tmp_dir}/t")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    a.publish(df, "k", [1], "x")
    old = b.head()
    a.publish(df, "k", [1], "y")
    monkeypatch.setattr(b, "head", lambda: old)
    with pytest.raises(RuntimeError, match="another writer"):
        b.publish(df, "k", [1], "z")


def ts(day):
    return F.lit(f"2001-01-{day:02d}").cast("timestamp")


def test_revisions_close_and_open_intervals(spark):
    def batch(*r):
        return spark.createDataFrame(list(r), "k int, value double, note string, out boolean")

    args = (["k"], ["value", "note"])
    h = revise(None, batch((1, 1.0, "a", False), (2, 2.0, "a", None), (3, 3.0, "a", True)), *args, ts(1), retracted="out")
    assert rows(h, "k", "value", "is_revised") == [(1, 1.0, False), (2, 2.0, False)]
    h = revise(h, batch((1, 1.5, "a", False), (2, 2.0, "b", False), (4, None, "n", False)), *args, ts(2), retracted="out")
    h = revise(h, batch((1, 1.5, "a", False), (2, 2.0, "b", True)), *args, ts(3), retracted="out")
    h = revise(h, batch((2, 9.0, "c", False), (4, None, "n", False)), *args, ts(4), retracted="out")
    assert rows(as_of(h, ts(1)), "k", "value", "note", "is_revised") == [(1, 1.0, "a", False), (2, 2.0, "a", False)]
    assert rows(as_of(h, ts(2)).fillna(-1.0), "k", "value", "note", "is_revised") == [(1, 1.5, "a", True), (2, 2.0, "b", False), (4, -1.0, "n", False)]
    assert rows(as_of(h, ts(3)), "k") == [(1,), (4,)]
    assert rows(as_of(h, ts(9)).fillna(-1.0), "k", "value", "is_revised") == [(1, 1.5, True), (2, 9.0, True), (4, -1.0, False)]
    again = revise(h, batch((2, 9.0, "c", False)), *args, ts(5), retracted="out")
    assert rows(again.fillna(-1.0), *h.columns[:3], "is_revised") == rows(h.fillna(-1.0), *h.columns[:3], "is_revised")


SERIES = ("N00", "N02", "N04", "N06", "N08", "N10", "N12", "N14")


def observation(spark, items, run):
    return spark.createDataFrame([(i, c, p, v, "u", si.SOURCE_NAME, run, "1970") for c, i, p, v in items],
                                 "indicator_code string, country_code_2 string, period string, value double, unit string, source string, "
                                 "pipeline_run_id string, loaded_at string")


def dims(spark):
    country = spark.createDataFrame([(n, c) for n, c in enumerate(SERIES)], "country_key int, country_code string")
    return {"country": country, "indicator": si.indicator_keys(), "source": si.source_keys()}


def test_a_run_costs_what_it_touches_and_equals_the_full_transform(spark, tmp_dir):
    w, d = Warehouse(spark, f"{tmp_dir}/w", buckets=32), dims(spark)
    history = [(c, i, str(y), float(y % 7 + 1)) for c in SERIES for i in si.INDICATOR_CODES for y in range(1990, 2000)]
    first = w.run(observation(spark, history, "r1"), "run_1", d, ts(1))
    assert (first.raw_rows, first.read_rows, first.written_rows) == (320, 0, 320)
    second = w.run(observation(spark, [("N02", "ORD.AVG", "2000", 5.0), ("??", "ORD.AVG", "2000", 5.0)], "r2"), "run_2", d, ts(2))
    # late: the year before the first, and a revision in the middle, whose next year is scored again
    late = [("N00", "ORD.TOTAL", "1989", 2.0), ("N00", "ORD.TOTAL", "1995", 100.0), ("N00", "ORD.TOTAL", "bad", 1.0)]
    third = w.run(observation(spark, late, "r3"), "run_3", d, ts(3))
    assert max(second.buckets, third.buckets) <= 2 and max(second.read_rows, third.read_rows) <= 60
    assert third.written_rows == third.read_rows + 2 and third.rescored == 5  # 1989, 1990, 1995, 1996, the bad one
    assert third.quarantined == {"change not scored": 1, "unparsable period": 1, "anomalous change": 1}
    pipeline.judged(raw_zone.read_all_runs(spark, f"{tmp_dir}/w/raw")).write.parquet(f"{tmp_dir}/whole")
    whole = spark.read.parquet(f"{tmp_dir}/whole")
    key = ["country_code", "indicator_code", "period", "value", "yoy_change", "reason"]
    state = w.observations().withColumn("country_code", F.coalesce("country_iso3", "country_code_2"))
    assert rows(state.fillna(-1.0).fillna("-"), *key) == rows(whole.fillna(-1.0).fillna("-"), *key)
    good = whole.filter("reason is null")
    facts = as_of(w.fact_history(), ts(9))
    assert rows(facts, "date_key", "value", "yoy_change") == rows(good, "date_key", "value", "yoy_change")
    # 1996 has a new change but not a new value; 1995 went with its anomalous value
    assert facts.filter("is_revised").count() == 0
    assert rows(as_of(w.fact_history(), ts(2)).filter("date_key = 19951231 and country_key = 0 and indicator_key = 1"), "value") == [(1.0,)]
    again = w.run(observation(spark, late, "r3"), "run_3", d, ts(4))
    assert rows(as_of(w.fact_history(), ts(9)), "date_key", "value", "valid_from") == rows(facts, "date_key", "value", "valid_from")
    assert again.quarantined == third.quarantined and w.vacuum(1) > 0
    assert w.observations().count() == whole.count()


def test_empty_and_failing_runs_are_recorded_and_change_nothing(spark, tmp_dir):
    w, d = Warehouse(spark, f"{tmp_dir}/w", buckets=4), dims(spark)
    w.run(observation(spark, [("N00", "ORD.AVG", str(y), 3.0) for y in (1990, 1991)], "r"), "run_1", d, ts(1))
    with pytest.raises(ValueError):
        w.run(observation(spark, [], "r"), "run_2", d, ts(2))
    with pytest.raises(Exception):
        w.run(observation(spark, [("N00", "ORD.AVG", "1992", 4.0)], "r"), "run_3", {}, ts(3))
    assert rows(spark.read.parquet(f"{tmp_dir}/w/pipeline_metrics"), "run_id", "stage", "status") == [
        ("run_1", "load", "SUCCESS"), ("run_2", "ingest", "FAILED"), ("run_3", "load", "FAILED")]
    assert w.fact_history().count() == 1
    # the failed run is run again: its outcome is in the state already and still goes on
    w.run(observation(spark, [("N00", "ORD.AVG", "1992", 4.0)], "r"), "run_3", d, ts(4))
    assert rows(w.fact_history(), "date_key") == [(19911231,), (19921231,)]
