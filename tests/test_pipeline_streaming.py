"""End-to-end batch run over landed payloads, and the streaming jobs."""

import json
import os

from pyspark.sql import functions as F

from orrery.plans import standins as si
from orrery.plans.pipeline import run_pipeline
from orrery.sources.payload import flatten_payload, read_landed
from orrery.sources.tables import Tables
from orrery.streaming.ingest import incremental_load
from orrery.sources import raw_zone


def _land(tmp, name, rows):
    with open(os.path.join(tmp, name), "w") as f:
        f.write(json.dumps([{"page": 1}, rows]))


def test_run_pipeline_twice(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    rows = [{"countryiso3code": "", "country": {"id": "US"}, "date": str(y), "value": float(v), "unit": "USD"}
            for y, v in zip(range(2016, 2021), [10, 11, 12, 100, 13])]
    _land(land, "GDP.json", rows)
    docs = read_landed(spark, land).withColumn("indicator_code", F.lit("NY.GDP.MKTP.CD"))
    raw = flatten_payload(docs, run_id="r1")
    dims = {
        "country": spark.createDataFrame([(1, "USA")], "country_key int, country_code string"),
        "indicator": spark.createDataFrame([(1, "NY.GDP.MKTP.CD")], "indicator_key int, indicator_code string"),
        "source": spark.createDataFrame([(1, "World Bank")], "source_key int, source_name string"),
    }
    wh = os.path.join(tmp_dir, "wh")
    first = run_pipeline(spark, raw, wh, "r1", dims)
    # 5 observations: the first is unscored and 2019 (+733%) is an anomaly; both are gated out
    assert first.raw_rows == 5 and first.status == "SUCCESS"
    assert first.transformed_rows == 3 and first.loaded_rows == 3
    second = run_pipeline(spark, flatten_payload(docs, run_id="r2"), wh, "r2", dims)
    assert second.loaded_rows == 0
    assert spark.read.parquet(f"{wh}/fact_economic_indicators").count() == 3
    m = spark.read.parquet(f"{wh}/pipeline_metrics").collect()
    assert sorted(r.record_count for r in m) == [0, 3]
    assert first.quarantined == {"change not scored": 1, "anomalous change": 1}
    assert spark.read.parquet(f"{wh}/quarantine").count() == 4  # two of each run
    from orrery.schemas import FACT_ECONOMIC_INDICATORS
    fact = spark.read.parquet(f"{wh}/fact_economic_indicators")
    assert [(f.name, f.dataType) for f in fact.schema.fields][:13] == [(f.name, f.dataType) for f in FACT_ECONOMIC_INDICATORS.fields]


def test_every_raw_row_ends_somewhere(spark, tmp_dir):
    schema = "indicator_code string, country_code_2 string, period string, value double, unit string, source string, pipeline_run_id string, loaded_at string"
    row = lambda p, v, c="USA", i="X": (i, c, p, v, "", "World Bank", "r", "t")
    rows = [row("2021", 100.0), row("2022", 110.0), row("2023", 120.0), row("2023Q4", 33.0), row("2023Q3", 30.0), row("2023-Q1", 50.0),
            row("2024", None), row("2023", 120.0, "ZZ"), row("2022", 1.0, i="Y"), row("2023", 1.1, i="Y"), row("bad", 1.0)]
    dims = {"country": spark.createDataFrame([(1, "USA"), (9, "USA")], "country_key int, country_code string"),
            "indicator": {"X": 1}, "source": {"World Bank": 1}}
    report = run_pipeline(spark, spark.createDataFrame(rows, schema), os.path.join(tmp_dir, "wh"), "r", dims)
    # in one series an unparsable period is nobody's previous value, and annual and fourth-quarter values both load
    assert report.quarantined == {"unparsable period": 2, "value is null": 1, "unknown country": 1, "change not scored": 2,
                                  "unknown key: indicator_code": 1}
    fact = spark.read.parquet(os.path.join(tmp_dir, "wh", "fact_economic_indicators"))
    got = sorted((r.date_key, r.frequency, r.country_key, float(r.value)) for r in fact.collect())
    assert got == [(20221231, "A", 1, 110.0), (20230930, "Q", 1, 30.0), (20231231, "A", 1, 120.0), (20231231, "Q", 1, 33.0)]
    assert report.raw_rows == report.loaded_rows + sum(report.quarantined.values())


def test_incremental_load_skips_done_files(spark, tmp_dir):
    t = Tables(spark, "/root/testdata/sf0.001")
    obs = si.raw_observations(t, "year").select("indicator_code", "country_code_2", "period", "value")
    raw = os.path.join(tmp_dir, "raw")
    raw_zone.write_run(obs.coalesce(1), raw, "a")
    keys = ["indicator_code", "country_code_2", "period"]
    ck, fact = os.path.join(tmp_dir, "ck"), os.path.join(tmp_dir, "fact")
    incremental_load(spark, raw, fact, ck, keys)
    n = spark.read.parquet(fact).count()
    assert n == obs.count()
    incremental_load(spark, raw, fact, ck, keys)  # same checkpoint: nothing new
    assert spark.read.parquet(fact).count() == n
    raw_zone.write_run(obs.coalesce(1), raw, "b")  # a rerun of the same data: no new keys
    incremental_load(spark, raw, fact, ck, keys)
    assert spark.read.parquet(fact).count() == n


def test_ingest_landing_on_arrival(spark, tmp_dir):
    from orrery.streaming.ingest import ingest_landing
    land, raw, ck = (os.path.join(tmp_dir, x) for x in ("landing", "raw", "ck"))
    os.makedirs(land)
    row = {"countryiso3code": "USA", "country": {"id": "US"}, "date": "2020", "value": 1.0}
    _land(land, "GDP.json", [row, dict(row, date="2021", value=None)])
    ingest_landing(spark, land, raw, ck, "r1")
    first = spark.read.parquet(raw)
    assert [(r.indicator_code, r.period, r.run) for r in first.collect()] == [("GDP", "2020", "r1")]
    _land(land, "CPI.json", [dict(row, value=2.0)])
    ingest_landing(spark, land, raw, ck, "r1")  # only the new file is read
    got = sorted((r.indicator_code, r.value) for r in spark.read.parquet(raw).collect())
    assert got == [("CPI", 2.0), ("GDP", 1.0)]


def test_failed_runs_are_recorded_and_raised(spark, tmp_dir):
    import pytest
    from orrery.schemas import RAW_OBSERVATION
    wh = os.path.join(tmp_dir, "wh-b")
    raw = spark.createDataFrame([("X", "USA", "2020", 1.0, "", "S", "r", "t")], RAW_OBSERVATION)
    with pytest.raises(KeyError):
        run_pipeline(spark, raw, wh, "r1", {})  # no dimensions
    assert [(r.stage, r.status) for r in spark.read.parquet(f"{wh}/pipeline_metrics").collect()] == [("load", "FAILED")]


def test_empty_ingest_stops_before_writing(spark, tmp_dir):
    import pytest
    from orrery.schemas import RAW_OBSERVATION
    wh = os.path.join(tmp_dir, "wh")
    with pytest.raises(ValueError, match="no rows"):
        run_pipeline(spark, spark.createDataFrame([], RAW_OBSERVATION), wh, "r0", {})
    assert not os.path.exists(os.path.join(wh, "raw"))
    assert [(r.stage, r.status) for r in spark.read.parquet(f"{wh}/pipeline_metrics").collect()] == [
        ("ingest", "FAILED")]


def test_incremental_load_first_run_wins_within_one_batch(spark, tmp_dir):
    raw, ck, fact = (os.path.join(tmp_dir, x) for x in ("raw", "ck", "fact"))
    schema = "indicator_code string, country_code_2 string, period string, value double"
    raw_zone.write_run(spark.createDataFrame([("X", "USA", "2020", 1.0)], schema), raw, "run_a")
    raw_zone.write_run(spark.createDataFrame([("X", "USA", "2020", 2.0), ("X", "USA", "2021", 3.0)], schema),
                       raw, "run_b")
    incremental_load(spark, raw, fact, ck, ["indicator_code", "country_code_2", "period"])  # one micro-batch
    got = sorted((r.period, r.value) for r in spark.read.parquet(fact).collect())
    assert got == [("2020", 1.0), ("2021", 3.0)]


def test_live_kpi_processing_time_trigger(spark, tmp_dir):
    from orrery.streaming.live import live_latest
    target, ck = os.path.join(tmp_dir, "kpi"), os.path.join(tmp_dir, "ck")
    q = live_latest(spark, "/root/testdata/sf0.001/events.parquet", target, ck, available_now=False,
                    refresh="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    from orrery.streaming.live import live_kpis
    got = {r.event_type: r.events for r in live_kpis(spark, target).collect()}
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert got == {r.event_type: r["count"] for r in e.groupBy("event_type").count().collect()}


def test_live_kpi_over_several_batches(spark, tmp_dir):
    from orrery.streaming.live import live_kpis, live_latest
    src, target, ck = (os.path.join(tmp_dir, x) for x in ("src", "kpi", "ck"))
    import datetime as dt
    at = lambda h: dt.datetime(2020, 1, 1, h)
    schema = "event_id long, event_type string, ts timestamp_ntz, value double"
    seen = []
    for rows in ([(1, "a", at(1), 10.0), (2, "a", at(3), 20.0)], [(3, "a", at(2), 40.0), (4, "b", at(1), 1.0)], [(5, "a", at(4), 30.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        live_latest(spark, src, target, ck)
        seen.append(sorted(tuple(r) for r in live_kpis(spark, target).select("event_type", "latest_value", "change", "events").collect()))
    assert seen == [[("a", 20.0, 100.0, 2)], [("a", 20.0, -50.0, 3), ("b", 1.0, None, 1)], [("a", 30.0, 50.0, 4), ("b", 1.0, None, 1)]]


def test_dedupe_keeps_late_first_deliveries(spark, tmp_dir):
    from orrery.streaming.dedupe import dedupe_events
    land, out, ck = (os.path.join(tmp_dir, x) for x in ("land", "out", "ck"))
    import datetime as dt
    at = lambda h: dt.datetime(2020, 1, 1) + dt.timedelta(hours=h)
    schema = "event_id long, ts timestamp_ntz, value double"
    for rows in ([(1, at(0), 1.0), (2, at(48), 2.0)], [(3, at(10), 3.0), (1, at(0), 1.0), (4, at(49), 4.0), (3, at(10), 3.0)], [(2, at(48), 2.0), (None, at(1), 9.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        dedupe_events(spark, land, out, ck)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4]
    assert [r.value for r in spark.read.parquet(out + "-rejected").collect()] == [9.0]
