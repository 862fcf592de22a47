"""Live marts and streaming changes beyond what the registered queries check."""

import pytest
from pyspark.sql import functions as F

from orrery.operators.change import calendar_change, pct_change_prev
from orrery.sources.versions import VersionedTable
from orrery.streaming import marts as live
from orrery.streaming.changes import keep_changes


def trade(spark, *rows):
    return spark.createDataFrame([(d, e, i, s, float(x), y, r) for d, e, i, s, x, y, r in rows],
                                 "date_key int, exporter_key int, importer_key int, sector_key int, x double, yoy_growth double, retract boolean").select(
        "*", F.col("x").cast("decimal(20,2)").alias("export_value_usd"), F.col("x").cast("decimal(20,4)").alias("import_value_usd"))


def state(table):
    return sorted((r["exporter_key"], r["year"], float(r["exports"]), r["growth_n"]) for r in table.read().collect())


def test_sums_merge_retract_and_ignore_replays(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/trade")
    assert live.TRADE.update(t, trade(spark, (19980131, 1, 2, 3, 10, 5.0, False), (19980228, 1, 2, 3, 20, None, False), (19990131, 2, 1, 3, 7, 1.0, None)), 0)
    assert state(t) == [(1, 1998, 30.0, 1), (2, 1999, 7.0, 1)]
    # a group comes, one loses a row, one goes with its last row; 1998 is not read or written
    before = t.head()["parts"]
    assert live.TRADE.update(t, trade(spark, (19990131, 2, 1, 3, 7, 1.0, True), (19990131, 5, 1, 3, 9, None, False)), 1)
    assert state(t) == [(1, 1998, 30.0, 1), (5, 1999, 9.0, 0)]
    after = t.head()["parts"]
    assert before["table_part=1998"] == after["table_part=1998"] and before["table_part=1999"] != after["table_part=1999"]
    assert not live.TRADE.update(t, trade(spark, (19990131, 5, 1, 3, 9, None, False)), 1)
    # taken back before it came: the group waits below zero and ends with what is left
    live.TRADE.update(t, trade(spark, (20000131, 8, 1, 3, 4, None, True)), 2)
    live.TRADE.update(t, trade(spark, (20000131, 8, 1, 3, 4, None, False), (20000229, 8, 1, 3, 6, None, False)), 3)
    assert state(t)[-1] == (8, 2000, 6.0, 0)
    assert live.TRADE.update(t, trade(spark), 4) and state(t)[-1] == (8, 2000, 6.0, 0)


def test_the_top_k_follows_the_state(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/trade")
    names = spark.createDataFrame([(k, f"C{k}") for k in range(9)], "country_key int, country_name string")
    sector = spark.createDataFrame([(3, "S")], "sector_key int, sector_name string")

    def top():
        return [r["exporter"] for r in live.trade_flows(t.read(), names, sector, 1990, 2).collect()]

    live.TRADE.update(t, trade(spark, (19980131, 1, 0, 3, 10, None, False), (19980131, 2, 0, 3, 20, None, False), (19980131, 4, 0, 3, 5, None, False)), 0)
    assert top() == ["C2", "C1"]
    live.TRADE.update(t, trade(spark, (19980131, 2, 0, 3, 18, None, True), (19980131, 4, 0, 3, 6, None, False)), 1)
    assert top() == ["C4", "C1"]


def test_latest_rows_are_overtaken_and_not_taken_back(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/kpi")
    schema = "date_key int, country_key int, indicator_key int, value double, yoy_change double"
    for n, rows in enumerate([[(19991231, 1, 1, 5.0, None)], [(19981231, 1, 1, 9.0, 1.0), (19981231, 2, 1, None, None)], [(20001231, 1, 1, 6.0, 20.0)]]):
        live.KPI.update(t, spark.createDataFrame(rows, schema), n)
    assert sorted((r["country_key"], r["row"]["value"]) for r in t.read().collect() if r["country_key"] == 1) == [(1, 6.0)]
    assert t.read().count() == 2 and len(t._numbers()) == 2
    with pytest.raises(Exception, match="taken back"):
        live.KPI.update(t, spark.createDataFrame([(19981231, 2, 1, 1.0, None)], schema).withColumn("retract", F.lit(True)), 3)


def test_shuffled_late_revised_and_keyless_observations(spark, tmp_dir):
    rows = [(f"c{k}", i, float((i * 7 + k) % 11 - 5), 1) for k in range(4) for i in range(24) if (i + k) % 5]
    fixed = [(c, i, v + 1, 2) for c, i, v, _ in rows if i % 4 == 1]
    every = rows + fixed
    schema = "country string, idx int, value double, version int"
    order = sorted(range(len(every)), key=lambda n: n * 37 % len(every))
    for b in range(3):
        part = [every[n] for n in order[b::3]] + [(None, b, 1.0, 1), ("c1", None, 1.0, 1)]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        keep_changes(spark, f"{tmp_dir}/in", f"{tmp_dir}/state", f"{tmp_dir}/checkpoint", ["country"], "idx", "value", ["version"], {"step4": 4}, buckets=3)
    latest = {}
    for c, i, v, n in every:
        latest[c, i] = max(latest.get((c, i), (0, 0.0)), (n, v))
    df = spark.createDataFrame([(c, i, v) for (c, i), (_, v) in latest.items()], "country string, idx int, value double")
    want = calendar_change(pct_change_prev(df, ["country"], ["idx"], "value", "change_prev", keep_prev=False), ["country"], "idx", "value", 4, "step4")
    cols = ["country", "idx", "value", "change_prev", "step4"]
    got = VersionedTable(spark, f"{tmp_dir}/state").read()
    assert sorted(map(repr, got.select(cols).collect())) == sorted(map(repr, want.select(cols).collect()))
    assert spark.read.parquet(f"{tmp_dir}/state-rejected").count() == 6
