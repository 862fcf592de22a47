"""Plan-shape regression tests: the scale properties PLANS.md documents.

Plans are static (AQE off) with automatic broadcasts limited to fixed-size
tables, i.e. as a large cluster plans them.
"""

import re

import pytest

from orrery.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def scale_plan(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                            "spark.sql.maxMetadataStringLength")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")

    def plan(name):
        return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()

    yield plan
    for k, v in saved.items():
        spark.conf.set(k, v)


def _exchange_keys(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)


def test_transform_reduces_deliveries_before_it_shuffles_them(scale_plan):
    p = scale_plan("transform_chain")
    series = [re.sub(r"#\d+L?", "", k) for k in _exchange_keys(p) if "country_iso3" in k]
    # the latest delivery per observation, then the series of the window: both after a partial aggregate
    assert sorted(series) == ["country_iso3, indicator_code, __out", "country_iso3, indicator_code, period"]
    lines = p.split("\n")
    reduce_at = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(country_iso3" in x and "period" in x)
    assert "partial_max_by" in lines[reduce_at + 1] + lines[reduce_at + 2] and "REPARTITION_BY_COL" not in p


def test_indicator_marts_read_no_lineitem(scale_plan):
    for name in ("mart_kpi_latest", "mart_trend", "mart_country_map", "completeness_gap"):
        assert "l_shipdate" not in scale_plan(name)


def test_heatmap_shuffles_lineitem_once(scale_plan):
    lineitem = [k for k in _exchange_keys(scale_plan("mart_sector_heatmap")) if k.startswith("l_")]
    assert [re.sub(r"#\d+L?", "", k) for k in lineitem] == ["l_partkey"]


def test_stored_fact_and_target_are_pruned_by_partition(spark, scale_plan, tmp_dir):
    assert re.search(r"PartitionFilters: \[isnotnull\(year#\d+\), \(year#\d+ >= 1996\)\]", scale_plan("mart_trend_stored"))
    from orrery.operators.load import batch_partitions, insert_if_absent
    rows = spark.range(40).selectExpr("id", "cast(1990 + id % 8 as int) year")
    rows.write.partitionBy("year").parquet(tmp_dir + "/t")
    batch = rows.filter("year IN (1992, 1994)")
    target = batch_partitions(spark.read.parquet(tmp_dir + "/t"), batch, ["year"])
    new, _ = insert_if_absent(batch, target, ["id"])
    assert re.search(r"PartitionFilters: \[year#\d+ IN \(1992,1994\)\]", new._jdf.queryExecution().executedPlan().toString())
    assert new.count() == 0


def test_kpi_partial_top1_before_shuffle(scale_plan):
    p = scale_plan("mart_kpi_latest")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_trade_mart_shuffles(scale_plan):
    p = scale_plan("mart_trade_flows")
    keys = _exchange_keys(p)
    lineitem = [k for k in keys if k.startswith("l_")]
    assert sorted(re.sub(r"#\d+L?", "", k) for k in lineitem) == ["l_orderkey", "l_partkey", "l_suppkey"]
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", p)
    assert "TakeOrderedAndProject" in p


def test_fk_audit_one_pass(scale_plan):
    p = scale_plan("fk_audit")
    lineitem = [k for k in _exchange_keys(p) if k.startswith("l_")]
    assert len(lineitem) == 2  # the market fact is built once (part and supplier joins)


def test_hot_key_safety(scale_plan):
    p = scale_plan("latest_version")
    assert "partial_max_by" in p  # combined map-side before the shuffle on the key
    r = scale_plan("revision_flag")
    windows = [l for l in r.split("\n") if "Window [lag(value" in l]
    assert windows and all("__bucket" in l for l in windows)  # the row window runs per (key, bucket)
