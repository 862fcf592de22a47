"""Bucketed layout: the trade fact over a lineitem bucketed on the order key."""

import os

from pyspark.sql import functions as F

from orrery.plans import marts
from orrery.plans import standins as si
from orrery.sources.layout import bucket_count, write_bucketed
from orrery.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def test_bucket_count():
    assert bucket_count(0) == 8
    assert bucket_count(100 << 40) == 262144


def test_bucketed_lineitem_joins_without_shuffling_it(spark, tmp_dir):
    t = Tables(spark, SF)
    li = write_bucketed(t.lineitem, "lineitem_by_order", os.path.join(tmp_dir, "lineitem_b"), ["l_orderkey"], 8)
    prev = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # sort-merge joins, as at scale
    try:
        fact = si.trade_fact(t, 1997, lineitem=li)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        assert "Exchange hashpartitioning(l_orderkey" not in plan  # lineitem is read in bucket order
        assert "Exchange hashpartitioning(o_orderkey#" in plan and ", 8)" in plan  # only orders is shuffled
        a = marts.trade_flows(fact, si.dim_date(t), si.dim_country(t), si.dim_sector(t), 1998, 100)
        b = marts.trade_flows(si.trade_fact(t, 1997), si.dim_date(t), si.dim_country(t), si.dim_sector(t), 1998, 100)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev[1])
