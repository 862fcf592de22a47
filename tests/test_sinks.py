"""Sinks and the size-checked broadcast."""

import json
import os

from pyspark.sql import functions as F

from orrery.sources.sinks import append_metrics, counted_write, json_rows, write_csv, write_json


def test_json_rows_keep_nulls(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert json.loads(json_rows(df).first().json) == {"k": "a", "v": None}


def test_file_sinks_and_counts(spark, tmp_dir):
    df = spark.range(5).withColumn("v", F.when(F.col("id") > 2, F.col("id") * 1.5))
    assert counted_write(df, os.path.join(tmp_dir, "p")) == 5
    write_csv(df, os.path.join(tmp_dir, "csv"))
    back = spark.read.option("header", True).csv(os.path.join(tmp_dir, "csv"))
    assert back.columns == ["id", "v"] and back.count() == 5
    write_json(df, os.path.join(tmp_dir, "json"))
    lines = [json.loads(r.value) for r in spark.read.text(os.path.join(tmp_dir, "json")).collect()]
    assert all("v" in x for x in lines)
    append_metrics(spark, os.path.join(tmp_dir, "m"), "r1", "load", 5, "SUCCESS")
    append_metrics(spark, os.path.join(tmp_dir, "m"), "r2", "load", 0, "FAILED")
    m = spark.read.parquet(os.path.join(tmp_dir, "m"))
    assert sorted((r.run_id, r.record_count, r.status) for r in m.collect()) == [("r1", 5, "SUCCESS"),
                                                                                 ("r2", 0, "FAILED")]


def test_json_numbers_have_one_form(spark):
    df = spark.createDataFrame([(1e-7, 12345678901.5, None, 3)], "a double, b double, c double, d int")
    assert [r.json for r in json_rows(df).collect()] == ['{"a":0.000000,"b":12345678901.500000,"c":null,"d":3}']


def test_cluster_conf_sizes_partitions():
    from orrery.session import cluster_conf
    c = cluster_conf(100 << 40, executors=1000, cores_per_executor=8)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600  # 100 TB / 256 MB
    small = cluster_conf(1 << 30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80  # two waves of 40 cores
    assert small["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_new_files_are_seen(spark, tmp_dir):
    from orrery.sources.tables import Tables
    d = os.path.join(tmp_dir, "sf")
    spark.range(3).write.parquet(os.path.join(d, "events.parquet", "p=1"))
    assert Tables(spark, d).events.count() == 3
    spark.range(2).write.parquet(os.path.join(d, "events.parquet", "p=2"))
    assert Tables(spark, d).events.count() == 5


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    from orrery import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    import pytest
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
