"""Idempotent loading: dedupe, NULL keys, anti join, load twice = load once."""

import os

from pyspark.sql import functions as F

from orrery.operators.load import DimRef, insert_if_absent, latest_version, load_if_absent, resolve_keys

SCHEMA = "date_key int, country_key int, indicator_key int, value double, loaded_at string"


def test_insert_if_absent_rules(spark):
    target = spark.createDataFrame([(20201231, 1, 1, 5.0, "a")], SCHEMA)
    batch = spark.createDataFrame([
        (20201231, 1, 1, 9.0, "b"),   # exists: first writer wins
        (20211231, 1, 1, 7.0, "b"),   # new, twice in the batch
        (20211231, 1, 1, 7.5, "c"),
        (None, 1, 1, 1.0, "b"),       # NULL key: rejected, never loaded
    ], SCHEMA)
    keys = ["date_key", "country_key", "indicator_key"]
    new, rejected = insert_if_absent(batch, target, keys, version=["loaded_at"])
    got = [(r.date_key, r.value) for r in new.collect()]
    assert got == [(20211231, 7.5)]
    assert rejected.count() == 1


def test_load_twice_is_load_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "fact")
    batch = spark.createDataFrame([(20201231 + i, i % 3, 1, float(i), "r") for i in range(10)], SCHEMA) \
        .withColumn("year", F.lit(2020))
    keys = ["date_key", "country_key", "indicator_key"]
    assert load_if_absent(batch, path, keys, ["year"]) == 10
    assert load_if_absent(batch, path, keys, ["year"]) == 0
    assert spark.read.parquet(path).count() == 10


def test_latest_version_max_by(spark):
    df = spark.createDataFrame([("k", 1, "x", 1.0), ("k", 2, "y", 2.0), ("j", 1, "z", 3.0)],
                               "key string, ver int, tag string, v double")
    got = {r.key: (r.ver, r.tag) for r in latest_version(df, ["key"], ["ver"]).collect()}
    assert got == {"k": (2, "y"), "j": (1, "z")}


def test_resolve_keys_orphans(spark):
    facts = spark.createDataFrame([("USA", "GDP"), ("XXX", "GDP"), ("USA", "NONE")], "cc string, ic string")
    dim_c = spark.createDataFrame([("USA", 1)], "country_code string, country_key int")
    matched, orphans = resolve_keys(facts, [DimRef(dim_c, "cc", "country_code", "country_key"),
                                            DimRef({"GDP": 7}, "ic", "indicator_code", "indicator_key")])
    assert [(r.country_key, r.indicator_key) for r in matched.collect()] == [(1, 7)]
    assert sorted(r.missing for r in orphans.collect()) == ["cc", "ic"]


def test_staging_truncate_and_reload(spark, tmp_dir):
    from orrery.operators.load import overwrite_staging
    path = os.path.join(tmp_dir, "stg")
    overwrite_staging(spark.range(5), path)
    overwrite_staging(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2
