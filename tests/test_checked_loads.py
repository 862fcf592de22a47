"""Publish gate, page audit, checked ingest, key counts, compaction and keys that continue."""

import json
import os

import pytest
from pyspark.sql import functions as F

from orrery.operators import audit
from orrery.plans.bootstrap import add_dimension_rows
from orrery.sources.payload import payload_pages
from orrery.sources.versions import VersionedTable
from orrery.streaming import marts as live
from orrery.streaming.ingest import ingest_checked


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_a_failed_audit_leaves_the_version_before(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t")
    dim = spark.createDataFrame([("a",), ("b",)], "code string")
    grid = spark.createDataFrame([(1,), (2,)], "k int")
    check = audit.gate(keys=["k"], not_null=["k", "code"], foreign=[("code", "code", dim, "code")], expected=grid)
    schema = "k int, code string"
    t.publish(spark.createDataFrame([(1, "a"), (2, "b")], schema), F.lit(0), [0], "good", gate=check)
    with pytest.raises(audit.AuditFailure) as e:
        t.publish(spark.createDataFrame([(1, "a"), (1, "z"), (3, None)], schema), F.lit(0), [0], "bad", gate=check)
    assert e.value.findings == {"duplicate keys": 1, "null code": 1, "orphans code": 2, "missing keys": 1}
    assert t.head()["label"] == "good" and rows(t.read(), "k") == [(1,), (2,)]
    assert len(os.listdir(f"{tmp_dir}/t/data")) == 1  # what was refused is removed


def test_compaction_bounds_files_and_keeps_rows(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t")
    df = spark.range(400).withColumn("k", F.col("id") % 2)
    t.publish(df.filter("k = 0"), "k", [0], "a")
    many = f"{tmp_dir}/t/data/{t.head()['parts']['table_part=0']}/table_part=0"
    spark.range(1000, 1040).withColumn("k", F.lit(0).cast("long")).repartition(12).write.mode("append").parquet(many)
    t.publish(df.filter("k = 1"), "k", [1], "b")
    before = rows(t.read(), "id", "k")
    assert t.compact("k", files=4) == 1 and rows(t.read(), "id", "k") == before and len(before) == 440
    folder = f"{tmp_dir}/t/data/{t.head()['parts']['table_part=0']}/table_part=0"
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) <= 4
    assert t.compact("k", files=4) == 0


def test_pages_against_what_they_declare(spark):
    docs = [json.dumps([{"page": p, "pages": 4, "total": 9}, [{"value": 1}] * n]) for p, n in ((1, 3), (2, 2), (2, 2), (4, 1))]
    docs += [json.dumps([{"message": "no page"}, None]), "not json", None, "[]"]
    pages = payload_pages(spark.createDataFrame([("A", d) for d in docs] + [("B", json.dumps([{"page": 1, "pages": 1, "total": 2}, [{}, {}]]))],
                                                "indicator_code string, text string")).withColumn("run", F.lit("r"))
    got = {r["indicator_code"]: r for r in audit.page_audit(pages).collect()}
    a, b = got["A"], got["B"]
    assert (a["pages"], a["landed"], a["double"], a["unnumbered"], a["rows"], a["missing_pages"], a["rows_short"]) == (4, 3, 1, 1, 6, [3], 3)
    assert (b["landed"], b["double"], b["missing_pages"], b["rows_short"]) == (1, 0, [], 0)


def test_a_replayed_batch_adds_nothing(spark, tmp_dir):
    land = f"{tmp_dir}/landing/indicator_code=X"
    os.makedirs(land)
    good = {"countryiso3code": "USA", "country": {"id": "US"}, "date": "2020", "value": 1.5}
    faults = [{**good, "date": ""}, {**good, "countryiso3code": None, "country": {"id": ""}}, {**good, "value": "n/a"}]
    for n in range(2):
        with open(f"{land}/{n}.txt", "w") as f:
            f.write(json.dumps([{"page": n + 1, "pages": 2, "total": 8}, [good, *faults]]) + "\nbroken\n")
        ingest_checked(spark, f"{tmp_dir}/landing", f"{tmp_dir}/zone", f"{tmp_dir}/ck", "r1")

    def counts():
        return {t: spark.read.parquet(f"{tmp_dir}/zone/{t}").count() for t in ("raw", "rejected", "quarantine", "pages")}

    assert counts() == {"raw": 2, "rejected": 4, "quarantine": 4, "pages": 2}
    # the last batch as if the driver had failed before it was noted: its commit goes
    commits = f"{tmp_dir}/ck/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    ingest_checked(spark, f"{tmp_dir}/landing", f"{tmp_dir}/zone", f"{tmp_dir}/ck", "r1")
    assert counts() == {"raw": 2, "rejected": 4, "quarantine": 4, "pages": 2}


def test_key_counts_follow_batches(spark, tmp_dir):
    t, counts = VersionedTable(spark, f"{tmp_dir}/c"), live.key_counts("a", "b", buckets=4)
    batches = [[(1, "x"), (1, "x"), (2, None)], [(2, None), (3, "y")], [(1, "z")]]
    every = []
    for n, b in enumerate(batches):
        every += b
        counts.update(t, spark.createDataFrame(b, "a int, b string"), n)
        full = audit.unique_audit(spark.createDataFrame(every, "a int, b string"), ["a", "b"])
        assert rows(live.repeated_keys(t.read()), "a", "b", "n") == rows(full, "a", "b", "n")


def test_dimension_keys_continue_and_stay(spark, tmp_dir):
    path = f"{tmp_dir}/dim"
    def load(*names):
        return add_dimension_rows(spark, path, spark.createDataFrame([(n, n.upper()) for n in names], "name string, label string"), "name", "k", order=["name"])
    assert load("d", "b", "b") == 2 and load("b", "d") == 0 and load("c", "a", "d") == 2
    assert rows(spark.read.parquet(path), "name", "k") == [("a", 3), ("b", 1), ("c", 4), ("d", 2)]
