"""Landed payload flattening (S-01)."""

import json
import os

from pyspark.sql import functions as F

from orrery.sources.payload import flatten_payload, read_landed


def _doc(rows):
    return json.dumps([{"page": 1, "pages": 1, "per_page": 2000, "total": len(rows or [])}, rows])


def test_flatten_rules(spark, tmp_dir):
    rows = [
        {"countryiso3code": "USA", "country": {"id": "US"}, "date": "2023", "value": 1.5, "unit": "%"},
        {"countryiso3code": "", "country": {"id": "CN"}, "date": "2022", "value": 2.0},
        {"countryiso3code": "IND", "country": {"id": "IN"}, "date": "2021", "value": None},
        {"countryiso3code": "DEU", "country": {"id": "DE"}, "date": "2020", "value": 3.0, "unit": None},
    ]
    for i, (ind, doc) in enumerate([("A", _doc(rows)), ("B", _doc([])), ("C", json.dumps([{"message": "x"}]))]):
        with open(os.path.join(tmp_dir, f"{ind}.json"), "w") as f:
            f.write(doc)
    docs = read_landed(spark, tmp_dir).withColumn(
        "indicator_code", F.regexp_extract("path", r"/([A-Z])\.json$", 1))
    out = flatten_payload(docs, run_id="r1", loaded_at=F.lit("t")).orderBy("period").collect()
    assert [(r.indicator_code, r.country_code_2, r.period, r.value, r.unit) for r in out] == [
        ("A", "DEU", "2020", 3.0, None), ("A", "CN", "2022", 2.0, ""), ("A", "USA", "2023", 1.5, "%")]
    assert {r.source for r in out} == {"World Bank"}


def test_bad_payloads_are_kept_apart(spark):
    from orrery.sources.payload import flatten_payload, payload_quarantine
    row = '{"countryiso3code":"USA","country":{"id":"US"},"date":"2020","value":%s}'
    docs = ['[{"page":1},[' + ",".join(row % v for v in ("1.5", '"2.5"', '"n/a"', "null")) + "]]", '[{"page":1},[', "<html>no</html>", '[{"page":1}]',
            '[{"page":1},null]', '[{"page":1},[7]]']
    df = spark.createDataFrame([("X", d) for d in docs], "indicator_code string, text string")
    assert sorted(r.value for r in flatten_payload(df).collect()) == [1.5, 2.5]
    bad = sorted((r.reason, r.text) for r in payload_quarantine(df).collect())
    assert [r for r, _ in bad] == ["document", "document", "row", "value"] and "n/a" in bad[-1][1]
