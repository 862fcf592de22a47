"""Every registered query against its DuckDB oracle on the smallest data set."""

import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
SF = "/root/testdata/sf0.001"


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(float(v) if isinstance(v, decimal.Decimal) else v for v in r))
    return sorted(out, key=lambda r: tuple((v is None, repr(v)) for v in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in sorted(glob.glob(f"{SF}/*.parquet")):
        c.execute(f"CREATE VIEW {os.path.basename(t)[:-8]} AS SELECT * FROM read_parquet('{t}')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in df.columns]
    expected = [tuple(r[i] for i in order) for r in cur.fetchall()]
    assert _norm(rows) == _norm(expected)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["exporter", "importer", "sector_name", "year", "export_bn", "import_bn", "growth_pct"]
    rows = df.collect()
    assert len(rows) == 100 and [r.export_bn for r in rows] == sorted((r.export_bn for r in rows), reverse=True)
