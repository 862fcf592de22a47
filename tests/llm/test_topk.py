import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm.queries import ORACLE_SQL, QUERIES
from orrery.llm.topk import top_inner_products

SF = "/root/testdata/sf0.01"


def brute(rows, k, step=20):
    ok = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in sorted({x for x in ok if x[0] % step == 0}):
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return out


def result(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = sorted(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({ORACLE_SQL['op9_topk']})").fetchall())
    assert result(QUERIES["op9_topk"](spark, SF)) == want


@pytest.mark.parametrize("spread", [0.0, 30.0])
def test_against_brute_force_with_hot_vectors(spark, spread):
    rng = np.random.default_rng(5)
    centre = rng.normal(0, spread + 1e-9, (6, 8))
    rows = [(i, (rng.normal(0, 1, 8) + centre[i % 6]).tolist() if i % 3 else [1.0] * 8) for i in range(240)]
    rows += [(None, [1.0] * 8), (5000, None), (5020, [1.0, None]), (5040, [math.nan] * 8), (5060, [math.inf] * 8), (20, rows[20][1]), (7000, []), (7020, [2.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, cell int")
    got = result(top_inner_products(df, F.col("vec_id") % 20 == 0, 7, pivots=5, block_rows=16, query_rows=4))
    assert got == brute(rows, 7)


def test_fewer_candidates_large_numbers_and_empty_tables(spark):
    rows = [(0, [1e7, 0.25]), (1, [1e7, 0.25]), (2, [1e7, 0.5]), (3, [1e15, 0.0]), (4, [1e15, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = result(top_inner_products(df, F.col("vec_id") % 20 == 0, 20))
    assert [(r[2], r[3]) for r in got] == [(3, (1 << 63) - 1), (4, (1 << 63) - 1), (2, (64 * 10**7)**2 + 16 * 32), (1, (64 * 10**7)**2 + 16 * 16)]
    assert top_inner_products(df.limit(0), F.lit(True), 20).count() == 0
    assert top_inner_products(df, F.lit(False), 20).count() == 0
    assert top_inner_products(df.filter("vec_id = 0"), F.lit(True), 20).count() == 0
