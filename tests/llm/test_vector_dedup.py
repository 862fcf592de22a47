import math

import duckdb
import numpy as np
import pytest

from orrery.llm.queries import ORACLE_SQL, QUERIES
from orrery.llm.vector_dedup import VectorDuplicates, components_of

SF = "/root/testdata/sf0.01"
COLUMNS = ["vec_id", "n_links", "component_id", "kept"]


def plain(rows, cosine=0.9):
    """All pairs, then a search from every row."""
    d = max((len(v) for _, v in rows if v is not None), default=0)
    ok = [v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v) for _, v in rows]
    x = np.array([list(v) + [0.0] * (d - len(v)) if k else [0.0] * d for (_, v), k in zip(rows, ok)])
    norm = np.sqrt((x * x).sum(1))
    u = x / np.where(norm > 0, norm, 1)[:, None]
    link = (u @ u.T >= cosine) & np.array(ok)[:, None] & np.array(ok)
    np.fill_diagonal(link, False)
    out, done = [None] * len(rows), set()
    for s in range(len(rows)):
        if s in done:
            continue
        group, todo = {s}, [s]
        while todo:
            more = set(np.flatnonzero(link[todo].any(0)).tolist()) - group
            group |= more
            todo = list(more)
        done |= group
        least = min((rows[m][0] for m in group if rows[m][0] is not None), default=None)
        for m in group:
            out[m] = (rows[m][0], int(link[m].sum()), least, rows[m][0] == least)
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, 7, 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, home int, mult int")


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    df = QUERIES["op12_vector_dedup"](spark, SF)
    names = [r[0] for r in con.execute(f"DESCRIBE ({ORACLE_SQL['op12_vector_dedup']})").fetchall()]
    assert df.columns == COLUMNS == names
    assert result(df) == sorted(con.execute(ORACLE_SQL["op12_vector_dedup"]).fetchall(), key=repr)


def hot(rng, d=24, n=700):
    """A third close copies of one vector, loose groups about the threshold, chains, exact copies, noise."""
    base, rows = rng.normal(size=(12, d)), []
    for i in range(n):
        if i % 3 == 0:
            v = base[0] + rng.normal(0, 0.05, d)
        elif i % 3 == 1:
            v = base[1 + i % 11] + rng.normal(0, 0.33, d)
        elif i % 9 == 2:
            v = base[3] * (1 - i / n) + base[4] * (i / n)
        elif i % 9 == 5:
            v = base[5] * 2.0
        else:
            v = rng.normal(size=d)
        rows.append((i * 7 % 1009, v.tolist()))
    return rows


@pytest.mark.parametrize("block_rows,cell_rows", [(4096, 40), (37, 90), (16, 2000)])
def test_full_reach_against_all_pairs(spark, block_rows, cell_rows):
    rows = hot(np.random.default_rng(1))
    df = table(spark, rows)
    got = result(VectorDuplicates(df.repartition(5), reach=math.inf, block_rows=block_rows, cell_rows=cell_rows).documents())
    assert got == plain(rows)


def test_odd_rows(spark):
    rows = [(5, [1.0, 0.0]), (3, [2.0, 0.0]), (5, [1.0, 0.0]), (None, [1.0, 0.1]), (None, [0.0, 5.0]), (9, [0.0, 1e-300]), (8, [0.0, 1e300]),
            (20, None), (21, [0.0, 0.0]), (22, [1.0, None]), (23, [math.nan, 1.0]), (24, [math.inf, 1.0]), (25, []), (26, [-1.0]), (None, None), (21, [0.0, -0.0])]
    got = result(VectorDuplicates(table(spark, rows)).documents())
    assert got == sorted([(5, 3, 3, False), (3, 3, 3, True), (5, 3, 3, False), (None, 3, 3, False), (None, 2, 8, False), (9, 2, 8, False), (8, 2, 8, True),
                          (20, 0, 20, True), (21, 0, 21, True), (22, 0, 22, True), (23, 0, 23, True), (24, 0, 24, True), (25, 0, 25, True), (26, 0, 26, True),
                          (None, 0, None, True), (21, 0, 21, True)], key=repr)
    assert result(VectorDuplicates(table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-0.5, 1.0])], "float")).documents()) == [
        (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_pairs_at_the_threshold(spark):
    """(3, 4) and its like have integer norms: cosines of exactly 24/25, 0.6, 0.8."""
    rows = [(1, [3.0, 4.0]), (2, [4.0, 3.0]), (3, [5.0, 0.0])]
    assert result(VectorDuplicates(table(spark, rows), cosine=0.96).documents()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert result(VectorDuplicates(table(spark, rows), cosine=0.8).documents()) == [(1, 1, 1, True), (2, 2, 1, False), (3, 1, 1, False)]
    assert result(VectorDuplicates(table(spark, rows), cosine=0.961).documents()) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


def test_empty_and_all_unusable(spark):
    for rows in ([], [(1, None)], [(1, [0.0])]):
        df = VectorDuplicates(table(spark, rows)).documents()
        assert df.columns == COLUMNS and df.count() == len(rows)


def test_recall_at_the_threshold(spark):
    """Noise in 64 dimensions, partners in random directions at a cosine of just over 0.9: the hardest links."""
    rng = np.random.default_rng(9)
    v = rng.normal(size=(6000, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    w = rng.normal(size=v.shape)
    w -= (w * v).sum(1)[:, None] * v
    w /= np.linalg.norm(w, axis=1)[:, None]
    partner = 0.9001 * v + math.sqrt(1 - 0.9001 ** 2) * w
    rows = [(int(i), x.tolist()) for i, x in enumerate(np.concatenate([v, partner]))]
    got = VectorDuplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), cell_rows=128).documents()
    linked = got.filter("n_links > 0").count()
    assert linked > 0.997 * 12000
    assert got.filter("n_links > 1").count() == 0


def test_components_of_a_table():
    rng = np.random.default_rng(2)
    link = rng.random((40, 50)) < 0.02
    left, right = components_of(link)
    for i, j in zip(*np.nonzero(link)):
        assert left[i] == right[j] >= 0
    assert ((left < 0) == ~link.any(1)).all() and ((right < 0) == ~link.any(0)).all()
