import math
from fractions import Fraction

import numpy as np
import pytest

from orrery.llm.queries import QUERIES
from orrery.llm.whitening import Products, Whitening, eigen, limbs, whole

SF = "/root/testdata/sf0.01"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def plain(rows):
    """Integers, exact deviations, and an eigenvalue solver of another kind."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in kept]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    dev = [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x]
    y = np.array([[float(Fraction(r[j]) - Fraction(s[j], n)) for j in range(d)] for r in x])
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    return kept, dev, y, e[::-1], u[:, ::-1], np.trace(cov)


def held(got, rows, components=8):
    kept, dev, y, e, u, trace = plain(rows)
    k = min(components, y.shape[1])
    assert len(got) == k * len(kept)
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    at = {i: n for n, (i, _) in enumerate(kept)}
    for c in range(1, k + 1):
        assert sorted(r["deviation"] for r in by[c]) == sorted(dev)
        want = y @ u[:, c - 1] / math.sqrt(e[c - 1])
        have, ref = np.array([r["whitened"] for r in by[c]]), np.array([want[at[r["vec_id"]]] for r in by[c]])
        assert min(np.abs(have - ref).max(), np.abs(have + ref).max()) < 1e-7
        assert all(abs(r["explained"] - e[c - 1] / trace) < 1e-9 and r["n"] == len(kept) for r in by[c])
        assert [r["deviation"] for r in by[c]] == [dev[at[r["vec_id"]]] for r in by[c]]
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_query_against_plain(spark):
    df = QUERIES["op11_whitening"](spark, SF)
    assert df.columns == COLUMNS
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    held(df.collect(), rows)


def test_odd_rows_clashing_names_and_one_hot_vector(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(0, [1, 5, 0.1, 40, 2], 5) + 900).tolist() if i % 3 else [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(90)]
    odd = [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0]), (502, [math.nan] * 5), (503, [math.inf, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows + odd], "vec_id long, embedding array<double>, i int, v string, n int")
    held(Whitening(df.repartition(7)).whitened().collect(), rows + odd)


def test_repeated_rows_null_ids_short_vectors(spark):
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [3.0]), (4, [])]
    got = Whitening(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).whitened().collect()
    assert sorted((r["vec_id"] or -1, r["component"]) for r in got) == [(-1, 1), (-1, 2), (1, 1), (1, 1), (1, 2), (1, 2), (4, 1), (4, 2)]
    assert {r["n"] for r in got} == {4}


def test_no_variance_few_dimensions_and_empty(spark):
    schema = "vec_id long, embedding array<double>"
    same = Whitening(spark.createDataFrame([(i, [2.0, 3.0]) for i in range(5)], schema)).whitened().collect()
    assert {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same} == {(0, None, None, None)}
    line = Whitening(spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(5)], schema)).whitened().collect()
    assert {(r["component"], r["whitened"] is None, round(r["explained"], 9)) for r in line} == {(1, False, 1.0), (2, True, 0.0), (3, True, 0.0)}
    for rows in ([], [(1, None)], [(1, [])]):
        df = Whitening(spark.createDataFrame(rows, schema)).whitened()
        assert df.columns == COLUMNS and df.count() == 0


def test_huge_entries_stay_exact_or_are_null(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e15, 1.0]), (3, [0.0, 2.0])]
    got = Whitening(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).whitened().collect()
    assert len(got) == 6 and {r["deviation"] for r in got} == {None}
    z = np.array([[1 << 60, -(1 << 60) + 1], [3, -5]], np.int64)
    p = Products(2)
    p.add(z)
    assert p.flush().tolist() == [[sum(int(r[i]) * int(r[j]) for r in z) for j in range(2)] for i in range(2)]
    for v in (0, -1, 1 << 130, -(1 << 130) + 12345):
        assert whole({f"l{k}": x[0] for k, x in enumerate(limbs([v]))}) == v


@pytest.mark.parametrize("spread", [0, 4, 8])
def test_eigen_against_another_solver(spread):
    rng = np.random.default_rng(spread)
    a = rng.normal(size=(300, 13)) * 10.0 ** rng.uniform(-spread, spread, 13)
    v = a.T @ a / 300
    e, u = eigen(v)
    want = np.linalg.eigvalsh(v)[::-1]
    assert np.allclose(e[:8], want[:8], rtol=1e-9, atol=1e-14 * want[0])  # the other solver's error is of that size
    assert np.allclose(u.T @ u, np.eye(len(e)), atol=1e-12)
    assert np.allclose(v @ u, u * e, atol=1e-13 * want[0])
