"""Property tests: the Spark operators against plain-Python brute force on generated inputs."""

import calendar as pycal
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from orrery.functions.period import parse_period
from orrery.operators.change import calendar_change

periods = st.one_of(
    st.integers(1990, 2030).map(str),
    st.tuples(st.integers(1990, 2030), st.integers(0, 9)).map(lambda t: f"{t[0]}Q{t[1]}"),
    st.tuples(st.integers(1990, 2030), st.integers(0, 9)).map(lambda t: f"{t[0]}-Q{t[1]}"),
    st.tuples(st.integers(1990, 2030), st.integers(0, 14)).map(lambda t: f"{t[0]}-{t[1]:02d}"),
    st.text(alphabet="0123456789Q-", max_size=8),
)


def expected(p: str, mode: str):
    qend = {1: "0331", 2: "0630", 3: "0930"}
    if re.fullmatch(r"\d{4}", p):
        return int(p), None, int(p + "1231")
    m = re.fullmatch(r"(\d{4})Q(\d)", p)
    if m:
        y, q = int(m.group(1)), int(m.group(2))
        return y, q, int(m.group(1) + qend.get(q, "1231"))
    if mode == "extended":
        m = re.fullmatch(r"(\d{4})-Q(\d)", p)
        if m:
            y, q = int(m.group(1)), int(m.group(2))
            return y, q, int(m.group(1) + qend.get(q, "1231"))
        m = re.fullmatch(r"(\d{4})-(0[1-9]|1[0-2])", p)
        if m:
            y, mo = int(m.group(1)), int(m.group(2))
            return y, (mo + 2) // 3, y * 10000 + mo * 100 + pycal.monthrange(y, mo)[1]
    return None, None, None


@settings(max_examples=3, deadline=None)
@given(st.lists(periods, min_size=50, max_size=200))
def test_period_parser_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "period string")
    for mode in ("strict", "extended"):
        got = {r.period: (r.year, r.quarter, r.date_key) for r in parse_period(df, "period", mode).collect()}
        for v in values:
            assert got[v] == expected(v, mode), (mode, v)


@settings(max_examples=3, deadline=None)
@given(st.dictionaries(st.integers(0, 60), st.integers(-50, 50).map(float), min_size=5, max_size=40),
       st.sampled_from([1, 3, 12]))
def test_calendar_change_matches_python(spark, series, step):
    df = spark.createDataFrame([("k", i, v) for i, v in series.items()], "k string, idx int, value double")
    got = {r.idx: r.ch for r in calendar_change(df, ["k"], "idx", "value", step, "ch", None).collect()}
    for i, v in series.items():
        p = series.get(i - step)
        want = None if p is None or p == 0 else (v - p) / abs(p) * 100
        assert got[i] == want, (i, got[i], want)
