import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orrery.llm import repeats
from orrery.llm.queries import QUERIES
from orrery.llm.repeats import LENGTH, RepeatedStrings, anchors, sliding_minimum
from orrery.llm.suffix_sort import blind_order, common_prefix, deep_shallow

SF = "/root/testdata/sf0.01"


@given(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 2 for x in b)), max_size=30))
@settings(max_examples=300, deadline=None)
def test_blind_order(strings):
    assert [strings[i] for i in blind_order(strings)] == sorted(strings)


@given(st.binary(max_size=30), st.binary(max_size=30), st.binary(max_size=30))
@settings(max_examples=100, deadline=None)
def test_common_prefix(p, a, b):
    want = next((i for i, (x, y) in enumerate(zip(p + a, p + b)) if x != y), min(len(p + a), len(p + b)))
    assert common_prefix(p + a, p + b) == want


def test_deep_shallow():
    rng = np.random.default_rng(1)
    long = bytes(rng.integers(0, 3, 300, np.uint8))
    strings = [long[:int(rng.integers(100, 300))] + bytes(rng.integers(0, 2, int(rng.integers(0, 100)), np.uint8)) for _ in range(200)]
    group = rng.integers(0, 3, 200)
    rows = np.zeros((200, 400), np.uint8)
    for i, s in enumerate(strings):
        rows[i, :len(s)] = np.frombuffer(s, np.uint8)
    order = deep_shallow(rows, np.array([len(s) for s in strings]), group)
    assert [(group[i], strings[i]) for i in order] == sorted((int(g), s) for g, s in zip(group, strings))


def test_sliding_minimum():
    x = np.random.default_rng(0).integers(0, 100, 1000).astype(np.uint64)
    for w in (1, 7, 369, 1000):
        assert sliding_minimum(x, w).tolist() == [x[i:i + w].min() for i in range(1000 - w + 1)]


def test_every_window_has_the_anchor_of_its_bytes():
    rng = np.random.default_rng(2)
    body = bytes(rng.integers(97, 100, 900, np.uint8))
    texts = [body, b"x" * 399, b"", b"y" * 37 + body[100:] + b"ab" * 300, b"z" * 400]
    raw, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    place, first, last, _, text = anchors(raw, off)
    at = {}
    for p, a, b, t in zip(place, first, last, text):
        for s in range(a, b + 1):
            assert off[t] <= s and s + LENGTH <= off[t + 1]
            at.setdefault(raw[s:s + LENGTH].tobytes(), set()).add(int(p - s))
    assert all(len(v) == 1 for v in at.values())
    assert sum(b - a + 1 for a, b in zip(first, last)) == sum(max(0, len(t) - LENGTH + 1) for t in texts)


def brute(texts):
    """{id: (bytes, removed, runs, digest)} from all windows of all documents."""
    seen = defaultdict(int)
    data = {d: (t or "").encode() for d, t in texts}
    for b in data.values():
        for s in range(len(b) - LENGTH + 1):
            seen[b[s:s + LENGTH]] += 1
    out = {}
    for d, b in data.items():
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - LENGTH + 1):
            if seen[b[s:s + LENGTH]] > 1:
                gone[s:s + LENGTH] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out[d] = (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def result(docs):
    return {r.doc_id: (len((r.text or "").encode()), r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())
            for r in RepeatedStrings(docs).apply(docs).collect()}


def test_query_against_all_windows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op10_repeats"](spark, SF).collect()}
    assert got == want and any(w[1] for w in want.values())


def planted(seed, n):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdeéß"), int(rng.integers(1, 9))))
    text = lambda k: " ".join(word() for _ in range(k))
    shared, base, rows = [text(n_) for n_ in (90, 120, 75, 300)], text(500), []
    for i in range(n):
        t = text(40)
        kind = i % 6
        if kind == 0:
            t += shared[i % 4] + text(30)
        elif kind == 1:
            t = base[:int(rng.integers(0, 2000))] + word() + base[int(rng.integers(500, 2500)):]
        elif kind == 2:
            t += f"{word()} " * int(rng.integers(50, 300)) + text(20)
        elif kind == 3:
            t = shared[1][:int(rng.integers(380, 600))] + t
        elif kind == 4:
            t = ("abc abcd " * 100)[int(rng.integers(0, 9)):] + t if i % 4 else "x" * int(rng.integers(390, 1500))
        else:
            t = t + shared[2] + text(9) + shared[2] + shared[0]
        rows.append((i, t))
    return rows


@pytest.mark.parametrize("part,seed", [(2048, 1), (2048, 2), (5, 3), (3, 4)])
def test_planted_repeats_and_split_groups(spark, monkeypatch, part, seed):
    monkeypatch.setattr(repeats, "PART", part)
    rows = planted(seed, 120)
    got, want = result(spark.createDataFrame(rows, "doc_id long, text string")), brute(rows)
    assert {d: (got[d], rows[d][1]) for d in want if got[d] != want[d]} == {}


def test_fragments_of_periodic_texts_at_every_phase(spark):
    rng = np.random.default_rng(5)
    text = lambda k: "".join(rng.choice(list("abcdefghij "), k))
    rows = []
    for k in range(240):  # each fragment is in one periodic text only, and too short to be a periodic stretch itself
        period = int(rng.integers(20, 370)) if k % 3 else 200
        line, phase, size = text(period), int(rng.integers(0, period)), 400 + int(rng.integers(0, period)) * (k % 2)
        rows.append(text(int(rng.integers(0, 500)) * (k % 4 == 0)) + line * (500 // period + int(rng.integers(2, 9))) + text(60 * (k % 5 == 0)))
        rows.append(text(40) + (line * 60)[phase:phase + size] + text(30))
    rows = list(enumerate(rows))
    got, want = result(spark.createDataFrame(rows, "doc_id long, text string")), brute(rows)
    assert {d: (got[d], want[d]) for d in want if got[d] != want[d]} == {}


def test_odd_tables(spark):
    long = "".join(f"{i} " for i in range(60_000))
    rows = [(1, None, 1), (2, "", 1), (3, "a" * 399, 1), (4, "a" * 400, 1), (5, "a" * 401, 1), (6, long, 1), (7, long[5000:9000] + "!", 1), (8, "é" * 200, None), (9, "é" * 200, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_spans long")
    assert result(docs) == brute([r[:2] for r in rows])
    empty = docs.limit(0)
    assert RepeatedStrings(empty).apply(empty).count() == 0
    twice = docs.filter("doc_id = 4").unionAll(docs.filter("doc_id = 4"))
    assert [r.n_removed for r in RepeatedStrings(twice).apply(twice).collect()] == [400, 400]
