import hashlib
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orrery.llm.bloom import Bloom
from orrery.llm.line_dedup import DISTANCE, LineDuplicates, alike, edit_similarity, left_lines, levenshtein, line_sizes, line_sketches, normalised, simhashes
from orrery.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def table_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@given(st.text("abcé ", max_size=20), st.text("abcé ", max_size=20))
@settings(max_examples=300, deadline=None)
def test_levenshtein(a, b):
    assert levenshtein(a, b) == table_distance(a, b)


def flatten(texts):
    blobs = [t.encode() for t in texts]
    return np.frombuffer(b"".join(blobs), np.uint8), np.cumsum([0, *map(len, blobs)])


def test_sketches_follow_the_normalised_lines():
    texts = ["A b, c 12 d\n\nx", "", "a B  c. 98 d!\na b c 00 d e\r\n", "éÉ a"]
    ln, number, count, (k1, k2), sim = line_sketches(*flatten(texts))
    every = [x for t in texts for x in t.split("\n")]
    assert count.tolist() == [len(normalised(x).split()) for x in every]
    assert number.tolist() == [i for t in texts for i in range(t.count("\n") + 1)]
    same = lambda i, j: (k1[i], k2[i], sim[i]) == (k1[j], k2[j], sim[j])
    for i, x in enumerate(every):
        for j, y in enumerate(every):
            assert same(i, j) == (normalised(x) == normalised(y)), (x, y)


def brute(rows, threshold=0.9, min_words=5):
    """Texts that are left: equal lines with a word, and all SimHashes of longer ones compared with each other."""
    rows = sorted(set(rows), key=lambda r: r[0])
    places, sims = defaultdict(list), {}
    for d, t in rows:
        _, number, count, _, sim = line_sketches(*flatten([t]))
        for n, c, s, x in zip(number.tolist(), count.tolist(), sim.tolist(), t.split("\n")):
            if c >= 1:
                places[normalised(x)].append((d, n))
            if c >= min_words:
                sims[normalised(x)] = s
    every, names = list(places), list(sims)
    parent = {x: x for x in every}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    value, n_links = np.array([sims[x] for x in names], np.uint64), 0
    for i, x in enumerate(names):
        for j in np.flatnonzero(np.bitwise_count(value[i + 1:] ^ value[i]) <= DISTANCE) + i + 1:
            if edit_similarity(x, names[j]) >= threshold:
                n_links += 1
                parent[find(x)] = find(names[j])
    groups = defaultdict(list)
    for x in every:
        groups[find(x)] += places[x]
    gone = {p for g in groups.values() for p in sorted(g)[1:]}
    return {(d, t): "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}, n_links


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want, _ = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r for r in QUERIES["op6_line_dedup"](spark, SF).collect()}
    assert len(got) == len(want)
    for (d, t), left in want.items():
        assert got[d].kept_sha256 == hashlib.sha256(left.encode()).hexdigest()
        assert (got[d].n_lines, got[d].n_removed) == (t.count("\n") + 1, t.count("\n") - left.count("\n") if left or not t else got[d].n_removed)


def test_fuzzy_lines_and_hot_lines(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    base = [word() for _ in range(150)]
    rows = []
    for d in range(80):
        ws = list(base)
        for i in rng.choice(150, d % 4, replace=False):
            ws[i] = word()
        rows.append((d, f"{' '.join(ws)}\nThe same, line {d} for every text!\n{' '.join(word() for _ in range(8))}\nshort line\nshort line"))
    want, links = brute(rows)
    assert links > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in LineDuplicates(docs).apply(docs).collect()}
    assert got == {d: left for (d, _), left in want.items()}


def test_odd_tables(spark):
    line = "one two three four five"
    rows = [(1, None, "k"), (1, "", "k"), (2, line, "k"), (2, line, "k"), (3, f"{line}\n{line}\r\nx", None), (None, "a b c d e f g", None), (4, "A-b c d e f g", None),
            (5, "w " * 100_000 + "\nend", None), (6, "\n" * 1000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line string")
    out = LineDuplicates(docs).apply(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id or 0, r.text is None, r.text or "") for r in out.collect()))
    assert got == sorted([(1, True, ""), (1, False, ""), (2, False, line), (2, False, line), (3, False, "x"), (0, False, "a b c d e f g"), (4, False, ""),
                          (5, False, "w " * 100_000 + "\nend"), (6, False, "\n" * 1000)])
    empty = docs.limit(0)
    assert LineDuplicates(empty).apply(empty).count() == 0


def test_bloom(spark):
    keys = spark.range(2000).select(F.xxhash64("id").alias("k1"), F.xxhash64("id", F.lit(1)).alias("k2"))
    bloom = Bloom(keys)
    k1, k2 = (np.array([r[i] for r in keys.collect()], np.int64) for i in (0, 1))
    assert bloom.might_hold(k1, k2).all()
    assert bloom.might_hold(k2, k1).mean() < 0.01
    assert not Bloom(keys.limit(0)).might_hold(k1, k2).any()


@pytest.mark.parametrize("a,b,want", [("", "", 1.0), ("abc", "", 0.0), ("abcd", "abce", 0.75)])
def test_edit_similarity(a, b, want):
    assert edit_similarity(a, b) == want


@given(st.lists(st.sampled_from(["one", "two", "three", "four", "a", "five"]), max_size=25), st.lists(st.tuples(st.integers(0, 24), st.sampled_from(["", "x", "two", "y z"])), max_size=4))
@settings(max_examples=300, deadline=None)
def test_alike_is_the_edit_similarity_against_the_threshold(words, changes):
    other = list(words)
    for i, w in changes:
        if i < len(other):
            other[i] = w
    a, b = " ".join(words), " ".join(x for x in other if x)
    for threshold in (0.9, 0.75):
        assert alike(a, b, threshold) == (edit_similarity(a, b) >= threshold)


def test_simhashes_of_short_and_long_ranges():
    h = np.random.default_rng(3).integers(0, 1 << 63, 40_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    first, count = np.array([0, 0, 5, 100, 0]), np.array([0, 1, 2, 501, 40_000])
    for s, a, n in zip(simhashes(h, first, count).tolist(), first, count):
        assert s == sum(1 << k for k in range(64) if 2 * sum(int(x) >> k & 1 for x in h[a:a + n].tolist()) > n)


def test_line_sizes():
    texts = ["A b, c 12 d\n\nx", "", "a B  c. 98 d!\na b c 00 d e\r\n", "éÉ a\n日本 語, \x00 z"]
    raw, off = flatten(texts)
    ln, _, count, _, _ = line_sketches(raw, off)
    assert line_sizes(raw, ln, count).tolist() == [len(normalised(x)) for t in texts for x in t.split("\n")]


def test_lines_of_one_hash_and_unlike_lengths_are_no_pairs(spark, monkeypatch):
    verified, compared = LineDuplicates._verified, []
    monkeypatch.setattr(LineDuplicates, "_verified", staticmethod(lambda texts, pairs, threshold: compared.append(pairs.count()) or verified(texts, pairs, threshold)))
    sizes = [1, 2, 3, 4, 5, 6, 8, 10, 12, 15, 18, 22, 26, 31, 37, 44, 52, 62, 74, 88]  # a sixth and more apart
    rows = [(i, " ".join(["one two three four five six seven"] * n)) for i, n in enumerate(sizes)]
    rows += [(100, rows[9][1].replace("seven", "sevem", 1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in LineDuplicates(docs).apply(docs).collect()}
    assert got == {d: left for (d, _), left in brute(rows)[0].items()} and got[100] == ""
    assert sum(compared) <= len(rows)


def test_spans_that_the_edit_check_divides(spark):
    """Lines of the same words in other orders have one hash and one length: each order with its own near copies."""
    rng = np.random.default_rng(4)
    words = [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}w" for i in range(60)]
    rows = []
    for g in range(12):
        order = list(rng.permutation(words))
        rows += [(10 * g + k, " ".join([*order, *(["and"] * k)])) for k in range(3)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    want, links = brute(rows)
    assert links >= 12
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in LineDuplicates(docs).apply(docs).collect()} == {d: left for (d, _), left in want.items()}


def test_lines_go_from_a_slice_of_the_texts_at_a_time():
    texts = pa.array([("a" * 99 + "\n") * 2000 + f"é{i}" for i in range(100)] + [None, "", "x\ny"])
    numbers = pa.array([[0, 2000] if i % 2 else None for i in range(100)] + [[0], [0], [0]], pa.list_(pa.int32()))
    tracemalloc.start()
    got = left_lines(texts, numbers)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10_000_000  # the texts have 20 MB
    want = [("a" * 99 + "\n") * (2000 - 1) if i % 2 else ("a" * 99 + "\n") * 2000 + f"é{i}" for i in range(100)]
    assert got.to_pylist() == [w[:-1] if i % 2 else w for i, w in enumerate(want)] + [None, "", "y"]
    assert left_lines(texts.slice(0, 0), numbers.slice(0, 0)).to_pylist() == []


def test_only_texts_with_wanted_lines_are_read_again(spark, monkeypatch):
    import orrery.llm.line_dedup as module

    read, plain = spark.sparkContext.accumulator(0), module._line_texts

    def counted(text, wanted):
        @F.udf("string")
        def seen(t):
            read.add(1)
            return t
        return plain(seen(text), wanted)

    monkeypatch.setattr(module, "_line_texts", counted)
    near = "one two three four five six seven eight nine ten"
    name = lambda i: chr(97 + i // 26) + chr(97 + i % 26)
    rows = [(i, " ".join(f"{name(i)}q{name(j)}" for j in range(30))) for i in range(200)] + [(300, near), (301, near.upper() + "!"), (302, " ".join(reversed(near.split())))]
    rows += [(303, "only\nshort"), (304, "only\nother"), (305, None)]
    found = LineDuplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.id, tuple(r.lines)) for r in found.gone.collect()) == [(301, (0,)), (304, (0,))]
    assert 0 < read.value < 20
